"""load -> clean -> binary target -> one-hot -> exact stratified split.

The result is ONE lazy frame with the label kept in and a ``split`` column; the only
actions are the small fits (modes, levels, split thresholds). Writing it with
``partitionBy("split")`` gives partition-pruned train/test reads (S10).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tabsmith.operators.cleaning import CleaningPipeline
from tabsmith.operators.encoding import BinaryTargetEncoder, OneHotCategoricalEncoder, OneHotModel
from tabsmith.operators.split import assign_split


@dataclass
class TableBuilder:
    cleaning: CleaningPipeline = field(default_factory=lambda: CleaningPipeline([]))
    target: str = "salary"
    positive_label: str = ">50K"
    label: str | None = None
    key: list[str] | None = None
    exclude_from_encoding: list[str] = field(default_factory=list)
    drop_first: bool = True
    test_size: float = 0.2
    seed: int = 42
    stratify: bool = True
    fit_levels_on: str = "all"   # "all" (reference parity) or "train"
    encoder_: OneHotModel | None = None

    def build(self, raw: DataFrame) -> DataFrame:
        label = self.label or self.target
        clean = self.cleaning.run(raw)
        labelled = BinaryTargetEncoder(column=self.target, positiveLabel=self.positive_label,
                                       outputColumn=label).transform(clean)
        exclude = list(self.exclude_from_encoding) + [label] + list(self.key or [])
        if self.fit_levels_on == "train":
            marked = assign_split(labelled, self.test_size, self.seed, label if self.stratify else None, self.key)
            self.encoder_ = OneHotCategoricalEncoder(exclude=exclude + ["split"], dropFirst=self.drop_first) \
                .fit(marked.where("split = 'train'"))
            return self.encoder_.transform(marked)
        self.encoder_ = OneHotCategoricalEncoder(exclude=exclude, dropFirst=self.drop_first).fit(labelled)
        encoded = self.encoder_.transform(labelled)
        return assign_split(encoded, self.test_size, self.seed, label if self.stratify else None, self.key)

    def feature_columns(self, table: DataFrame) -> list[str]:
        """P5: everything but label, keys and the split marker."""
        label = self.label or self.target
        skip = {label, "split", *(self.key or [])}
        return [c for c in table.columns if c not in skip]
