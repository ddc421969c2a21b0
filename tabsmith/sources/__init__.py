"""Sources (S1-S8) and sinks."""

from tabsmith.sources.loaders import (  # noqa: F401
    CSVDataLoader, DataLoader, FrameLoader, ParquetLoader, TableLoader, apply_null_tokens, infer_types,
)
