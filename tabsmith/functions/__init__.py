"""Column expressions (quoting, type families, missing values, text, guarded statistics)."""

from tabsmith.functions.columns import (  # noqa: F401
    categorical_columns, col, is_missing, numeric_columns, percent, quote, safe_div, strip_text,
)
from tabsmith.functions.stats import corrected_kurtosis, corrected_skewness, pairwise_pearson  # noqa: F401
