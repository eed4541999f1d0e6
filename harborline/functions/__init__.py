"""Column expressions; every one of them stays inside the JVM."""

from harborline.functions.dates import days_between, month_key, month_start, months_apart
from harborline.functions.numbers import (
    chi2_sf,
    clip,
    erfc,
    finite,
    mean_of,
    safe_ratio,
    two_proportion_p,
    two_sided_normal_p,
)
from harborline.functions.text import (
    number_tokens,
    percent_text,
    signed_text,
    strip,
    title_case,
)

__all__ = [
    "chi2_sf", "clip", "days_between", "erfc", "finite", "mean_of", "month_key",
    "month_start", "months_apart", "number_tokens", "percent_text", "safe_ratio",
    "signed_text", "strip", "title_case", "two_proportion_p", "two_sided_normal_p",
]
