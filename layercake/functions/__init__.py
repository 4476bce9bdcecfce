"""Column functions. Everything here is a Catalyst expression; there are no Python UDFs."""

from layercake.functions.aggregates import (
    det_mode,
    distinct_list,
    exact_median,
    mean,
)
from layercake.functions.dates import (
    dow0,
    minute_of_day,
    minutes_between,
    month_of,
    years_between,
)
from layercake.functions.documents import as_variant, variant_field, variant_flag
from layercake.functions.labels import (
    band,
    between_band,
    classify,
    contains_any,
    first_match,
    flag,
    keyword_class,
    normalize,
    peak_of,
)
from layercake.functions.numbers import clamp, safe_pct, safe_ratio, strict_cast
from layercake.functions.text import clean_email, clean_name, code, digits, full_name, non_blank
from layercake.functions.keys import member_key, packed_key, surrogate_key, unpacked_key

__all__ = [
    "as_variant", "band", "between_band", "clamp", "classify", "clean_email", "clean_name", "code",
    "contains_any", "det_mode", "digits", "distinct_list", "dow0", "exact_median",
    "first_match", "flag", "full_name", "keyword_class", "mean", "member_key", "minute_of_day", "minutes_between", "month_of",
    "non_blank", "normalize", "packed_key", "peak_of", "safe_pct", "safe_ratio", "strict_cast", "surrogate_key",
    "unpacked_key", "variant_field", "variant_flag", "years_between",
]
