"""Column expressions: no DataFrame in, no DataFrame out."""

from mailfacts.functions.keys import email_key, key_tag, norm_key
from mailfacts.functions.labels import (
    bounce_code,
    control_flag,
    effective_source,
    holdout_flag,
    is_redpoint,
    locale_country,
    locale_language,
    null_sentinel,
    source_system,
)
from mailfacts.functions.time import Bounds, from_year, from_year_month, mst_date, to_mst

__all__ = [
    "Bounds",
    "bounce_code",
    "control_flag",
    "effective_source",
    "email_key",
    "from_year",
    "from_year_month",
    "holdout_flag",
    "is_redpoint",
    "key_tag",
    "locale_country",
    "locale_language",
    "mst_date",
    "norm_key",
    "null_sentinel",
    "source_system",
    "to_mst",
]
