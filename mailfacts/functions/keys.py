"""Keys: surrogate hashes, normalised join keys and shuffle tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
KEY_SEPARATOR = "|"
KEY_BITS = 256


def email_key(*parts: Column | str) -> Column:
    """Surrogate key of one email: SHA-2 hex of its natural key.

    Null parts are skipped, so the key itself is never null.
    """
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), KEY_BITS)


def norm_key(column: Column | str) -> Column:
    """Join form of an id: text, lower case, no outer blanks. Null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.trim(F.lower(column.cast("string")))


def key_tag(*keys: Column | str) -> Column:
    """A hash of the keys, to be grouped by beside them.

    A side reduced by ``keys`` alone comes out partitioned by exactly ``keys``; a later join
    on them would read it in place, and the adaptive skew rule then leaves a hot key of the
    other side in one task. Grouping by the tag as well makes the join exchange both sides,
    which the rule can split. The reduced side holds one row per key, so the extra exchange
    is the small one.
    """
    return F.xxhash64(*keys)
