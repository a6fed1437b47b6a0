"""Content-derived keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a NULL is written inside a key, and what separates its fields.
NULL_TEXT = "_null_"
SEPARATOR = "|"


def key_text(*fields: Column) -> Column:
    """Fields as text with a placeholder for NULL, joined by the separator."""
    return F.concat_ws(
        SEPARATOR, *[F.coalesce(field.cast("string"), F.lit(NULL_TEXT)) for field in fields]
    )


def surrogate_key(*fields: Column) -> Column:
    """MD5 of the fields; never NULL."""
    return F.md5(key_text(*fields))


def hash64(text: Column) -> Column:
    """First 64 bits of the MD5 of `text` as a signed bigint; NULL stays NULL."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")
