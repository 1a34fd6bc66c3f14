"""Content digest of a relation: what a count cannot see.

Each row becomes one text (columns by name, every value with its length), each
text a 60-bit number of its MD5, and the numbers are summed. The sum depends on
neither row order nor partitioning, counts repeated rows as often as they occur,
and is a plain aggregate: tasks ship one number each. Doubles take part with six
decimals, timestamps with microseconds, nested values as JSON; NULL differs from
the empty text. An empty relation has the digest "0".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEX_DIGITS = 15  # 60 bits, so that a digest fits a BIGINT before it is summed


def _value_text(field: T.StructField) -> Column:
    c = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = c.cast("double") + F.lit(0.0)  # -0.0 is 0.0
        return F.when(c.isNotNull(), F.format_string("%.6f", c))
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(c)
    return c.cast("string")


def row_text(df: DataFrame) -> Column:
    """All columns of a row as one text: by name, ``length:value`` or ``-`` for NULL."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in map(_value_text, fields)]
    return F.concat(*parts) if parts else F.lit("")


def content_digest(df: DataFrame) -> Column:
    """Aggregate: the digest of the group's rows as decimal text."""
    number = F.conv(F.substring(F.md5(row_text(df).cast("binary")), 1, _HEX_DIGITS), 16, 10).cast("decimal(20,0)")
    return F.coalesce(F.sum(number).cast("string"), F.lit("0"))


def summary(relations: dict[str, DataFrame], label: str) -> DataFrame:
    """One row per relation: ``label``, row count ``n`` and ``digest``."""
    parts = [df.agg(F.count(F.lit(1)).alias("n"), content_digest(df).alias("digest"))
             .select(F.lit(name).alias(label), "n", "digest") for name, df in relations.items()]
    return reduce(DataFrame.unionByName, parts)
