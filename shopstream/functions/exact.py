"""Exact sums of doubles as Spark aggregates: any row order gives the same, correctly rounded sum.

Every finite value is an integer times a power of two. Values are dealt into
bins of 32 binary exponents, and a bin sums its integers as DECIMAL(38,0), which
loses nothing and merges in any order (partial aggregates, streaming state). At
the end the bins are carried into one number and rounded once, half to even.

The bins reach from 2**-128 to 2**192 (3e-39 to 6e57). A finite value beyond
them is not dropped: such values are summed as doubles and added at the end.
NaN and infinities are no numbers here; they count as missing. A bin holds
10**12 values a group before it could overflow.

The text forms serve SQL statements; the column forms wrap them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOW, WIDTH, BINS = -128, 32, 10
_SPLIT = 1 << 42  # the integers of a bin have 84 bits: two halves that a double holds exactly
_BASE = f"{1 << WIDTH}BD"


def _double(power: int) -> str:
    return f"{2.0 ** power!r}D".replace("e", "E")


def bin_sql(value: str) -> str:
    """Bin of a double: 0 and up, -1 beyond the bins, null for a missing value."""
    lows = [f"WHEN abs({value}) >= {_double(LOW + WIDTH * k)} THEN {k}" for k in reversed(range(BINS))]
    return (f"CASE WHEN {value} IS NULL OR isnan({value}) OR abs({value}) = DOUBLE('Infinity') THEN NULL "
            f"WHEN {value} = 0 THEN 0 WHEN abs({value}) >= {_double(LOW + WIDTH * BINS)} THEN -1 "
            f"{' '.join(lows)} ELSE -1 END")


def parts_sql(value: str, bin_: str) -> str:
    """A double as struct: its bin, the integer it adds to the bin, or the value itself beyond the bins."""
    scales = ", ".join(_double(52 - LOW - WIDTH * k) for k in range(BINS))
    scaled = f"(abs({value}) * array({scales})[{bin_}])"
    high = f"floor({scaled} / {_SPLIT}D)"
    whole = (f"CAST({high} AS DECIMAL(14,0)) * {_SPLIT}BD + "
             f"CAST(CAST({scaled} - CAST({high} AS DOUBLE) * {_SPLIT}D AS BIGINT) AS DECIMAL(14,0))")
    return (f"CASE WHEN {bin_} IS NOT NULL THEN named_struct('bin', {bin_}, 'whole', CASE WHEN {bin_} >= 0 THEN "
            f"CAST(({whole}) * CAST(sign({value}) AS DECIMAL(1,0)) AS DECIMAL(28,0)) END, "
            f"'far', CASE WHEN {bin_} < 0 THEN {value} END) END")


def _digits(bins: str) -> str:
    """Bins carried upwards: digits of 32 bits, lowest first, and the last carry (negative for a negative sum)."""
    s = "(t + s.carry)"
    return (f"aggregate({bins}, named_struct('carry', CAST(0 AS DECIMAL(38,0)), 'digits', CAST(array() AS ARRAY<BIGINT>)), "
            f"(s, t) -> named_struct('carry', CAST(({s} - pmod({s}, {_BASE})) / {_BASE} AS DECIMAL(38,0)), "
            f"'digits', concat(s.digits, array(CAST(pmod({s}, {_BASE}) AS BIGINT)))))")


def _rounded(digits: str) -> str:
    """The double nearest to the digits: the three highest, the lowest of them odd if anything follows."""
    at = "k.k"
    top = (f"CAST(k.d[{at}] AS DECIMAL(38,0)) * {1 << 64}BD + CAST(k.d[{at} - 1] AS DECIMAL(38,0)) * {_BASE} + "
           f"(k.d[{at} - 2] | IF(exists(slice(k.d, 1, {at} - 2), x -> x > 0), 1, 0))")
    place = "size(d) - CAST(array_position(reverse(transform(d, x -> x > 0)), true) AS INT)"
    return (f"transform(transform(array({digits}), d -> named_struct('d', d, 'k', {place})), "
            f"k -> IF({at} >= size(k.d), 0D, CAST({top} AS DOUBLE) * pow(2D, {LOW - 52} + {WIDTH} * ({at} - 4))))[0]")


def sum_sql(parts: str) -> str:
    """Correctly rounded sum of a column of parts; null if it has none."""
    sums = ", ".join(f"coalesce(sum(CASE WHEN {parts}.bin = {k} THEN {parts}.whole END), CAST(0 AS DECIMAL(38,0)))"
                     for k in range(BINS))
    none = "CAST(0 AS DECIMAL(38,0))"
    bins = f"array({none}, {none}, {sums}, {none}, {none}, {none})"
    signed = (f"transform(transform(array({bins}), a -> named_struct('a', a, 'p', {_digits('a')})), "
              f"v -> IF(v.p.carry < 0, -{_rounded(_digits('transform(v.a, t -> -t)') + '.digits')}, "
              f"{_rounded('v.p.digits')}))[0]")
    return f"CASE WHEN count({parts}) > 0 THEN {signed} + coalesce(sum({parts}.far), 0D) END"


def with_parts(df: DataFrame, **values: str) -> DataFrame:
    """``df`` with a column of parts per name, of the double that its SQL expression gives."""
    df = df.withColumns({f"_{name}_bin": F.expr(bin_sql(f"({value})")) for name, value in values.items()})
    return df.withColumns({name: F.expr(parts_sql(f"({value})", f"_{name}_bin")) for name, value in values.items()})


def exact_sum(parts: str) -> Column:
    return F.expr(sum_sql(parts))


def exact_avg(parts: str) -> Column:
    """Exact sum over the number of the values that it adds."""
    return F.try_divide(exact_sum(parts), F.count(parts).cast("double"))


def exact_total(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``df`` grouped by ``keys``: the exact sum of a double column, under its own name."""
    return with_parts(df, _parts=column).groupBy(*keys).agg(exact_sum("_parts").alias(column))
