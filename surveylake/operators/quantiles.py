"""Exact quantiles of any number that never hold a group in one task.

The built-in exact percentile keeps all distinct values of a group in the
memory of one task. Here the values are counted first, spread by group *and*
value, so a group with a third of all rows is still shared by all tasks. The
wanted ranks are then found by a radix descent over numbers that order the values:

1. running counts over the buckets of a group show which buckets hold wanted ranks;
2. only inside those, the same again with smaller buckets, as many levels as the
   type is wide;
3. running counts over the values of the last buckets give the answers.

| type | levels | widest sorted window |
| --- | --- | --- |
| int, decimal up to 12 digits | 2**20 units of the last place, values | 2**20 rows |
| bigint, decimal up to 18 digits | 2**43, 2**21 units, values | 2**22 rows |
| float, double | the same, over the 64 bits that order a double | 2**22 rows |
| wider decimals | six digits a level, values | 2 * 10**6 rows |

So every window is bounded by the type, whatever the number of rows. Every level reads
the counted values and joins them with the few buckets found one level above.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from surveylake.operators.weights import count, kept, weight

_BITS = 20
_WIDE_BITS = (43, 21)
_SHORT_DIGITS, _LONG_DIGITS, _LEVEL_DIGITS = 12, 18, 6
_NULL_BUCKET = -(1 << 44)  # below every bucket of every type


@dataclass(frozen=True)
class _Numbers:
    """How a type is counted: its value, the buckets above it, what is summed, and its value as a double."""

    value: Callable[[Column], Column]
    buckets: Callable[[Column], list[Column]]
    product: Callable[[Column, Column], Column]
    double: Callable[[Column], Column]


def _shifts(bits: Sequence[int]) -> Callable[[Column], list[Column]]:
    return lambda v: [F.shiftright(v, b) for b in bits]


def _exact_sum(v: Column, n: Column) -> Column:
    return v.cast("decimal(20,0)") * n.cast("decimal(17,0)")


def _double_sum(v: Column, n: Column) -> Column:
    return v.cast("double") * n


def _whole(scale: int, bits: Sequence[int]) -> _Numbers:
    """Integers, and decimals counted in units of their last place."""
    unit = F.lit(Decimal(10) ** scale)
    return _Numbers(
        lambda c: (c * unit if scale else c).cast("bigint"), _shifts(bits), _exact_sum,
        lambda v: v.cast("double") / F.lit(float(10**scale)),
    )


def _ordered_bits(v: Column) -> Column:
    """A bigint that orders doubles as Spark does: NaN above everything, -0.0 as 0.0."""
    number = F.coalesce(v + F.lit(0.0), F.lit(0.0))
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number).cast("bigint")
    ordered = F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)
    return F.when(v.isNotNull(), ordered)


def _digits(kind: T.DecimalType) -> Callable[[Column], list[Column]]:
    """Six digits a level, all with the sign of the value, so that they order it from the first level on."""
    def buckets(v: Column) -> list[Column]:
        found = []
        for low in range(_LEVEL_DIGITS * ((kind.precision - 1) // _LEVEL_DIGITS), 0, -_LEVEL_DIGITS):
            above, unit = low + _LEVEL_DIGITS - kind.scale, Decimal(1).scaleb(low - kind.scale)
            # the first level has no digits above it
            part = v % F.lit(Decimal(1).scaleb(above)) if low + _LEVEL_DIGITS < kind.precision else v
            found.append(F.call_function("div", part, F.lit(unit)))
        return found

    return buckets


def _numbers(df: DataFrame, col: str) -> _Numbers:
    kind = df.schema[col].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return _whole(0, (_BITS,))
    if isinstance(kind, T.LongType):
        return _whole(0, _WIDE_BITS)
    if isinstance(kind, T.DecimalType):
        if kind.precision <= _LONG_DIGITS:
            return _whole(kind.scale, (_BITS,) if kind.precision <= _SHORT_DIGITS else _WIDE_BITS)
        return _Numbers(lambda c: c, _digits(kind), _double_sum, lambda v: v.cast("double"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _Numbers(
            lambda c: c.cast("double"), lambda v: _shifts(_WIDE_BITS)(_ordered_bits(v)), _double_sum, lambda v: v)
    raise ValueError(f"quantiles need numbers, and {col} is {kind.simpleString()}")


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    ps: Mapping[str, float],
    exact: bool = True,
    sets: Sequence[Sequence[str]] | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """``by...``, ``n`` (values), ``mean`` and one column per entry of ``ps``.

    Quantiles are interpolated, as doubles. NULL values are ignored, and a group
    without values has n = 0. NaN is a value, the greatest; with one the mean is NaN.
    ``sets`` gives several groupings at once, as in ``GROUPING SETS``; the result
    then has ``level``, their grouping id. With ``exact=False`` they are estimated
    in one pass with bounded memory. The mean of doubles and of decimals over 18
    digits is a sum of doubles, whose last digits may depend on the order of rows.
    """
    by, ps = list(by), dict(ps)
    for name, p in ps.items():
        if not 0 <= p <= 1:
            raise ValueError(f"quantile {name} must be in [0, 1], not {p}")
    if not exact:
        if weight(df) is not None:
            raise ValueError("estimates are made from answers, not from counts")
        return _estimates(df, by, col, ps, sets, accuracy)

    numbers = _numbers(df, col)
    key = F.struct(*by) if by else F.struct(F.lit(1).alias("_all"))
    counts = (
        df.select(key.alias("g"), numbers.value(F.col(col)).alias("v"), *kept(df))
        .groupBy("g", "v")
        .agg(count(weight(df), "v").alias("n"))
    )
    if sets is not None:
        counts = _levels(counts, by, sets)
    picked = _pick(counts, ps, numbers)

    out = [F.col("total").alias("n"), F.try_divide(numbers.double(F.col("sum")), F.col("total")).alias("mean")]
    for i, (name, p) in enumerate(ps.items()):
        position = (F.col("total") - 1) * F.lit(float(p))
        part = position - F.floor(position)
        low, high = numbers.double(F.col(f"low{i}")), numbers.double(F.col(f"high{i}"))
        # infinite neighbours have no difference; equal ones and whole positions need none
        between = F.when((part == 0) | (low == high), low).otherwise(low + (high - low) * part)
        out.append(between.alias(name))
    keys = [F.col(f"g.{c}").alias(c) for c in by]
    level = [F.col("g.level").alias("level")] if sets is not None else []
    return picked.select(*level, *keys, *out)


def _levels(counts: DataFrame, by: list[str], sets) -> DataFrame:
    """Repeat the counted values once per grouping set, then add them up again."""
    levels = []
    for kept in sets:
        level = sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in kept)
        parts = [F.when(F.lit(c in kept), F.col(f"g.{c}")).alias(c) for c in by]
        levels.append(F.struct(F.lit(level).cast("bigint").alias("level"), *parts))
    return (
        counts.select(F.explode(F.array(*levels)).alias("g"), "v", "n")
        .groupBy("g", "v")
        .agg(F.sum("n").alias("n"))
    )


def _wanted(ps: dict) -> list[tuple]:
    ranks = []
    for p in ps.values():
        position = (F.col("total") - 1) * F.lit(float(p))
        ranks.append((F.floor(position), F.ceil(position)))
    return ranks


def _holds(rank, first, last):
    return (rank >= first) & (rank < last)


def _pick(counts: DataFrame, ps: dict, numbers: _Numbers) -> DataFrame:
    """``g``, ``total``, ``sum`` and the two neighbours of every wanted position."""
    buckets = numbers.buckets(F.col("v"))
    names = [f"b{i}" for i in range(len(buckets))]
    counts = counts.withColumns(
        {name: F.coalesce(b, F.lit(_NULL_BUCKET)).cast("bigint") for name, b in zip(names, buckets)})
    ranks = _wanted(ps)
    wanted = F.col("total") == 0
    for pair in ranks:
        for rank in pair:
            wanted = wanted | _holds(rank, F.col("before"), F.col("before") + F.col("bn"))
    if not ps:
        wanted = wanted | (F.col("before") == 0)

    targets = None
    for depth, name in enumerate(names):
        above = ["g", *names[:depth]]
        so_far = Window.partitionBy(*above).orderBy(name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ahead = F.sum("bn").over(so_far) - F.col("bn")
        if targets is None:
            whole = Window.partitionBy("g")
            level = counts.groupBy("g", name).agg(
                F.sum("n").alias("bn"), F.sum(numbers.product(F.col("v"), F.col("n"))).alias("bs")
            ).select(
                "g", name, "bn", ahead.alias("before"),
                F.sum("bn").over(whole).alias("total"), F.sum("bs").over(whole).alias("sum"))
        else:
            found = {c: F.max(c).alias(c) for c in ("before", "total", "sum")}
            level = counts.join(targets, above).groupBy(*above, name).agg(F.sum("n").alias("bn"), *found.values())
            level = level.withColumn("before", F.col("before") + ahead)
        targets = level.filter(wanted).drop("bn")

    above = ["g", *names]
    in_bucket = (
        Window.partitionBy(*above).orderBy("v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.col("before") + F.sum("n").over(in_bucket)
    values = (
        counts.join(targets, above)
        .withColumn("last", last)
        .withColumn("first", F.col("last") - F.col("n"))
    )
    picks = []
    for i, pair in enumerate(ranks):
        for end, rank in zip(("low", "high"), pair):
            hit = F.when(_holds(rank, F.col("first"), F.col("last")), F.col("v"))
            picks.append(F.max(hit).alias(f"{end}{i}"))
    return values.groupBy("g").agg(F.max("total").alias("total"), F.max("sum").alias("sum"), *picks)


def _estimates(df, by, col, ps, sets, accuracy) -> DataFrame:
    number = F.col(col).cast("double")
    stats = [F.count(col).alias("n"), F.avg(number).alias("mean")]
    stats += [F.percentile_approx(number, float(p), accuracy).alias(name) for name, p in ps.items()]
    if sets is None:
        return df.groupBy(*by).agg(*stats)
    grouped = df.groupingSets([list(s) for s in sets], *by)
    return grouped.agg(F.grouping_id().alias("level"), *stats).select(
        "level", *by, "n", "mean", *ps
    )
