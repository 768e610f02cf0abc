"""Exact order statistics of large columns.

``percentile`` and ``percentile_disc`` keep every distinct value of a group in
one task. Here each wanted rank is narrowed down instead, round by round: the
values that can still hold it are counted in bins, map-side, and the bin with
the rank is cut again. What is left at the end, at most ``SORTED_ROWS`` rows a
rank or equal values, is put in order. Values find their bin by equality.

The bins keep the order of the values, and every round separates the least of
them from the greatest, whatever their spread: numbers are cut by sign and power
of two first, then evenly; strings by the bytes after the prefix that the bin's
strings share. So an outlier, an infinity or a long common prefix costs at most
a few rounds, and the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

BINS = 4096
#: Rows of a bin that one task may put in order.
SORTED_ROWS = 100_000
#: Bytes of a string that a round looks at.
BYTES = 5


def _evenly(x: Column, low: Column, high: Column) -> Column:
    place = F.floor((x - low) / (high - low) * F.lit(float(BINS)))
    return F.when(high > low, F.least(place, F.lit(BINS - 1))).otherwise(F.lit(0)).cast("bigint")


def _power(v: Column) -> Column:
    """Sign and power of two; infinities lie apart from all numbers."""
    octave = F.greatest(F.least(F.floor(F.log2(F.abs(v))), F.lit(1100)), F.lit(-1100)) + F.lit(2000)
    return F.when(v == 0, F.lit(0)).when(v > 0, octave).otherwise(-octave).cast("bigint")


def _next_bytes(v: Column, shared: Column) -> Column:
    """The ``BYTES`` bytes after the first ``shared`` as one number; the end of a string comes before any byte."""
    places = [F.coalesce(F.conv(F.hex(F.substring(v.cast("binary"), shared + F.lit(i), 1)), 16, 10).cast("double") + F.lit(1.0), F.lit(0.0))
              * F.lit(float(257 ** (BYTES - i))) for i in range(1, BYTES + 1)]
    out = places[0]
    for place in places[1:]:
        out = out + place
    return out


def _shared(low: str, high: str) -> Column:
    """Bytes that two strings begin with together; their first difference is found by halving."""
    same = f"substring(cast({low} AS binary), 1, (b.lo + b.hi + 1) div 2) = substring(cast({high} AS binary), 1, (b.lo + b.hi + 1) div 2)"
    return F.expr(f"""aggregate(sequence(1, 32),
        named_struct('lo', 0L, 'hi', cast(least(octet_length({low}), octet_length({high})) AS bigint)),
        (b, i) -> CASE WHEN b.lo >= b.hi THEN b
                       WHEN {same} THEN named_struct('lo', (b.lo + b.hi + 1) div 2, 'hi', b.hi)
                       ELSE named_struct('lo', b.lo, 'hi', (b.lo + b.hi + 1) div 2 - 1) END,
        b -> cast(b.lo AS int))""")


def _meet(rows: DataFrame, slots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their slot; a null key meets a null key."""
    renamed = slots.withColumnsRenamed({k: f"_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(renamed, condition).drop(*[f"_{k}" for k in keys])


def _running(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("upto", F.sum("n").over(window))


def _holding(counts: DataFrame, todo: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """The entries of ``counts`` that hold a wanted rank, with the rank inside the entry."""
    found = _meet(_running(counts, by, order), todo.select(*by, "idx", "rank"), by)
    return (found.where("rank <= upto AND rank > upto - n")
            .withColumn("rank", F.col("rank") - F.col("upto") + F.col("n")).drop("upto"))


def select_ranks(values: DataFrame, wanted: Callable[[DataFrame], DataFrame], by: Sequence[str] = ("feature",),
                 sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """The value at each wanted rank.

    ``values(*by, v, n)``: ``n`` occurrences of ``v``, a double or a string, not
    null and not NaN. ``wanted`` gets one row ``(*by, total)`` per group and
    returns ``(*by, idx, rank)`` with ranks from 1. Returns ``(*by, idx, v)``.

    Each round reads ``values`` once more, joined to the bins still open; there
    is at most one per wanted rank. All groups go through the rounds together.
    """
    text = values.schema["v"].dataType.typeName() == "string"
    by = list(by)
    keys, rows, todo = list(by), values, None
    for step in count():
        name = f"b{step}"
        if step:
            if text:
                place = _evenly(_next_bytes(F.col("v"), F.col("_shared")), F.col("_low"), F.col("_high"))
            else:
                place = _evenly(F.col("v"), F.col("low"), F.col("high"))
        else:
            place = F.lit(0).cast("bigint") if text else _power(F.col("v"))
        binned = rows.select(*keys, place.alias(name), "v", "n")
        counts = binned.groupBy(*keys, name).agg(
            F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        if todo is None:
            counts = materialise(counts, "rank-bins")
            todo = wanted(counts.groupBy(*by).agg(F.sum("n").alias("total")))
        todo = materialise(_holding(counts, todo, keys, name), "rank-brackets")
        keys.append(name)
        slots = todo.select(*keys, "low", "high").distinct()
        if text:
            slots = slots.withColumn("_shared", _shared("low", "high"))
            slots = slots.withColumns({f"_{c}": _next_bytes(F.col(c), F.col("_shared")) for c in ("low", "high")})
        rows = _meet(binned, slots, keys)
        if todo.where((F.col("low") < F.col("high")) & (F.col("n") > F.lit(sorted_rows))).isEmpty():
            break
    last = rows.groupBy(*keys, "v").agg(F.sum("n").alias("n"))
    return _holding(last, todo, keys, "v").select(*by, "idx", "v")


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    parts = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns]
    return (df.select(*by, F.explode(F.array(*parts)).alias("_p")).select(*by, "_p.*")
            .where("v IS NOT NULL AND NOT isnan(v)").withColumn("n", F.lit(1)))


def _rank_of(p: Column) -> Column:
    return F.greatest(F.ceil(p * F.col("total")), F.lit(1))


def exact_quantiles(df: DataFrame, probs: Mapping[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, idx, p, v)`` for columns and their probabilities: the smallest
    value with at least ``p`` of the (group's) rows at or below it.

    All columns and groups are searched together. ``df`` is read twice and once more
    per further round; ``session.materialise`` it first if it is costly.
    """
    levels = F.create_map(*[x for c, ps in probs.items() for x in (
        F.lit(c), F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(float(p)).alias("p"))
                            for i, p in enumerate(ps)]))])

    def wanted(totals: DataFrame) -> DataFrame:
        return (totals.select(*by, "feature", "total", F.explode(levels[F.col("feature")]).alias("l"))
                .select(*by, "feature", F.col("l.idx").alias("idx"), _rank_of(F.col("l.p")).alias("rank")))

    picked = select_ranks(_long(df, list(probs), by), wanted, [*by, "feature"])
    return picked.select(*by, "feature", "idx", F.get(levels[F.col("feature")], F.col("idx"))["p"].alias("p"), "v")


def grouped_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """``(*by, q)``: an ascending array of exact quantiles of ``value`` per group,
    by the rule of ``exact_quantiles``. Groups without a value are left out.

    A group may have any number of values: its bins are counted map-side, and
    the bins of all groups are narrowed in the same rounds.
    """
    values = (df.select(*by, F.col(value).cast("double").alias("v"))
              .where("v IS NOT NULL AND NOT isnan(v)").withColumn("n", F.lit(1)))
    levels = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])

    def wanted(totals: DataFrame) -> DataFrame:
        return (totals.select(*by, "total", F.explode(levels).alias("l"))
                .select(*by, F.col("l.idx").alias("idx"), _rank_of(F.col("l.p")).alias("rank")))

    return select_ranks(values, wanted, by).groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "v"))), lambda s: s["v"]).alias("q"))


def quantile_arrays(df: DataFrame, probs: Mapping[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """One row (per group that has a value): an ascending array of quantiles under each column's name."""
    q = exact_quantiles(df, probs, by)
    return q.groupBy(*by).agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("feature") == c, F.struct("idx", "v")))),
                    lambda s: s["v"]).alias(c)
        for c in probs])


def split_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """Keys that cut the rows, in key order, into ``n`` parts of equal size:
    ``(split, key)``, the first key of every part but the first. Null keys are
    left out, as are splits beyond the number of rows."""
    counted = materialise(
        df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("feature", F.lit("key")), "key-counts")

    def wanted(totals: DataFrame) -> DataFrame:
        return (totals.select("feature", "total", F.explode(F.sequence(F.lit(1), F.lit(n - 1))).alias("idx"))
                .selectExpr("feature", "idx", f"idx * (total div {n}) + least(idx, total % {n}) + 1 AS rank"))

    return select_ranks(counted, wanted).select(F.col("idx").alias("split"), F.col("v").alias(key))
