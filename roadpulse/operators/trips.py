"""Trips: split on ride status, count marks and over-speed levels, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import grading, motion
from .marks import simple_rule
from .pairs import neighbours
from .slices import BLOCK_ROWS, HOUR, before_block

# The status changes that end a bus trip.
BUS_ENDS = (("1", "2"), ("3", "0"))

# Over-speed codes, mildest first.
TAXI_OVER_CODES = ("0", "2", "3", "4")
BUS_OVER_CODES = ("0", "4", "5", "6")


def _pair_rule(before: str, after: str | None) -> Column:
    """Simple-rule mark of the step from struct ``before`` to ``after`` (or the row itself)."""
    def f(name: str) -> Column:
        return F.col(name if after is None else f"{after}.{name}")

    seconds = (f("longtime") - F.col(f"{before}.longtime")).cast("double")
    v0, v1 = F.col(f"{before}.speed"), f("speed")
    a = F.try_divide(v1 - v0, seconds * F.lit(3.6))
    w = motion.turn_rate(motion.heading_change(F.col(f"{before}.orientation"), f("orientation")), seconds)
    return simple_rule(a, w, v0, v1)


def first_per_second(fixes: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Drop fixes that are not later than one already seen; combined map-side."""
    others = [c for c in fixes.columns if c not in (*keys, "longtime", *tie)]
    return (fixes.groupBy(*keys, "longtime").agg(F.min(F.struct(*tie, *others)).alias("_f"))
            .select(*keys, "longtime", "_f.*"))


def step_marks(fixes: DataFrame, keys: Sequence[str] = ("jsy",), tie: Sequence[str] = ("event_id",),
               size: int = BLOCK_ROWS) -> DataFrame:
    """Every fix with the mark of the step that led to it.

    A mark needs two earlier fixes. Of fixes at one second the first counts, the
    others are late, as in the stream. ``raw_mark`` is the rule's result,
    ``mark`` is 0 where it only repeats the previous step's. ``pre_average``
    and ``average`` are mean speeds of the step before and of this one.
    """
    rows = neighbours(first_per_second(fixes, keys, tie), keys, ["longtime", "speed", "orientation", "ehstatus"], back=2,
                      tie=tie, size=size)
    return mark_steps(rows)


def mark_steps(rows: DataFrame) -> DataFrame:
    """Marks of fixes that carry ``rank`` and the fixes before as ``p1``, ``p2``."""
    raw = F.when(F.col("rank") >= 3, _pair_rule("p1", None))
    earlier = F.when(F.col("rank") >= 4, _pair_rule("p2", "p1"))
    return rows.withColumn("raw_mark", raw).withColumns({
        "mark": F.when(F.col("raw_mark") == F.coalesce(earlier, F.lit(-1)), F.lit(0))
                 .otherwise(F.col("raw_mark")),
        "average": (F.col("p1.speed") + F.col("speed")) / F.lit(2.0),
        "pre_average": (F.col("p2.speed") + F.col("p1.speed")) / F.lit(2.0),
    })


def _inner_change() -> Column:
    """Time of a status change that does not end the trip."""
    return F.when(F.col("_changed") & (F.col("_closes") == 0), F.col("longtime"))


def number_trips(steps: DataFrame, keys: Sequence[str] = ("jsy",), ends: Sequence[tuple[str, str]] | None = None,
                 over: Column | None = None) -> DataFrame:
    """Steps with ``trip_no``, the number of trips of the driver that ended before; see ``split_trips``."""
    window = (Window.partitionBy(*keys, "block").orderBy("rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    changed = F.coalesce(F.col("p1.ehstatus") != F.col("ehstatus"), F.lit(False))
    closes = changed
    if ends is not None:
        hits = [(F.col("p1.ehstatus") == a) & (F.col("ehstatus") == b) for a, b in ends]
        any_hit = hits[0]
        for h in hits[1:]:
            any_hit |= h
        closes = changed & any_hit
    rows = steps.withColumns({
        "_over": F.lit(None).cast("string") if over is None else over,
        "_changed": changed, "_closes": F.coalesce(closes, F.lit(False)).cast("int"),
    }).select(*keys, "block", "rank", "longtime", "mark", "_over", "_changed", "_closes",
              F.col("p1.longtime").alias("_before"))
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_closes").over(window), F.lit(0)))
    return before_block(rows, keys, F.col("_closes"), "_ahead").withColumn(
        "trip_no", F.col("_ahead") + F.col("_inside"))


def split_trips(steps: DataFrame, keys: Sequence[str] = ("jsy",),
                ends: Sequence[tuple[str, str]] | None = None,
                over: Column | None = None, over_codes: Sequence[str] = TAXI_OVER_CODES) -> DataFrame:
    """Finished trips with their begin, end and counts.

    ``steps`` comes from ``step_marks``. Any change of ``ehstatus`` starts a
    new ride; it ends a trip too, or only if it is one of ``ends``. The trip
    begins at the last change before its end, its marks count from the last
    trip's end; the mark of the closing fix is included. ``over`` gives the
    over-speed code of a fix (null for none).
    """
    parts = trip_parts(number_trips(steps, keys, ends, over), keys, over_codes)
    return finished_trips(parts, keys)


def trip_parts(numbered: DataFrame, keys: Sequence[str] = ("jsy",), over_codes: Sequence[str] = TAXI_OVER_CODES) -> DataFrame:
    """Sums of each trip of ``number_trips``, finished (``_done`` is 1) or still open; ``join_parts`` adds them up."""
    return numbered.groupBy(*keys, "trip_no").agg(
        F.max(_inner_change()).alias("_change"), F.min("_before").alias("_before"),
        F.min("longtime").alias("_first"), F.max("longtime").alias("end_time"),
        *[F.count(F.when(F.col("_over") == c, 1)).alias(f"over{i}") for i, c in enumerate(over_codes)],
        F.count(F.when(F.col("mark") == 1, 1)).alias("accelerations"),
        F.count(F.when(F.col("mark") == 2, 1)).alias("brakings"),
        F.count(F.when(F.col("mark") == 3, 1)).alias("turns"),
        F.max("_closes").alias("_done"))


def join_parts(parts: DataFrame, keys: Sequence[str] = ("jsy",)) -> DataFrame:
    """One row per trip from parts of it that follow each other in time."""
    kinds = {"_change": F.max, "_before": F.min, "_first": F.min, "end_time": F.max, "_done": F.max}
    return parts.groupBy(*keys, "trip_no").agg(*[
        kinds.get(c, F.sum)(c).alias(c) for c in parts.columns if c not in (*keys, "trip_no")])


def finished_trips(parts: DataFrame, keys: Sequence[str] = ("jsy",)) -> DataFrame:
    """The finished ones of whole trips, with their begin, end, counts and seconds."""
    done = parts.where("_done = 1").withColumn("begin_time", F.coalesce("_change", "_before", "_first"))
    counts = [c for c in parts.columns if c not in (*keys, "trip_no", "_change", "_before", "_first", "end_time", "_done")]
    return (done.select(*keys, "trip_no", "begin_time", "end_time", *counts)
            .withColumn("seconds", F.col("end_time") - F.col("begin_time")))


def trip_mark_lists(steps: DataFrame, keys: Sequence[str] = ("jsy",),
                    ends: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Finished trips with their marks as a ``:``-joined list in time order, "0" if there are none.

    ``text.count_code`` counts codes in the list. Marks are ordered and joined
    inside the blocks of fixes; one trip then only gathers a text per block. The
    list itself is one value, two bytes for every change of mark in the trip.
    """
    parts = number_trips(steps, keys, ends).groupBy(*keys, "trip_no", "block").agg(
        F.max(_inner_change()).alias("_change"), F.min("_before").alias("_before"),
        F.min("longtime").alias("_first"), F.max("longtime").alias("_last"), F.max("_closes").alias("_done"),
        F.concat_ws(":", F.transform(
            F.array_sort(F.collect_list(F.when(F.col("mark") != 0, F.struct("rank", "mark")))),
            lambda m: m["mark"].cast("string"))).alias("_marks"))
    whole = parts.groupBy(*keys, "trip_no").agg(
        F.coalesce(F.max("_change"), F.min("_before"), F.min("_first")).alias("begin_time"),
        F.max("_last").alias("end_time"),
        F.concat_ws(":", F.transform(
            F.array_sort(F.collect_list(F.when(F.col("_marks") != "", F.struct("block", "_marks")))),
            lambda m: m["_marks"])).alias("_list"),
        F.max("_done").alias("_done"))
    return whole.where("_done = 1").select(
        *keys, "begin_time", "end_time", F.when(F.col("_list") == "", F.lit("0")).otherwise(F.col("_list")).alias("marks"))


def score_trips(trips: DataFrame, variant: str = "taxi") -> DataFrame:
    score = grading.trip_score([F.col(f"over{i}") for i in range(4)], F.col("accelerations"),
                               F.col("brakings"), F.col("turns"), F.col("seconds"), variant)
    return trips.withColumns({"score": score,
                              "minutes": F.round(F.col("seconds") / F.lit(60.0) + F.lit(1e-9), 1)})


# --- running score -----------------------------------------------------------

_NEXT = "round((coalesce({s}, {c}) + {c}) / 2 + 1e-9D, 2)"


def _fold(start: str, scores: str = "scores", s: str = "s", c: str = "c") -> str:
    return f"aggregate({scores}, cast({start} AS double), ({s}, {c}) -> {_NEXT.format(s=s, c=c)})"


def running_score(trips: DataFrame, keys: Sequence[str] = ("jsy",), time: str = "end_time",
                  score: str = "score", chunk: int = 6 * HOUR, start: DataFrame | None = None) -> DataFrame:
    """Add ``running``: the mean of the running and the current score, rounded
    to cents after every trip. ``start`` has a row of the keys and ``running``
    for each key that goes on from an earlier score.

    The fold never forgets its start entirely, since rounding can keep a cent
    alive. But it preserves order, and fourteen trips bring any two starts to
    within a cent. So a chunk of trips is summarised by two results and the
    start at which it flips from one to the other (or by its few scores), the
    summaries are chained per key, and each chunk is folded from its true start.
    """
    others = [c for c in trips.columns if c not in keys]
    rows = trips.withColumn("_chunk", F.expr(f"`{time}` div {chunk}"))
    chunks = rows.groupBy(*keys, "_chunk").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col(time).alias("t"), F.col(score).alias("v"), F.struct(*others).alias("trip")))).alias("items")
    ).withColumn("scores", F.transform("items", lambda x: x["v"]))
    if start is None:
        chunks = chunks.withColumn("start", F.lit(None).cast("double"))
    else:
        chunks = chunks.join(start.select(*keys, F.col("running").alias("start")), list(keys), "left")
    # a key's first chunk has no start to learn, its last none to pass on
    in_order = Window.partitionBy(*keys).orderBy("_chunk")
    linked = chunks.select(
        *keys, "_chunk", F.lag("_chunk").over(in_order).isNull().alias("first"),
        F.lead("_chunk").over(in_order).isNull().alias("last")).where("NOT (first AND last)")
    ends = chunks.join(linked, [*keys, "_chunk"]).withColumns({
        "fresh": F.expr(f"CASE WHEN first THEN {_fold('start')} END"),
        "low": F.expr(f"CASE WHEN NOT first AND NOT last THEN {_fold('0')} END"),
        "high": F.expr(f"CASE WHEN NOT first AND NOT last THEN {_fold('100')} END")})
    middle = f"({_fold('((b.lo + b.hi) div 2) / 100D', s='u', c='w')}) >= high"
    flips = F.expr(f"""aggregate(sequence(1, 14), named_struct('lo', 0L, 'hi', 10000L),
        (b, i) -> CASE WHEN b.lo >= b.hi THEN b
                       WHEN {middle} THEN named_struct('lo', b.lo, 'hi', (b.lo + b.hi) div 2)
                       ELSE named_struct('lo', (b.lo + b.hi) div 2 + 1, 'hi', b.hi) END,
        b -> b.hi)""")
    narrow = F.round((F.col("high") - F.col("low")) * 100) <= 1
    summary = ends.select(*keys, F.struct(
        "_chunk", "fresh", "low", "high", F.when(narrow, flips).alias("flip"),
        F.when(~narrow, F.col("scores")).alias("scores")).alias("part"))
    chained = summary.groupBy(*keys).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    after = f"""CASE WHEN acc.now IS NULL THEN p.fresh
        WHEN p.scores IS NOT NULL THEN {_fold('acc.now', 'p.scores')}
        WHEN round(acc.now * 100) >= p.flip THEN p.high ELSE p.low END"""
    entry = chained.select(*keys, F.explode(F.expr(f"""
        aggregate(parts,
          named_struct('now', cast(null AS double),
                       'log', cast(array() AS array<struct<_chunk:bigint,entry:double>>)),
          (acc, p) -> named_struct('now', {after},
            'log', array_append(acc.log, named_struct('_chunk', p._chunk, 'entry', acc.now))),
          acc -> acc.log)""")).alias("e")).select(*keys, "e._chunk", "e.entry")
    walked = chunks.join(entry, [*keys, "_chunk"], "left").withColumn("_running", F.expr(f"""
        aggregate(items, named_struct('now', coalesce(entry, start), 'log', cast(array() AS array<double>)),
          (acc, x) -> transform(array({_NEXT.format(s='acc.now', c='x.v')}), r -> named_struct(
            'now', r, 'log', array_append(acc.log, r)))[0],
          acc -> acc.log)"""))
    return (walked.select(*keys, F.explode(F.arrays_zip("items", F.col("_running").alias("running"))).alias("_w"))
            .select(*keys, "_w.items.trip.*", "_w.running"))


def meet_statuses(over_done: DataFrame, marks_done: DataFrame) -> DataFrame:
    """Trips for which both the over-speed and the mark counts are in, once per trip.

    Either side may repeat a message; (driver, begin, end) is one trip.
    """
    key = ["jsy", "begin_time", "end_time"]
    return over_done.dropDuplicates(key).join(marks_done.dropDuplicates(key), key)
