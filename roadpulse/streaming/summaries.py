"""Statistics that feed the detector, from mergeable summaries per slide of time.

A slide keeps, per kind of pair and bin of its sorted measure, a count and the
sums that moments need. Summaries of slides add up to those of a window, so
nothing but the window's own slides is ever read again: a batch writes the
slides it touches, publishes the windows that end there, and the detector reads
the folders of the windows it needs. Quartiles are those of the binned measure;
a slide has at most as many rows as bins occur in it, however many pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import text
from ..operators import marks, thresholds
from ..operators.pairs import add_motion
from ..sources.folders import read_folders, replace_folders, span, staged

#: Bins per metre of mileage gap and per degree of turn.
BINS = 10
SUMMARY = ("kind string, bin bigint, n bigint, a1 double, a2 double, b1 double, b2 double, "
           "first bigint, slide bigint, epoch bigint")
NAMES = ("avg_upaspeed", "std_upaspeed", "iqr_updist", "iqr_updist_max", "avg_dnaspeed", "std_dnaspeed", "iqr_dndist",
         "iqr_dndist_max", "avg_turn", "avg_aturn", "std_aturn", "avg_tnspeed", "std_tnspeed")
PUBLISHED = "stat string, window_end bigint"


@dataclass(frozen=True)
class Windows:
    """Windows of ``slides`` slides of ``seconds`` each; turns above ``turn_floor`` degrees set the turn limit."""
    seconds: int = 1800
    slides: int = 4
    turn_floor: float = 45.0

    def slide(self, time: str) -> Column:
        return F.expr(f"`{time}` div {self.seconds}")


def summarise(pairs: DataFrame, windows: Windows) -> DataFrame:
    """kind, bin, n, a1, a2, b1, b2, first, slide of pairs with their published measures.

    ``slide`` holds the later fix, ``first`` the earlier one. Combined map-side.
    """
    def part(kind: str, condition: Column, binned: str, a: str, b: str) -> Column:
        return F.when(condition, F.struct(F.lit(kind).alias("kind"), F.col(binned).alias("x"), F.col(a).alias("a"), F.col(b).alias("b")))

    kinds = F.array_compact(F.array(
        part("up", F.col("aspeed") > 0, "distance", "aspeed", "distance"),
        part("dn", F.col("aspeed") < 0, "distance", "aspeed", "distance"),
        part("turn", F.col("turn").isNotNull(), "turn", "aturn", "tnspeed")))
    rows = pairs.select(windows.slide("pretime").alias("first"), windows.slide("longtime").alias("slide"), F.explode(kinds).alias("k"))
    a, b = F.col("k.a"), F.col("k.b")
    return rows.groupBy("first", "slide", "k.kind", F.floor(F.col("k.x") * BINS + 0.5).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(a).alias("a1"), F.sum(a * a).alias("a2"), F.sum(b).alias("b1"), F.sum(b * b).alias("b2"))


def window_statistics(summary: DataFrame, windows: Windows) -> DataFrame:
    """One row per window: window_end (the slide after its last) and the statistics the detector reads.

    A pair counts in the windows that hold both of its fixes.
    """
    ends = F.sequence(F.col("slide") + 1, F.col("first") + windows.slides)
    rows = (summary.where(F.col("slide") < F.col("first") + windows.slides).withColumn("window_end", F.explode(ends))
            .groupBy("window_end", "kind", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "a1", "a2", "b1", "b2")]))
    turn = F.col("bin") / F.lit(float(BINS))
    # turns: those above the mean of the clear ones
    steep = (F.col("kind") == "turn") & (turn > windows.turn_floor)
    mean = rows.groupBy("window_end").agg(
        (F.sum(F.when(steep, turn * F.col("n"))) / F.sum(F.when(steep, F.col("n")))).alias("avg_turn"))
    rows = rows.join(mean, "window_end").where((F.col("kind") != "turn") | (turn > F.col("avg_turn")))
    order = Window.partitionBy("window_end", "kind").orderBy("bin")
    rows = rows.withColumns({"upto": F.sum("n").over(order), "all": F.sum("n").over(Window.partitionBy("window_end", "kind"))})

    def moments(kind: str, x: str) -> tuple[Column, Column]:
        n, s, q = (F.sum(F.when(F.col("kind") == kind, F.col(c))) for c in ("n", f"{x}1", f"{x}2"))
        return s / n, F.when(n > 1, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0))))

    def quartile(kind: str, p: float) -> Column:
        return F.min(F.when((F.col("kind") == kind) & (F.col("upto") >= F.lit(p) * F.col("all")), F.col("bin"))) / F.lit(float(BINS))

    up, dn, aturn, tnspeed = moments("up", "a"), moments("dn", "a"), moments("turn", "a"), moments("turn", "b")
    stats = rows.groupBy("window_end").agg(
        F.sum(F.when(F.col("kind") != "turn", F.col("n"))).alias("cnt"), F.max("avg_turn").alias("avg_turn"),
        up[0].alias("avg_upaspeed"), up[1].alias("std_upaspeed"), dn[0].alias("avg_dnaspeed"), dn[1].alias("std_dnaspeed"),
        aturn[0].alias("avg_aturn"), aturn[1].alias("std_aturn"), tnspeed[0].alias("avg_tnspeed"), tnspeed[1].alias("std_tnspeed"),
        *[quartile(kind, p).alias(f"q{int(4 * p)}_{kind}") for kind in ("up", "dn") for p in (0.25, 0.75)])
    fences = {f"iqr_{kind}dist{name}": F.col(f"q3_{kind}") + F.lit(k) * (F.col(f"q3_{kind}") - F.col(f"q1_{kind}"))
              for kind in ("up", "dn") for name, k in (("", 1.5), ("_max", 3.0))}
    return stats.withColumns(fences).select("window_end", "cnt", *NAMES)


def pack(stats: DataFrame) -> DataFrame:
    """window_end, stat: one JSON object per window none of whose statistics is missing, with the time and count of pairs in front."""
    complete = F.lit(True)
    for c in NAMES:
        complete &= F.col(c).isNotNull() & ~F.isnan(c)
    time = F.date_format(F.current_timestamp(), text.TIME_FORMAT).alias("time")
    return stats.where(complete).select("window_end", F.to_json(F.struct(time, "cnt", *NAMES)).alias("stat"))


def publish(path: str, windows: Windows = Windows()) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over pairs: adds their summary to ``path``/slides and publishes windows in ``path``/stats.

    A window is published once a later slide has begun, and again if late pairs
    still reach it. A repeated batch writes the same folders again.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        summary = staged(summarise(thresholds.add_published_motion(batch), windows), f"{path}/staged", epoch)
        touched = span(summary, "slide")
        if touched is None:
            return
        low, high = touched
        replace_folders(summary.withColumn("epoch", F.lit(epoch).cast("bigint")), f"{path}/slides", ["slide", "epoch"])
        rows = slides(batch.sparkSession, path, range(low + 1 - windows.slides, high + windows.slides))
        newest = span(rows, "slide")[1]
        stats = window_statistics(rows, windows).where(F.col("window_end").between(low + 1, min(high + windows.slides, newest)))
        replace_folders(pack(stats), f"{path}/stats", ["window_end"])
    return run


def slides(spark: SparkSession, path: str, wanted: range) -> DataFrame:
    return read_folders(spark, f"{path}/slides", "slide", wanted, SUMMARY)


def newest_for(spark: SparkSession, path: str, wanted: range, windows: Windows) -> DataFrame:
    """slide, stats: per wanted slide the newest window that ended before it, not more than a window's length ago."""
    found = read_folders(spark, f"{path}/stats", "window_end", range(wanted.start + 1 - windows.slides, wanted.stop), PUBLISHED)
    stats = F.from_json("stat", ", ".join(f"{n} double" for n in NAMES))
    ends = F.sequence(F.col("window_end"), F.col("window_end") + windows.slides - 1)
    return (found.select("window_end", stats.alias("stats"), F.explode(ends).alias("slide"))
            .groupBy("slide").agg(F.max_by("stats", "window_end").alias("stats")))


def detect(path: str, write: Callable[[DataFrame, int], None], windows: Windows = Windows(), speed: float = 120.0,
           gaps: tuple[int, int] = (5, 60), keep_zero: bool = False) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over pairs: marks with the limits of the newest window before each pair's slide.

    Written are the marked pairs (all judged ones with ``keep_zero``) and the
    ``stats`` they were judged by. Pairs for which no window is published yet
    are not judged.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        kept = batch.where(F.col("time_interval").between(*gaps) & (F.col("v1_kmh") < speed))
        rows = staged(kept.withColumn("slide", windows.slide("longtime")), f"{path}/detector", epoch)
        touched = span(rows, "slide")
        if touched is None:
            return
        stats = newest_for(batch.sparkSession, path, range(touched[0], touched[1] + 1), windows)
        m = add_motion(rows.join(stats, "slide"), limits="ramp")
        mark = marks.band_mark(marks.published_limits("stats"), straight=30.0, turn_first=False)
        write(marks.with_marks(m, mark, keep_zero=keep_zero).drop("slide"), epoch)
    return run
