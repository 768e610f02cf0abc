"""Marks into counts, events and alarms.

Events and alarms depend on order: a first mark opens a window, a later one
inside it fires, and where the window opens depends on all that came before.
The history of a (driver, mark) is therefore folded in time chunks. A chunk whose
first mark lies beyond any window of the chunk before starts afresh. The others
are summarised as a table "state on entry -> state on exit"; only window ends
reaching into the chunk's first minutes can differ, so the table is short. The
tables are chained per key, and every chunk is folded from its true entry
state. No key's history has to fit one task, and the result is exactly that of
one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .slices import DAY

# Fixed value: marks within this many seconds belong together.
WINDOW = 180


@dataclass(frozen=True)
class EpisodeRule:
    """When a window opens, closes and fires.

    ``start``: "mark" opens the window at the mark's own time, "pair" at the
    fix before it. ``inclusive``: a mark exactly at the window's end still
    belongs to it. ``fire_at``: the mark that fires, counted from the opening
    one. ``slide``: the window runs from the last recorded mark rather than
    from its opening.
    """

    start: str = "pair"
    inclusive: bool = False
    fire_at: int = 2
    slide: bool = False
    window: int = WINDOW


COUNT_EVENTS = EpisodeRule(start="mark", inclusive=True)
ALARM_2ND = EpisodeRule()
ALARM_3RD = EpisodeRule(fire_at=3)
ALARM_SLIDING = EpisodeRule(slide=True)

_STATE = "struct<ends:bigint,seen:int,opened:bigint,moved:boolean>"


def _step(rule: EpisodeRule) -> tuple[str, str]:
    """SQL for the state after mark ``r`` in state ``s``, and whether ``r`` fires."""
    length = rule.window + (1 if rule.inclusive else 0)
    opened = "r.t" if rule.start == "mark" else "r.pre"
    ends = f"r.t + {length}" if rule.slide else f"{opened} + {length}"
    # repeated marks at one time only matter where marks are counted by time alone
    weight = f"least(r.n, {rule.fire_at})" if rule.start == "mark" else "1"
    opens = "(s.ends IS NULL OR r.t >= s.ends)"
    seen_in = f"cast(least(s.seen + {weight}, {rule.fire_at}) AS int)"
    if rule.slide:
        ends_in = f"CASE WHEN s.seen < {rule.fire_at} THEN r.t + {length} ELSE s.ends END"
        moved_in = f"s.moved OR s.seen < {rule.fire_at}"
    else:
        ends_in, moved_in = "s.ends", "s.moved"
    step = (f"CASE WHEN {opens} THEN named_struct('ends', {ends}, 'seen', cast({weight} AS int), "
            f"'opened', {opened}, 'moved', true) "
            f"ELSE named_struct('ends', {ends_in}, 'seen', {seen_in}, 'opened', s.opened, "
            f"'moved', {moved_in}) END")
    fires = (f"CASE WHEN {opens} THEN cast({weight} AS int) >= {rule.fire_at} "
             f"ELSE s.seen < {rule.fire_at} AND {seen_in} >= {rule.fire_at} END")
    return step, fires


def _entry(seen: str, ends: str) -> str:
    return (f"named_struct('ends', cast({ends} AS bigint), 'seen', cast({seen} AS int), "
            f"'opened', cast(null AS bigint), 'moved', false)")


def _folded(marks: DataFrame, keys: Sequence[str], rule: EpisodeRule, chunk: int) -> DataFrame:
    """Every chunk of every key with its rows and the state it is entered in."""
    pre = "pretime" if rule.start == "pair" else "longtime"
    seconds = (marks.groupBy(*keys, F.col("longtime").alias("t"))
               .agg(F.min(pre).alias("pre"), F.count(F.lit(1)).alias("n"))
               .withColumn("chunk", F.expr(f"t div {chunk}")))
    # at most one row per second of the chunk
    chunks = seconds.groupBy(*keys, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("t", "pre", "n"))).alias("rows"))
    # how chunks hang together: light rows, one per chunk
    in_order = Window.partitionBy(*keys).orderBy("chunk")
    far = F.lit(rule.window + 1)
    heads = chunks.select(*keys, "chunk", F.get("rows", 0)["t"].alias("first"),
                          F.element_at("rows", -1)["t"].alias("last"))
    linked = heads.select(
        *keys, "chunk",
        F.coalesce(F.lag("last").over(in_order) + far <= F.col("first"), F.lit(True)).alias("fresh"),
        F.coalesce(F.col("last") + far > F.lead("first").over(in_order), F.lit(False)).alias("goes_on"),
    ).where("NOT fresh OR goes_on")
    step, _ = _step(rule)
    reach = f"(chunk * {chunk} + {rule.window + 1})"
    classes = f"array_union(transform(filter(rows, r -> r.t < {reach}), r -> r.t), array({reach}))"
    start = _entry("0", "null")
    none = f"cast(array() AS array<struct<upto:bigint,seen:int,after:{_STATE}>>)"
    exits = f"""
        CASE WHEN NOT goes_on THEN {none}
        WHEN fresh THEN array(named_struct('upto', 9223372036854775807L, 'seen', 1,
            'after', aggregate(rows, {start}, (s, r) -> {step})))
        ELSE flatten(transform(sequence(1, {rule.fire_at}), k ->
            transform({classes}, e -> named_struct('upto', e, 'seen', k,
              'after', aggregate(rows, {_entry('k', 'e')}, (s, r) -> {step}))))) END"""
    summary = chunks.join(linked, [*keys, "chunk"]).select(
        *keys, F.struct("chunk", "fresh", F.expr(exits).alias("exits")).alias("part"))
    chained = summary.groupBy(*keys).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    walked = chained.select(*keys, F.explode(F.expr(f"""
        aggregate(parts,
          named_struct('now', {start},
                       'log', cast(array() AS array<struct<chunk:bigint,entry:{_STATE}>>)),
          (acc, c) -> transform(array(CASE WHEN c.fresh THEN {start} ELSE acc.now END), n -> named_struct(
            'now', coalesce(get(transform(
                filter(c.exits, x -> x.seen = greatest(n.seen, 1) AND x.upto >= coalesce(n.ends, 0)),
                x -> named_struct(
                  'ends', CASE WHEN x.after.moved THEN x.after.ends ELSE n.ends END,
                  'seen', x.after.seen,
                  'opened', coalesce(x.after.opened, n.opened), 'moved', false)), 0), n),
            'log', array_append(acc.log, named_struct('chunk', c.chunk, 'entry', n))))[0],
          acc -> acc.log)""")).alias("e")).select(*keys, "e.chunk", "e.entry")
    return (chunks.join(walked, [*keys, "chunk"], "left")
            .withColumn("entry", F.coalesce(F.col("entry"), F.expr(start))))


def fired(marks: DataFrame, keys: Sequence[str] = ("jsy", "rapid_mark"), rule: EpisodeRule = ALARM_2ND,
          chunk: int = DAY) -> DataFrame:
    """One row per firing mark: keys, ``fired_at``, ``opened`` and ``ends``.

    ``marks`` needs ``longtime`` and, for rules starting at the pair,
    ``pretime``. A second mark of a key at the same second is late and is
    ignored, except by the counting rule, where it counts.
    """
    step, fires = _step(rule)
    state = _folded(marks, keys, rule, chunk)
    log = f"""
        aggregate(rows,
          named_struct('now', entry,
                       'log', cast(array() AS array<struct<fired_at:bigint,opened:bigint,ends:bigint>>)),
          (acc, r) -> transform(array(acc.now), s -> transform(array({step}), nxt ->
            named_struct('now', nxt,
              'log', CASE WHEN {fires}
                     THEN array_append(acc.log, named_struct('fired_at', r.t, 'opened', nxt.opened,
                                                             'ends', {'s.ends' if rule.slide else 'nxt.ends'}))
                     ELSE acc.log END))[0])[0],
          acc -> acc.log)"""
    return (state.select(*keys, F.explode(F.expr(log)).alias("f")).select(*keys, "f.*"))


def count_events(marks: DataFrame, keys: Sequence[str] = ("jsy", "rapid_mark"),
                 rule: EpisodeRule = COUNT_EVENTS, chunk: int = DAY) -> DataFrame:
    """Per key: ``marks``, and ``cnt``, the windows that hold a second mark."""
    step, fires = _step(rule)
    total = f"""
        aggregate(rows, named_struct('now', entry, 'total', 0L),
          (acc, r) -> transform(array(acc.now), s -> named_struct(
            'now', {step}, 'total', acc.total + CASE WHEN {fires} THEN 1L ELSE 0L END))[0],
          acc -> acc.total)"""
    return (_folded(marks, keys, rule, chunk)
            .select(*keys, F.expr(total).alias("_n"), F.expr("aggregate(rows, 0L, (a, r) -> a + r.n)").alias("_m"))
            .groupBy(*keys).agg(F.sum("_m").alias("marks"), F.sum("_n").alias("cnt")))


NAMES = {1: "up", 2: "down", 3: "turn"}


def mark_counts(marks: DataFrame, keys: Sequence[str] = ("jsy",), infix: str = "") -> DataFrame:
    """Marks of each kind per key, as columns; kinds that do not occur count 0."""
    return marks.groupBy(*keys).agg(*[
        F.count(F.when(F.col("rapid_mark") == code, 1)).alias(f"{name}_{infix}sudden_count")
        for code, name in NAMES.items()])


def event_counts(marks: DataFrame, keys: Sequence[str] = ("jsy",), chunk: int = DAY) -> DataFrame:
    """Marks and events of each kind per key. Both come from one fold; every
    key with marks has all columns."""
    counted = count_events(marks, [*keys, "rapid_mark"], chunk=chunk)

    def of(kind: int, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("rapid_mark") == kind, F.col(column))), F.lit(0))

    return counted.groupBy(*keys).agg(
        *[of(code, "marks").alias(f"{name}_sudden_count") for code, name in NAMES.items()],
        *[of(code, "cnt").alias(f"{name}_sudden_event") for code, name in NAMES.items()])


def mark_times(marks: DataFrame, keys: Sequence[str] = ("jsy", "rapid_mark"), chunk: int = DAY) -> DataFrame:
    """Sorted mark times per key and how many marks each has, one row per time
    chunk: a row holds at most one entry per second, however many marks there
    are. ``part`` orders a key's rows."""
    seconds = marks.groupBy(*keys, "longtime").agg(F.count(F.lit(1)).alias("n"))
    listed = seconds.withColumn("part", F.expr(f"longtime div {chunk}")).groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(F.struct("longtime", "n"))).alias("_l"))
    return listed.select(*keys, "part", F.transform("_l", lambda x: x["longtime"]).alias("times"),
                         F.transform("_l", lambda x: x["n"]).alias("counts"))
