"""Wire records: comma-joined telemetry and ride-status messages.

Parsing is a set of column expressions, so the same code reads Kafka values,
text files and in-memory frames, batch or streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..functions.motion import heading_change

# Position of each field, by layout.
L_TAXI = ("jsy", "dbuscard", "speed", "lutc", "longtime", "llon", "llat", "ehstatus", "orientation",
          "wayname", "wayid", "waytype", "overspeedflag", "speedlimit")
L_EVENT = ("jsy", "dbuscard", "speed", "lutc", "longtime", "llon", "llat", "orientation")
L_STAT = ("_unit", "jsy", "speed", "lutc", "longtime", "llon", "llat", "orientation")
L_STAT_OLD = ("jsy", "_unit", "speed", "lutc", "longtime", "llon", "llat", "ehstatus", "orientation")
LAYOUTS = {"taxi": L_TAXI, "event": L_EVENT, "stat": L_STAT, "stat_old": L_STAT_OLD}

NUMBERS = ("speed", "llon", "llat", "orientation", "speedlimit")


def parse_records(df: DataFrame, layout: Sequence[str], value: str = "value", unit: str = "s",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Split ``value`` by the layout. ``unit`` is that of ``longtime`` ("s" or
    "ms"); it comes out in seconds. Fields that do not parse are null, and
    records without driver or time are dropped."""
    parts = F.split(F.col(value).cast("string"), ",")

    def field(i: int, name: str) -> Column:
        raw = F.trim(F.get(parts, i))
        if name in NUMBERS:
            return raw.try_cast("double").alias(name)
        if name == "longtime":
            stamp = raw.try_cast("bigint")
            return (text.millis_to_seconds(stamp) if unit == "ms" else stamp).alias(name)
        return raw.alias(name)

    columns = [field(i, name) for i, name in enumerate(layout) if not name.startswith("_")]
    return df.select(*keep, *columns).where("jsy IS NOT NULL AND longtime IS NOT NULL")


def format_records(df: DataFrame, layout: Sequence[str], unit: str = "s") -> DataFrame:
    """The opposite of ``parse_records``; absent columns stay empty."""
    def field(name: str) -> Column:
        if name == "lutc" and "lutc" not in df.columns:
            return text.time_text(F.col("longtime"))
        if name == "longtime" and unit == "ms":
            return (F.col("longtime") * 1000).cast("string")
        return F.col(name).cast("string") if name in df.columns else F.lit("")

    return df.select(F.concat_ws(",", *[F.coalesce(field(n), F.lit("")) for n in layout]).alias("value"))


def parse_raw_text(lines: DataFrame, value: str = "value") -> DataFrame:
    """Header-less export lines: fields 1 to 6 are driver, time text, position,
    speed and heading; a trailing bracket is removed."""
    parts = F.split(F.col(value), ",")

    def number(i: int) -> Column:
        return F.rtrim(F.get(parts, i), F.lit("]")).try_cast("double")

    return lines.select(
        F.get(parts, 1).alias("jsy"), text.epoch_seconds(F.get(parts, 2)).alias("longtime"),
        number(3).alias("llon"), number(4).alias("llat"), number(5).alias("speed"),
        number(6).alias("orientation"))


def parse_status(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``driver_begin_end[_tag]``; a driver id may itself contain ``_``."""
    pattern = r"^(.*)_(\d+)_(\d+)(?:_([a-z]+))?$"
    v = F.col(value)
    return df.select(
        *keep, F.regexp_extract(v, pattern, 1).alias("jsy"),
        F.regexp_extract(v, pattern, 2).try_cast("bigint").alias("begin_time"),
        F.regexp_extract(v, pattern, 3).try_cast("bigint").alias("end_time"),
        F.nullif(F.regexp_extract(v, pattern, 4), F.lit("")).alias("tag"))


def status_message(trips: DataFrame, tag: str | None = None) -> DataFrame:
    parts = [F.col("jsy"), F.col("begin_time").cast("string"), F.col("end_time").cast("string")]
    return trips.select(F.concat_ws("_", *parts, *([F.lit(tag)] if tag else [])).alias("value"))


def _clock() -> Column:
    """Milliseconds when the row is processed; ``current_timestamp`` stands still for a whole batch."""
    return F.java_method(F.lit("java.lang.System"), F.lit("currentTimeMillis"))


def mark_message(steps: DataFrame, keep_zero: bool = True, last: str = "ehstatus") -> DataFrame:
    """One record of fifteen fields per classified step.

    The mean speed is that of this step for turns, of the step before otherwise.
    ``last`` is the column of the record's last field. Four times in
    milliseconds measure latency: the batch's start, the record's arrival
    (``received`` if there is such a column, else the batch's start), the
    decision and the sending.
    """
    rows = steps.where("mark IS NOT NULL") if keep_zero else steps.where("mark <> 0")
    speed = F.when(F.col("mark") == 3, F.col("average")).otherwise(F.col("pre_average"))
    seconds = F.col("longtime") - F.col("p1.longtime")
    batch = F.unix_millis(F.current_timestamp()).cast("string")
    received = F.unix_millis("received").cast("string") if "received" in steps.columns else batch
    turn = heading_change(F.col("p1.orientation"), F.col("orientation"))
    fields = ["jsy", "dbuscard", text.time_text(F.col("longtime")), *[F.col(c).cast("string") for c in ("llon", "llat", "speed")],
              speed.cast("string"), seconds.cast("string"), turn.cast("string"), F.col("mark").cast("string"), F.col(last),
              batch, received, _clock(), _clock()]
    return rows.select(F.col("jsy").alias("key"), _joined(fields))


def bus_mark_message(marked: DataFrame) -> DataFrame:
    """One record of thirteen fields per classified pair of a bus: driver, vehicle, time, position, the
    speeds of three fixes, expected and driven metres, seconds, turn and mark."""
    fields = ["jsy", "dbuscard", text.time_text(F.col("longtime")),
              *[F.col(c).cast("string") for c in ("llon", "llat", "pp_kmh", "v0_kmh", "v1_kmh")],
              text.fixed(F.col("avg_dist"), 2), text.fixed(F.col("actual_dist"), 2),
              *[F.col(c).cast("string") for c in ("time_interval", "orient", "rapid_mark")]]
    return marked.select(F.col("jsy").alias("key"), _joined(fields))


def _joined(fields: Sequence[Column | str]) -> Column:
    """Comma-joined; an absent field stays as an empty one, so that places hold."""
    return F.concat_ws(",", *[F.coalesce(F.col(f) if isinstance(f, str) else f, F.lit("")) for f in fields]).alias("value")


def score_message(scored: DataFrame) -> DataFrame:
    """Twelve fields: time, driver, current and running score, four over-speed
    counts, three mark counts, minutes."""
    return scored.select(F.col("jsy").alias("key"), F.concat_ws(
        ",", text.time_text(F.col("end_time")), "jsy", text.fixed(F.col("score"), 2),
        text.fixed(F.col("running"), 2), *[F.col(f"over{i}").cast("string") for i in range(4)],
        *[F.col(c).cast("string") for c in ("accelerations", "brakings", "turns")],
        text.fixed(F.col("minutes"), 1)).alias("value"))
