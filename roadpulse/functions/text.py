"""Time text, keys, formatted numbers and alarm messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_seconds(text: Column, fmt: str = TIME_FORMAT) -> Column:
    """Seconds since the epoch of a time text in the session zone."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(fmt)))


def epoch_millis(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(fmt)))


def time_text(seconds: Column, fmt: str = TIME_FORMAT) -> Column:
    return F.from_unixtime(seconds, fmt)


def millis_to_seconds(millis: Column) -> Column:
    return F.floor(millis / F.lit(1000)).cast("bigint")


def scatter_key(driver: Column, stamp: Column) -> Column:
    """Row key that spreads one driver's newest rows: driver + reversed time."""
    return F.concat_ws("_", driver, F.reverse(stamp.cast("string")))


def fixed(value: Column, digits: int) -> Column:
    """Number text with a fixed count of decimals; ties go away from zero even
    where binary arithmetic left them a little short."""
    nudged = value + F.signum(value) * F.lit(1e-9)
    return F.format_string(f"%.{digits}f", F.round(nudged, digits))


def position(lon: Column, lat: Column) -> Column:
    return F.concat_ws(",", lon.cast("string"), lat.cast("string"))


def alarm_text(mark: Column, accel: Column, up_limit: Column, dn_limit: Column,
               up_min: Column, up_max: Column, dn_min: Column, dn_max: Column,
               actual_m: Column) -> Column:
    """Explanation of a mark; null means that no alarm is raised.

    A speed change with no recorded mileage is not explained and so not raised.
    Marks use the canonical codes 1 (accelerate), 2 (brake), 3 (turn).
    """
    def explain(limit: Column, low: Column, high: Column) -> Column:
        return F.concat(
            F.lit("acceleration "), fixed(accel, 2), F.lit(" (limit "), fixed(limit, 3),
            F.lit("); normal mileage ["), fixed(low, 2), F.lit("m - "), fixed(high, 2),
            F.lit("m]; actual mileage "), fixed(actual_m, 2), F.lit("m"))

    return (F.when((mark == 1) & (actual_m > 0), explain(up_limit, up_min, up_max))
            .when((mark == 2) & (actual_m > 0), explain(dn_limit, dn_min, dn_max))
            .when(mark == 3, F.lit("hard turn")))


def count_code(joined: Column, code: str, separator: str = ":") -> Column:
    """How often ``code`` occurs in a separator-joined list; 0 for null."""
    return F.coalesce(
        F.size(F.filter(F.split(joined, separator), lambda t: t == F.lit(code))), F.lit(0))


def sorted_codes(joined: Column, separator: str = ":") -> Column:
    return F.array_join(F.array_sort(F.split(joined, separator)), separator)


# Mark codes as written by the various producers, mapped to the canonical ones.
# Stream jobs send 5 for a turn, the oldest batch job 4 for an acceleration.
CODE_ALIASES = {"1": 1, "4": 1, "2": 2, "3": 3, "5": 3, "0": 0}


def canonical_mark(code: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for pair in CODE_ALIASES.items() for x in pair])
    return mapping[code.cast("string")]


def sink_mark(mark: Column, turn_code: int = 3, accelerate_code: int = 1) -> Column:
    """Canonical mark to the code a given consumer expects."""
    return (F.when(mark == 3, F.lit(turn_code))
            .when(mark == 1, F.lit(accelerate_code))
            .otherwise(mark))
