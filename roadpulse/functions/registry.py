"""The distance functions under their SQL names, for ``spark.sql`` users.

They are SQL-bodied functions, so Catalyst inlines them: no UDF call remains
in the plan and code generation is not broken.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_DIST = """
2 * asin(sqrt(sin(pow(abs(lat1 - lat2) * pi() / 360, 2))
  + sin(pow(abs(lon1 - lon2) * pi() / 360, 2))
  * cos(lat1 * pi() / 180) * cos(lat2 * pi() / 180))) * 6378.137D * 1000"""


def _ramp_sql(first: str, long_form: str, short_form: str) -> str:
    # first: sign of the change; speeds arrive in km/h
    t = f"(({first}) / 3.6D / 2.78D)"
    body = f"CASE WHEN {t} >= 2 THEN {long_form} WHEN {t} > 0 THEN {short_form} ELSE 0D END"
    return (body.replace("$t", t).replace("$a", "(v0 / 3.6D)").replace("$b", "(v1 / 3.6D)"))


_BODIES = {
    "theroyDistUpMin": _ramp_sql(
        "v1 - v0", "$a * (secs - $t) + ($a + $b) / 2 * $t",
        "($a + greatest($b - 5.56D, 0D)) / 2 * (secs - 2) + (greatest($b - 5.56D, 0D) + $b) / 2 * 2"),
    "theroyDistUpMax": _ramp_sql(
        "v1 - v0", "($a + $b) / 2 * $t + $b * (secs - $t)",
        "($a + $a + 5.56D) / 2 * 2 + ($a + 5.56D + $b) / 2 * (secs - 2)"),
    "theroyDistDnMin": _ramp_sql(
        "v0 - v1", "($a + $b) / 2 * $t + $b * (secs - $t)",
        "($a + greatest($a - 5.56D, 0D)) / 2 * 2 + (greatest($a - 5.56D, 0D) + $b) / 2 * (secs - 2)"),
    "theroyDistDnMax": _ramp_sql(
        "v0 - v1", "$a * (secs - $t) + ($a + $b) / 2 * $t",
        "($a + $b + 5.56D) / 2 * (secs - 2) + ($b + 5.56D + $b) / 2 * 2"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create ``Dist`` and the four ``theroyDist*`` functions for this session."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION Dist"
              "(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE RETURN " + _DIST)
    for name, body in _BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
                  f"(v0 DOUBLE, v1 DOUBLE, secs DOUBLE) RETURNS DOUBLE RETURN {body}")
    return ["Dist", *_BODIES]
