"""Plain SQL for every query that SQL can state, over the same tables.

Each text is built from common table expressions and is independent of the
Spark code: windows run per driver, folds are recursive.
"""

from __future__ import annotations

from collections.abc import Callable

ORACLES: dict[str, str] = {}

TEL = """
ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events),
tel AS (
SELECT event_id, cast(user_id AS varchar) AS jsy, 'B' || cast(user_id % 40 AS varchar) AS dbuscard,
  1546300800 + 10*rn + event_id % 7 + 400*(rn // 20) AS longtime,
  least(round(value, 1), cast(130 AS double)) AS speed,
  cast((event_id * 37) % 360 AS double) AS orientation,
  cast(event_id % 8 AS double) AS carheadangle,
  cast(1194000 + rn*5 + (event_id % 11)*2 AS double) / 10000 AS llon,
  cast(322000 + rn*3 + (event_id % 13) AS double) / 10000 AS llat,
  cast((rn // 12) % 4 AS varchar) AS ehstatus,
  event_type AS wayname, cast(event_id % 3 AS varchar) AS waytype,
  CASE WHEN event_id % 5 = 0 THEN 'X' || cast(event_id % 9 AS varchar) END AS roadcross,
  cast(event_id % 4 = 0 AS int) AS isturn,
  CASE WHEN event_id % 6 <> 0 THEN 'S' || cast(event_id % 17 AS varchar) END AS roadsection
FROM ev)"""


def sql(fn: Callable[[], str]) -> Callable[[], str]:
    ORACLES[fn.__name__] = fn()
    return fn


def r(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + cast(0 AS double))"


def rr(names: str, digits: int = 6) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"{r(n, digits)} AS {n}" for n in names.split())


def pairs(name: str = "pr", keys: str = "jsy", before: float | None = None, after: float | None = 80,
          strict: bool = False, lo: int = 5, hi: int | None = 60, heading: str = "orientation", third: bool = False) -> str:
    where = "" if before is None else f"WHERE speed <= {before}"
    keep = f"longtime - pretime >= {lo}" + ("" if hi is None else f" AND longtime - pretime <= {hi}")
    if third:
        keep += " AND pretime > pptime"
    if after is not None:
        keep += f" AND speed < {after}" if strict else f" AND speed <= {after} AND v0 <= {after}"
    return f"""
{name}_w AS (SELECT *, lag(llon) OVER w AS prelon, lag(llat) OVER w AS prelat, lag(longtime) OVER w AS pretime,
  lag(longtime, 2) OVER w AS pptime, lag(speed) OVER w AS v0, lag({heading}) OVER w AS preorien, lag(roadcross) OVER w AS preroadcross,
  lag(isturn) OVER w AS preisturn, lag(speed, 2) OVER w AS pp
  FROM tel {where} WINDOW w AS (PARTITION BY {keys} ORDER BY longtime, event_id)),
{name} AS (SELECT jsy, dbuscard, event_id, ehstatus, roadcross, isturn, roadsection, wayname, waytype,
  preroadcross, preisturn, prelon, prelat, pretime, llon, llat, longtime, pp, v0, speed AS v1,
  v0 / 3.6 AS prespeed, speed / 3.6 AS lspeed, preorien, {heading} AS orientation,
  longtime - pretime AS time_interval
  FROM {name}_w WHERE pretime IS NOT NULL AND {keep})"""


DIST = ("2 * asin(sqrt(sin(pow(abs(prelat - llat) * pi() / 360, 2)) + sin(pow(abs(prelon - llon) * pi() / 360, 2))"
        " * (cos(prelat * pi() / 180) * cos(llat * pi() / 180)))) * 6378.137 * 1000")
HAVERSINE = ("2 * asin(sqrt(pow(sin(abs(prelat - llat) * pi() / 360), 2) + pow(sin(abs(prelon - llon) * pi() / 360), 2)"
             " * (cos(prelat * pi() / 180) * cos(llat * pi() / 180)))) * 6378.137 * 1000")


def limits(variant: str, a: str, b: str, t: str = "time_interval") -> dict[str, str]:
    """Mileage limits in SQL; ``a`` and ``b`` are the speeds in m/s."""
    low_b, low_a = f"greatest({b} - 5.56, 0)", f"greatest({a} - 5.56, 0)"
    up, dn = f"(({b} - {a}) / 2.78)", f"(({a} - {b}) / 2.78)"
    mean = f"(({a} + {b}) / 2)"
    if variant == "truncated":
        return {
            "up_min": f"({a} + {low_b}) / 2 * ({t} - 2) + {low_b} * 2",
            "up_max": f"{a} * 2 + ({a} + 5.56 + {b}) / 2 * ({t} - 2)",
            "dn_min": f"{a} * 2 + ({low_a} + {b}) / 2 * ({t} - 2)",
            "dn_max": f"({a} + {b} + 5.56) / 2 * ({t} - 2) + ({b} + 5.56) * 2"}
    if variant == "steady":
        def ramp(x: str) -> str:
            return f"(CASE WHEN {x} >= 2 THEN {x} WHEN {x} > 0 THEN 2 ELSE 0 END)"
        return {
            "up_min": f"{a} * ({t} - {ramp(up)}) + {mean} * {ramp(up)}",
            "up_max": f"{mean} * {ramp(up)} + {b} * ({t} - {ramp(up)})",
            "dn_min": f"{mean} * {ramp(dn)} + {b} * ({t} - {ramp(dn)})",
            "dn_max": f"{a} * ({t} - {ramp(dn)}) + {mean} * {ramp(dn)}"}

    def pick(x: str, long_form: str, short_form: str) -> str:
        return f"(CASE WHEN {x} >= 2 THEN {long_form} WHEN {x} > 0 THEN {short_form} ELSE 0 END)"
    return {
        "up_min": pick(up, f"{a} * ({t} - {up}) + {mean} * {up}",
                       f"({a} + {low_b}) / 2 * ({t} - 2) + ({low_b} + {b}) / 2 * 2"),
        "up_max": pick(up, f"{mean} * {up} + {b} * ({t} - {up})",
                       f"({a} + {a} + 5.56) / 2 * 2 + ({a} + 5.56 + {b}) / 2 * ({t} - 2)"),
        "dn_min": pick(dn, f"{mean} * {dn} + {b} * ({t} - {dn})",
                       f"({a} + {low_a}) / 2 * 2 + ({low_a} + {b}) / 2 * ({t} - 2)"),
        "dn_max": pick(dn, f"{a} * ({t} - {dn}) + {mean} * {dn}",
                       f"({a} + {b} + 5.56) / 2 * ({t} - 2) + ({b} + 5.56 + {b}) / 2 * 2")}


def motion(src: str = "pr", name: str = "mo", circle: int = 360, variant: str = "truncated",
           divide: bool = False) -> str:
    a, b = ("(prespeed / 3.6)", "(lspeed / 3.6)") if divide else ("prespeed", "lspeed")
    bounds = ", ".join(f"{e} AS {k}" for k, e in limits(variant, a, b).items())
    turn = "abs(orientation - preorien)"
    return f"""
{name}_1 AS (SELECT *, (lspeed - prespeed) / time_interval AS a_speed, (prespeed + lspeed) / 2 AS avg_speed,
  CASE WHEN {turn} > {circle // 2} THEN {circle} - {turn} ELSE {turn} END AS orient,
  {DIST} AS actual_dist, (prespeed + lspeed) / 2 * time_interval AS avg_dist, {bounds} FROM {src}),
{name} AS (SELECT *, orient / time_interval AS angle_speed, abs(actual_dist - avg_dist) AS gap FROM {name}_1)"""


PAIR = ("jsy, event_id, pretime, longtime, time_interval, "
        + rr("prelon prelat llon llat prespeed lspeed preorien orientation"))
MARKED = "jsy, event_id, longtime, " + rr("a_speed orient gap") + ", rapid_mark"


def _pairs_query(**kw) -> str:
    extra = "dbuscard, " if "dbuscard" in kw.get("keys", "") else ""
    return f"WITH {TEL}, {pairs(**kw)} SELECT {extra}{PAIR} FROM pr"


TAXI = dict(keys="jsy, dbuscard", after=120, heading="carheadangle")
ORACLES["pairs_bus"] = _pairs_query()
ORACLES["pairs_taxi"] = _pairs_query(**TAXI)
ORACLES["pairs_prefilter"] = _pairs_query(before=80, after=None, lo=0)
ORACLES["pairs_strict"] = _pairs_query(strict=True)
ORACLES["kinematics"] = f"""WITH {TEL}, {pairs()}, {motion()} SELECT jsy, event_id,
  {rr('a_speed avg_speed orient angle_speed actual_dist avg_dist gap up_min up_max dn_min dn_max')} FROM mo"""
ORACLES["distance_variants"] = f"""WITH {TEL}, {pairs()} SELECT jsy, event_id,
  {r(DIST)} AS reference_m, {r(HAVERSINE)} AS haversine_m FROM pr"""
ORACLES["theoretic_distance"] = f"WITH {TEL}, {pairs()} SELECT jsy, event_id, " + ", ".join(
    f"{r(e)} AS {v}_{k}" for v in ("ramp", "steady", "truncated")
    for k, e in limits(v, "(v0 / 3.6)", "(v1 / 3.6)").items()) + " FROM pr"
ORACLES["crossing_pairs"] = f"""WITH {TEL}, {pairs()} SELECT jsy, event_id,
  CASE WHEN preroadcross IS NOT NULL THEN preroadcross ELSE roadcross END AS iscross,
  CASE WHEN preisturn > 0 THEN preisturn WHEN isturn > 0 THEN isturn ELSE 0 END AS turn_flag FROM pr"""


def published(src: str, name: str = "st", extra: str = "") -> str:
    turn = "abs(orientation - preorien)"
    return f"""
{name}_1 AS (SELECT *, (lspeed - prespeed) / time_interval AS aspeed, (v0 + v1) / 2 AS tnspeed,
  CASE WHEN {turn} > 180 THEN 360 - {turn} ELSE {turn} END AS turn, {DIST} AS actual FROM {src}),
{name} AS (SELECT *, turn / time_interval AS aturn,
  abs(actual - (prespeed + lspeed) / 2 * time_interval) AS distance,
  abs(actual / time_interval * 3.6 - tnspeed) AS speedgap FROM {name}_1)"""


ORACLES["speed_gap"] = f"""WITH {TEL}, {pairs()}, {published('pr')} SELECT jsy, event_id,
  {rr('aspeed turn aturn tnspeed distance speedgap')} FROM st"""


def summary(v: str, s: str, cond: str, quart: bool = True, low: bool = False, rnd: bool = True) -> str:
    f = f"FILTER (WHERE {cond})"
    w = r if rnd else (lambda e: e)
    out = [f"{w(f'avg({v}) {f}')} AS avg_{s}", f"{w(f'stddev_samp({v}) {f}')} AS std_{s}",
           f"{w(f'min({v}) {f}')} AS mi_{s}", f"{w(f'max({v}) {f}')} AS mx_{s}"]
    if quart:
        q = {p: f"quantile_disc({v}, {p}) {f}" for p in (0.25, 0.5, 0.75)}
        spread = f"({q[0.75]} - {q[0.25]})"
        start, sign = (q[0.25], "-") if low else (q[0.75], "+")
        out += [f"{w(q[0.25])} AS approx25_{s}", f"{w(q[0.5])} AS median_{s}", f"{w(q[0.75])} AS approx75_{s}",
                f"{w(f'({start} {sign} 1.5 * {spread})')} AS iqr_{s}",
                f"{w(f'({start} {sign} 3 * {spread})')} AS iqr_{s}_max"]
    return ", ".join(out)


def updn(quart: bool = True, gap: bool = False, rnd: bool = True) -> str:
    out = [summary("aspeed", "upaspeed", "aspeed > 0", quart, rnd=rnd),
           summary("distance", "updist", "aspeed > 0", quart, rnd=rnd),
           summary("aspeed", "dnaspeed", "aspeed < 0", quart, low=True, rnd=rnd),
           summary("distance", "dndist", "aspeed < 0", quart, rnd=rnd)]
    if gap:
        out += [summary("speedgap", "upgap", "aspeed > 0", rnd=rnd), summary("speedgap", "dngap", "aspeed < 0", rnd=rnd)]
    return ", ".join(out)


def turning(cond: str, quart: bool = True, turn: bool = False, rnd: bool = True) -> str:
    out = [summary("aturn", "aturn", cond, quart, rnd=rnd), summary("tnspeed", "tnspeed", cond, quart, rnd=rnd)]
    if turn:
        out.append(summary("turn", "turn", cond, quart, rnd=rnd))
    return ", ".join(out)


def stats(name: str, mode: str, rnd: bool, prefix: str = "sp") -> str:
    """CTEs ending in a one-row ``name`` with the published statistics."""
    speed = 120 if mode == "two_pass" else 80
    base = f"{pairs(prefix, before=speed, after=None, lo=1, hi=None)}, {published(prefix, prefix + 's')}"
    src = f"{prefix}s"
    if mode == "two_pass":
        mean = r("max(avg_turn)") if rnd else "max(avg_turn)"
        return f"""{base},
{name}_t AS (SELECT *, (SELECT avg(turn) FROM {src} WHERE turn > 45) AS avg_turn FROM {src}),
{name} AS (SELECT {updn(rnd=rnd)}, {mean} AS avg_turn, {turning('turn > avg_turn', rnd=rnd)} FROM {name}_t)"""
    if mode == "full":
        return f"{base}, {name} AS (SELECT {updn(gap=True, rnd=rnd)}, {turning('turn > 0', turn=True, rnd=rnd)} FROM {src})"
    return f"{base}, {name} AS (SELECT {updn(False, rnd=rnd)}, {turning('turn > 60', False, True, rnd=rnd)} FROM {src})"


for _query, _mode in (("stats_updn_turn", "two_pass"), ("stats_full", "full"), ("stats_moments", "moments")):
    ORACLES[_query] = f"WITH {TEL}, {stats('stat', _mode, True)} SELECT * FROM stat"

ORACLES["stats_sliding"] = f"""WITH {TEL},
win AS (SELECT *, unnest([longtime // 1800 * 1800 - 5400, longtime // 1800 * 1800 - 3600,
  longtime // 1800 * 1800 - 1800, longtime // 1800 * 1800]) AS window_start FROM tel),
wl AS (SELECT *, lag(llon) OVER w AS prelon, lag(llat) OVER w AS prelat, lag(longtime) OVER w AS pretime,
  lag(speed) OVER w AS v0, lag(orientation) OVER w AS preorien FROM win WHERE speed <= 120
  WINDOW w AS (PARTITION BY window_start, jsy ORDER BY longtime, event_id)),
wp AS (SELECT *, speed AS v1, v0 / 3.6 AS prespeed, speed / 3.6 AS lspeed, longtime - pretime AS time_interval
  FROM wl WHERE pretime IS NOT NULL), {published('wp', 'ws')},
mean AS (SELECT window_start, avg(turn) AS avg_turn FROM ws WHERE turn > 45 GROUP BY window_start),
num AS (SELECT window_start, count(*) AS cnt FROM win GROUP BY window_start)
SELECT window_start, {updn()}, {r('max(avg_turn)')} AS avg_turn, {turning('turn > avg_turn')}, max(cnt) AS cnt
FROM ws JOIN mean USING (window_start) JOIN num USING (window_start) GROUP BY window_start"""


def learned(src: str = "mo", name: str = "lim") -> str:
    return f"""
{name}_q AS (SELECT avg(a_speed) AS avg_aspeed, stddev_samp(a_speed) AS std_aspeed, avg(gap) AS avg_gap,
  stddev_samp(gap) AS std_gap, min(gap) AS mi_gap, max(gap) AS mx_gap, quantile_disc(gap, 0.25) AS approx25_gap,
  quantile_disc(gap, 0.5) AS approx50_gap, quantile_disc(gap, 0.75) AS approx75_gap FROM {src}),
{name} AS (SELECT *, avg_aspeed + 3 * std_aspeed AS threshold_up, avg_aspeed - 3 * std_aspeed AS threshold_dn,
  approx75_gap + 1.5 * (approx75_gap - approx25_gap) AS threshold_gap_min,
  approx75_gap + 3 * (approx75_gap - approx25_gap) AS threshold_gap_max FROM {name}_q)"""


LIMITS = ("threshold_up threshold_dn threshold_gap_min threshold_gap_max avg_gap std_gap mi_gap approx25_gap "
          "approx50_gap approx75_gap mx_gap avg_aspeed std_aspeed")
ORACLES["fences_global"] = f"WITH {TEL}, {pairs()}, {motion()}, {learned()} SELECT {rr(LIMITS)} FROM lim"

ORACLES["turn_threshold"] = f"""WITH {TEL},
{pairs(before=120, after=None, lo=18, hi=22, heading='carheadangle')}, {motion(circle=8)},
turns AS (SELECT orient, (v0 + v1) / 2 AS v, orient / time_interval AS w FROM mo WHERE orient >= 1),
clear AS (SELECT *, (SELECT avg(orient) FROM turns) AS m FROM turns WHERE orient >= (SELECT avg(orient) FROM turns))
SELECT {r('max(m)')} AS avg_orient, {r('avg(v)')} AS avg_speed, {r('stddev_samp(v)')} AS std_speed,
  {r('avg(w)')} AS avg_angle, {r('stddev_samp(w)')} AS std_angle,
  {r('avg(v) + 2 * stddev_samp(v)')} AS speed_limit, {r('avg(w) + 2 * stddev_samp(w)')} AS angle_limit FROM clear"""

ORACLES["driver_speedgap"] = f"""WITH {TEL}, {pairs(before=120, after=None, lo=0)},
g AS (SELECT jsy, round(abs(round({DIST} / time_interval * 3.6, 1) - round((v0 + v1) / 2 + 1e-9, 1)), 2) AS g FROM pr)
SELECT jsy, {r('avg(g)')} AS avg_upgap, {r('stddev_samp(g)')} AS std_upgap, {r('min(g)')} AS mi_upgap,
  {', '.join(f"{r(f'quantile_disc(g, {p})')} AS {n}_upgap" for p, n in
             ((0.25, 'approx25'), (0.5, 'median'), (0.75, 'approx75'), (0.9, 'approx90'), (0.95, 'approx95')))},
  {r('max(g)')} AS mx_upgap FROM g GROUP BY jsy"""

ORACLES["driver_limits"] = f"""WITH {TEL}, {pairs()}, {motion()} SELECT jsy, {r('avg(a_speed)')} AS avg_a,
  {r('stddev_samp(a_speed)')} AS std_a, {r('avg(a_speed) + 3 * stddev_samp(a_speed)')} AS a_hi,
  {r('avg(a_speed) - 3 * stddev_samp(a_speed)')} AS a_lo FROM mo GROUP BY jsy"""

_PROBS = (0, 0.05, 0.2, 0.45, 0.75, 0.9, 1)
ORACLES["quantiles"] = f"WITH {TEL}, {pairs()}, {motion()} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS idx, cast({p} AS double) AS p, {r(f'quantile_disc({c}, {p})')} AS v FROM mo"
    for c in ("a_speed", "gap", "orient") for i, p in enumerate(_PROBS))


# --- marks -------------------------------------------------------------------

def case(*rules: tuple[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {m}" for c, m in rules) + " ELSE 0 END"


def band(up: str, dn: str, lo: str, hi: str, turn: float | str, rate: float | str, speed: float | str,
         straight: float | None = None, turn_first: bool = True, dlo: str | None = None, dhi: str | None = None) -> str:
    dlo, dhi = dlo or lo, dhi or hi
    guard = "" if straight is None else f" AND orient < {straight}"
    a = (f"a_speed > {up} AND (actual_dist > up_max OR actual_dist < up_min) AND gap > {lo} AND gap < {hi}{guard}", 1)
    b = (f"a_speed < {dn} AND (actual_dist > dn_max OR actual_dist < dn_min) AND gap > {dlo} AND gap < {dhi}{guard}", 2)
    t = (f"angle_speed > {rate} AND avg_speed * 3.6 > {speed} AND orient > {turn}", 3)
    return case(t, a, b) if turn_first else case(a, b, t)


def marked(ctes: str, mark: str, src: str = "mo") -> str:
    return f"WITH {TEL}, {ctes}, mk AS (SELECT *, {mark} AS rapid_mark FROM {src}) SELECT {MARKED} FROM mk WHERE rapid_mark <> 0"


LEARNED = f"{learned()}, ml AS (SELECT * FROM mo, lim)"
GAP = dict(lo="threshold_gap_min", hi="threshold_gap_max")
ORACLES["marks_bus_jr"] = marked(f"{pairs()}, {motion()}, {LEARNED}", band(
    "0.5026947901583626", "-0.499124456277012", **GAP, turn=89.30, rate=14.98, speed=28.95, straight=30), "ml")
ORACLES["marks_bus_stat"] = marked(f"{pairs()}, {motion()}, {LEARNED}", band(
    "0.5026947901583626", "-0.499124456277012", **GAP, turn=45, rate=20.486, speed=20), "ml")
ORACLES["marks_bus_pd"] = marked(f"{pairs()}, {motion()}, {LEARNED}", band(
    "threshold_up", "-threshold_up", **GAP, turn=45, rate=20.486, speed=20), "ml")
ORACLES["marks_taxi_dz"] = marked(
    f"{pairs(**TAXI)}, {motion(circle=8, variant='ramp', divide=True)}, {LEARNED}", band(
        "threshold_up", "-threshold_up", **GAP, turn=1.985, rate=0.249, speed=47.422), "ml")
ORACLES["marks_gap_band"] = marked(
    f"{pairs()}, {motion(variant='ramp', divide=True)}, {LEARNED}, "
    "inband AS (SELECT * FROM ml WHERE gap > threshold_gap_min AND gap < threshold_gap_max)",
    case(("a_speed > 0.885 AND (actual_dist > up_max OR actual_dist < up_min)", 1),
         ("a_speed < -0.878 AND (actual_dist > dn_max OR actual_dist < dn_min)", 2)), "inband")
for _name, _pairs, _args in (
        ("marks_bus_detail", dict(strict=True), dict(
            up="0.503", dn="-0.500", lo="19.387", hi="31.020", turn=89.30, rate=14.98, speed=28.95, straight=30)),
        ("marks_bus_event", dict(after=None), dict(
            up="0.885", dn="-0.878", lo="26.256", hi="41.484", turn=89.29677, rate=14.98, speed=28.95)),
        ("marks_taxi_detail_old", dict(after=120, strict=True), dict(
            up="0.414", dn="-0.407", lo="26.256", hi="100", turn=45, rate=20.486, speed=33.79, straight=45)),
        ("marks_taxi_event_old", dict(after=120, strict=True), dict(
            up="0.414", dn="-0.407", lo="26.256", hi="41.484", turn=45, rate=20.486, speed=46.62)),
        ("marks_bus_event_old", dict(after=None, lo=6), dict(
            up="0.885", dn="-0.878", lo="26.256", hi="41.484", turn=45, rate=20.486, speed=33.79))):
    ORACLES[_name] = marked(
        f"{pairs(**_pairs, third=True)}, {motion(variant='truncated' if _name == 'marks_bus_event_old' else 'ramp')}",
        band(**_args, turn_first=False))

ORACLES["marks_taxi_learned"] = marked(
    f"{pairs(after=120, strict=True, third=True)}, {motion(variant='ramp')}, {stats('stat', 'two_pass', False)}, "
    "ms AS (SELECT * FROM mo, stat)",
    band("avg_upaspeed + 3 * std_upaspeed", "avg_dnaspeed - 3 * std_upaspeed", "iqr_updist", "iqr_updist_max",
         turn="avg_turn", rate="avg_aturn + 3 * std_aturn", speed="avg_tnspeed + 3 * std_tnspeed",
         straight=30, turn_first=False, dlo="iqr_dndist", dhi="iqr_dndist_max"), "ms")

SIMPLE = case(("a_speed > 0.763468 AND v1 > 20.5", 1), ("a_speed < -0.763468 AND v0 > 20.5", 2),
              ("angle_speed > 11.5 AND (v0 + v1) / 2 > 20.5", 3))
FREE = f"{pairs(after=None)}, {motion()}"
SIMPLE_MARKS = f"{FREE}, mk AS (SELECT * FROM (SELECT *, {SIMPLE} AS rapid_mark FROM mo) WHERE rapid_mark <> 0)"
DETAIL = band("0.503", "-0.500", "19.387", "31.020", 89.30, 14.98, 28.95, straight=30, turn_first=False)
DETAIL_MARKS = (f"{pairs(strict=True, third=True)}, {motion(variant='ramp')}, "
                f"mk AS (SELECT * FROM (SELECT *, {DETAIL} AS rapid_mark FROM mo) WHERE rapid_mark <> 0)")
THIRD = f"{pairs(after=None, lo=1, hi=None, third=True)}, {motion()}"
ORACLES["marks_simple"] = marked(THIRD, SIMPLE)

_FAST = "(v0 + v1) / 2 > avg_tnspeed + std_tnspeed"
ORACLES["marks_or_rule"] = marked(
    f"{THIRD}, {stats('stat', 'moments', False)}, ms AS (SELECT * FROM mo, stat)",
    case((f"""(a_speed > avg_upaspeed + 2 * std_upaspeed AND gap > avg_updist + std_updist)
      OR (a_speed > avg_upaspeed + 3 * std_upaspeed AND {_FAST})
      OR (a_speed > 0 AND gap > avg_updist + 3 * std_updist AND time_interval <= 30)""", 1),
         (f"""(a_speed < avg_dnaspeed - 2 * std_dnaspeed AND gap > avg_dndist + std_dndist)
      OR (a_speed < avg_dnaspeed - 3 * std_dnaspeed AND {_FAST})
      OR (a_speed < 0 AND gap > avg_dndist + 3 * std_dndist AND time_interval <= 30)""", 2),
         (f"angle_speed > avg_aturn + std_aturn AND orient > 60 AND {_FAST}", 3)), "ms")

ORACLES["marks_iqr_rule"] = marked(
    f"{THIRD}, {stats('stat', 'full', False)}, "
    "ms AS (SELECT *, abs(actual_dist / time_interval * 3.6 - (v0 + v1) / 2) AS vgap FROM mo, stat)",
    case(("a_speed > iqr_upaspeed AND gap > iqr_updist AND vgap > iqr_upgap AND time_interval <= 30", 1),
         ("a_speed < iqr_dnaspeed AND gap > iqr_dndist AND vgap > iqr_dngap AND time_interval <= 30", 2),
         ("angle_speed > iqr_aturn AND orient > iqr_turn AND (v0 + v1) / 2 > iqr_tnspeed", 3)), "ms")

ORACLES["marks_brief"] = marked(f"""
bw AS (SELECT *, lag(llon) OVER w AS prelon, lag(llat) OVER w AS prelat, lag(longtime) OVER w AS pretime,
  lag(longtime, 2) OVER w AS pptime, lag(speed) OVER w AS v0, lag(orientation) OVER w AS preorien
  FROM tel WINDOW w AS (PARTITION BY jsy ORDER BY longtime, event_id)),
pr AS (SELECT *, v0 / 3.6 AS prespeed, speed / 3.6 AS lspeed, longtime - pretime AS time_interval
  FROM bw WHERE pptime IS NOT NULL AND pretime - pptime <= 20), {motion()}""",
    case(("a_speed > 0.2438", 1), ("a_speed < -0.2381", 2),
         ("angle_speed > 2.1968 AND avg_speed * 3.6 > 29.843 AND orient > 45", 3)))

ORACLES["mark_dedup"] = f"""WITH {TEL}, {SIMPLE_MARKS},
l AS (SELECT *, lag(longtime) OVER w AS pt, lag(rapid_mark) OVER w AS pm FROM mk
  WINDOW w AS (PARTITION BY jsy ORDER BY longtime, event_id))
SELECT jsy, event_id, longtime, rapid_mark FROM l WHERE pt IS NULL OR longtime - pt > 15 OR rapid_mark <> pm"""


# --- limits per driver -------------------------------------------------------

def sigma(smooth: bool = False) -> str:
    change = "(lspeed - prespeed) / (longtime - pretime)"
    if smooth:
        change = (f"({change} + (latspeed - lspeed) / (lattime - longtime)"
                  " + (latspeed - prespeed) / (lattime - pretime)) / 3")
    turn = "abs(orientation - preorien)"
    return f"""{pairs('sv', before=80, after=None, hi=20)},
nb AS (SELECT jsy, event_id, llat, llon, longtime, lspeed, orientation, roadcross, roadsection, wayname, waytype,
  lag(longtime) OVER w AS pretime, lag(lspeed) OVER w AS prespeed, lag(orientation) OVER w AS preorien,
  lag(roadcross) OVER w AS precross, lead(longtime) OVER w AS lattime, lead(lspeed) OVER w AS latspeed,
  lead(orientation) OVER w AS latorien, lead(roadcross) OVER w AS latcross
  FROM sv WINDOW w AS (PARTITION BY jsy ORDER BY longtime, event_id)),
de_1 AS (SELECT *, {change} AS a_speed, (prespeed + lspeed) / 2 AS avg_speed,
  CASE WHEN {turn} > 180 THEN 360 - {turn} ELSE {turn} END AS orient FROM nb),
de AS (SELECT *, orient / (longtime - pretime) AS angle_speed FROM de_1)"""


SIGMA_SPEED = """
sl AS (SELECT jsy, avg(a_speed) + 1.5 * stddev_samp(a_speed) AS a_hi,
  avg(a_speed) - 1.5 * stddev_samp(a_speed) AS a_lo FROM de GROUP BY jsy),
s1 AS (SELECT * FROM (SELECT de.*, a_hi, a_lo, CASE WHEN a_speed > a_hi THEN 1 WHEN a_speed < a_lo THEN 2 ELSE 0 END
  AS rapid_mark FROM de LEFT JOIN sl USING (jsy)) WHERE rapid_mark <> 0),
s2 AS (SELECT *, lag(longtime) OVER w AS pt, lag(rapid_mark) OVER w AS pm FROM s1
  WINDOW w AS (PARTITION BY jsy ORDER BY longtime, event_id)),
speed_marks AS (SELECT * FROM s2 WHERE (pt IS NULL OR longtime - pt > 15 OR rapid_mark <> pm)
  AND roadsection IS NOT NULL)"""
SIGMA_TURN = """
tl AS (SELECT jsy, avg(avg_speed) + stddev_samp(avg_speed) AS v_limit,
  avg(angle_speed) + stddev_samp(angle_speed) AS g_limit FROM de WHERE orient > 45 GROUP BY jsy),
turn_marks AS (SELECT de.*, v_limit, g_limit, coalesce(precross, roadcross, latcross) AS iscross, 1 AS angle_mark
  FROM de JOIN tl USING (jsy) WHERE orient > 45 AND avg_speed > v_limit AND angle_speed > g_limit
  AND coalesce(precross, roadcross, latcross) IS NOT NULL)"""
ORACLES["accel_smoothed"] = f"""WITH {TEL}, {sigma(True)}
SELECT jsy, event_id, {rr('a_speed avg_speed orient angle_speed')} FROM de"""
ORACLES["marks_driver_sigma"] = f"""WITH {TEL}, {sigma()}, {SIGMA_SPEED}
SELECT jsy, event_id, longtime, {rr('a_speed a_hi a_lo')}, rapid_mark FROM speed_marks"""
ORACLES["crossing_match"] = f"""WITH {TEL}, {sigma()}, {SIGMA_TURN}
SELECT jsy, event_id, longtime, iscross, {rr('avg_speed angle_speed v_limit g_limit')}, angle_mark FROM turn_marks"""
ORACLES["rapid_turn_outer"] = f"""WITH {TEL}, {sigma()}, {SIGMA_SPEED}, {SIGMA_TURN},
both_marks AS (SELECT coalesce(a.jsy, b.jsy) AS jsy, coalesce(a.longtime, b.longtime) AS longtime,
  a.roadsection, b.iscross, a.rapid_mark, b.angle_mark
  FROM speed_marks a FULL OUTER JOIN turn_marks b ON a.jsy = b.jsy AND a.longtime = b.longtime)
SELECT de.jsy AS user_id, de.longtime AS timestamp, pretime AS pre_timestamp, lattime AS lat_timestamp,
  {r('llat')} AS lat, {r('llon')} AS lon, {r('prespeed * 3.6')} AS pre_speed, {r('lspeed * 3.6')} AS speed,
  {r('latspeed * 3.6')} AS lat_speed, {r('preorien')} AS pre_orientation, {r('orientation')} AS orientation,
  {r('latorien')} AS lat_orientation, b.iscross AS "cross", b.roadsection AS section, wayname AS way_name,
  waytype AS way_type, b.rapid_mark AS rapid_change, b.angle_mark AS rapid_turn,
  cast(event_id % 2 AS varchar) AS flag, cast(event_id % 3 AS int) AS direct_flag
FROM de JOIN both_marks b ON de.jsy = b.jsy AND de.longtime = b.longtime"""


# --- counts, events, alarms --------------------------------------------------

def _counts(keys: str, infix: str) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE rapid_mark = {i}) AS {n}_{infix}sudden_count"
                     for i, n in ((1, "up"), (2, "down"), (3, "turn")))
    return f"SELECT {keys}, {cols} FROM mk GROUP BY {keys}"


ORACLES["mark_counts"] = f"WITH {TEL}, {SIMPLE_MARKS} {_counts('jsy', '')}"
ORACLES["mark_counts_eh"] = f"WITH {TEL}, {SIMPLE_MARKS} {_counts('jsy, ehstatus', 'eh_')}"
ORACLES["mark_times"] = f"""WITH {TEL}, {SIMPLE_MARKS} SELECT jsy, rapid_mark, longtime // 86400 AS part,
  string_agg(DISTINCT cast(longtime AS varchar), ',' ORDER BY cast(longtime AS varchar)) AS times,
  count(*) AS marks FROM mk GROUP BY ALL"""


def fold_events(src: str, keys: str, name: str = "ec") -> str:
    """Recursive count of anchored 180 s events per key over ``src``."""
    on = " AND ".join(f"q.{k.strip()} = f.{k.strip()}" for k in keys.split(","))
    q = ", ".join(f"q.{k.strip()}" for k in keys.split(","))
    return f"""
{name}_q AS (SELECT {keys}, longtime AS t, row_number() OVER (PARTITION BY {keys} ORDER BY longtime) AS n FROM {src}),
{name}_f AS (SELECT {keys}, n, t AS a, 0 AS flag, cast(0 AS bigint) AS cnt FROM {name}_q WHERE n = 1
  UNION ALL SELECT {q}, q.n, CASE WHEN q.t - f.a <= 180 THEN f.a ELSE q.t END,
  CASE WHEN q.t - f.a <= 180 THEN 1 ELSE 0 END,
  f.cnt + CASE WHEN q.t - f.a <= 180 AND f.flag = 0 THEN 1 ELSE 0 END
  FROM {name}_f f JOIN {name}_q q ON {on} AND q.n = f.n + 1),
{name} AS (SELECT {keys}, max(cnt) AS cnt FROM {name}_f GROUP BY {keys})"""


_EVENTS = ", ".join(f"cast(coalesce(max(cnt) FILTER (WHERE rapid_mark = {i}), 0) AS bigint) AS {n}_sudden_event"
                    for i, n in ((1, "up"), (2, "down"), (3, "turn")))
ORACLES["event_counts"] = f"""WITH RECURSIVE {TEL}, {SIMPLE_MARKS}, {fold_events('mk', 'jsy, rapid_mark')},
c AS ({_counts('jsy', '')}), e AS (SELECT jsy, {_EVENTS} FROM ec GROUP BY jsy) SELECT * FROM c JOIN e USING (jsy)"""


def alarms(fire_at: int = 2, slide: bool = False) -> str:
    opening = "q.t + 180" if slide else "q.pre + 180"
    first = "t + 180" if slide else "pre + 180"
    inside = "q.t > f.t AND q.t < f.ends"
    moved = f"CASE WHEN f.seen < {fire_at} THEN q.t + 180 ELSE f.ends END" if slide else "f.ends"
    end_out = "f.ends"
    return f"""WITH RECURSIVE {TEL}, {SIMPLE_MARKS},
aq AS (SELECT jsy, rapid_mark, longtime AS t, pretime AS pre,
  row_number() OVER (PARTITION BY jsy, rapid_mark ORDER BY longtime) AS n FROM mk),
af AS (SELECT jsy, rapid_mark, n, t, {first} AS ends, 1 AS seen, pre AS opened, false AS fired,
    cast(null AS bigint) AS end_out FROM aq WHERE n = 1
  UNION ALL SELECT q.jsy, q.rapid_mark, q.n, q.t, CASE WHEN {inside} THEN {moved} ELSE {opening} END,
    CASE WHEN {inside} THEN least(f.seen + 1, {fire_at}) ELSE 1 END,
    CASE WHEN {inside} THEN f.opened ELSE q.pre END,
    {inside} AND f.seen = {fire_at} - 1, {end_out}
  FROM af f JOIN aq q ON q.jsy = f.jsy AND q.rapid_mark = f.rapid_mark AND q.n = f.n + 1)
SELECT jsy, rapid_mark, t AS fired_at, opened, end_out AS ends FROM af WHERE fired"""


ORACLES["alarms_2nd"] = alarms()
ORACLES["alarms_3rd"] = alarms(3)
ORACLES["alarms_sliding"] = alarms(slide=True)


def _num(e: str, digits: int) -> str:
    return f"printf('%.{digits}f', round({e} + sign({e}) * 1e-9, {digits}))"


def _tip(limit: str, low: str, high: str) -> str:
    return (f"'acceleration ' || {_num('a_speed', 2)} || ' (limit ' || {_num(limit, 3)} || '); normal mileage [' || "
            f"{_num(low, 2)} || 'm - ' || {_num(high, 2)} || 'm]; actual mileage ' || {_num('actual_dist', 2)} || 'm'")


ORACLES["alarm_texts"] = f"""WITH {TEL}, {DETAIL_MARKS} SELECT jsy, event_id,
  jsy || '_' || reverse(cast(longtime AS varchar)) AS rowkey,
  strftime(make_timestamp(pretime * 1000000), '%Y-%m-%d %H:%M:%S') AS start_time,
  strftime(make_timestamp(longtime * 1000000), '%Y-%m-%d %H:%M:%S') AS end_time,
  CASE WHEN rapid_mark = 1 AND actual_dist > 0 THEN {_tip('0.503', 'up_min', 'up_max')}
       WHEN rapid_mark = 2 AND actual_dist > 0 THEN {_tip('-0.500', 'dn_min', 'dn_max')}
       WHEN rapid_mark = 3 THEN 'hard turn' END AS tips FROM mk"""


# --- trips -------------------------------------------------------------------

STEPS = """
tw AS (SELECT *, lag(longtime) OVER w AS t1, lag(speed) OVER w AS v1, lag(orientation) OVER w AS o1,
  lag(ehstatus) OVER w AS e1, lag(speed, 2) OVER w AS v2, row_number() OVER w AS rank
  FROM tel WINDOW w AS (PARTITION BY jsy ORDER BY longtime, event_id)),
ts_1 AS (SELECT *, (speed - v1) / ((longtime - t1) * 3.6) AS a,
  (CASE WHEN abs(orientation - o1) > 180 THEN 360 - abs(orientation - o1) ELSE abs(orientation - o1) END)
  / (longtime - t1) AS w FROM tw),
ts_2 AS (SELECT *, CASE WHEN rank < 3 THEN NULL WHEN a > 0.763468 AND speed > 20.5 THEN 1
  WHEN a < -0.763468 AND v1 > 20.5 THEN 2 WHEN w > 11.5 AND (speed + v1) / 2 > 20.5 THEN 3 ELSE 0 END AS raw_mark
  FROM ts_1),
steps AS (SELECT *, CASE WHEN raw_mark = lag(raw_mark) OVER (PARTITION BY jsy ORDER BY longtime, event_id) THEN 0
  ELSE raw_mark END AS mark FROM ts_2)"""
ORACLES["step_marks"] = f"""WITH {TEL}, {STEPS} SELECT jsy, event_id, raw_mark, mark,
  {r('(speed + v1) / 2')} AS average, {r('(v1 + v2) / 2')} AS pre_average FROM steps WHERE raw_mark IS NOT NULL"""


def trips(codes: tuple[str, ...], bus: bool = False) -> str:
    closes = "e1 IS NOT NULL AND e1 <> ehstatus"
    if bus:
        closes += " AND ((e1 = '1' AND ehstatus = '2') OR (e1 = '3' AND ehstatus = '0'))"
    over = (f"CASE WHEN speed > 120 THEN '{codes[3]}' WHEN speed > 100 THEN '{codes[2]}' "
            f"WHEN speed > 80 THEN '{codes[1]}' WHEN speed > 60 THEN '{codes[0]}' END")
    counts = ", ".join(f"count(*) FILTER (WHERE over_code = '{c}') AS over{i}" for i, c in enumerate(codes))
    return f"""{STEPS},
tn AS (SELECT *, cast({closes} AS int) AS closes, coalesce(e1 <> ehstatus, false) AS changed, {over} AS over_code
  FROM steps),
tg AS (SELECT *, coalesce(sum(closes) OVER (PARTITION BY jsy ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), 0) AS trip_no FROM tn),
trip AS (SELECT jsy, trip_no, coalesce(max(longtime) FILTER (WHERE changed AND closes = 0), min(t1), min(longtime))
  AS begin_time, max(longtime) AS end_time, {counts},
  count(*) FILTER (WHERE mark = 1) AS accelerations, count(*) FILTER (WHERE mark = 2) AS brakings,
  count(*) FILTER (WHERE mark = 3) AS turns FROM tg GROUP BY jsy, trip_no HAVING max(closes) = 1),
tt AS (SELECT *, end_time - begin_time AS seconds FROM trip)"""


TAXI_TRIPS, BUS_TRIPS = trips(("0", "2", "3", "4")), trips(("0", "4", "5", "6"), True)
ORACLES["trips_any"] = f"WITH {TEL}, {TAXI_TRIPS} SELECT * EXCLUDE (trip_no) FROM tt"
ORACLES["trips_bus"] = f"WITH {TEL}, {BUS_TRIPS} SELECT * EXCLUDE (trip_no) FROM tt"
ORACLES["trip_mark_lists"] = f"""WITH {TEL}, {TAXI_TRIPS}, l AS (SELECT jsy, trip_no,
  string_agg(cast(mark AS varchar), ':' ORDER BY rank) AS marks, string_agg(cast(mark AS varchar), ':' ORDER BY mark) AS sorted_marks
  FROM tg WHERE mark <> 0 GROUP BY ALL)
SELECT jsy, begin_time, end_time, coalesce(marks, '0') AS marks, coalesce(sorted_marks, '0') AS sorted_marks,
  cast(accelerations AS int) AS n1, cast(brakings AS int) AS n2, cast(turns AS int) AS n3 FROM tt LEFT JOIN l USING (jsy, trip_no)"""

_POINTS = ("least(cast(floor(over0 + 1.5 * over1 + 2 * over2 + 2.5 * over3) AS int), 50) + least(accelerations, 20)"
           " + least(brakings, 20) + least(turns, 10)")
TAXI_SCORE = f"(sqrt(100 - ({_POINTS}) * (1 - tanh(seconds / 3600))) * 10)"
BUS_SCORE = f"(sqrt((100 - ({_POINTS})) * tanh(seconds / 3600)) * 10)"
_MINUTES = r("round(seconds / 60 + 1e-9, 1)", 4)
ORACLES["trip_scores"] = f"""WITH {TEL}, {TAXI_TRIPS}
SELECT jsy, begin_time, end_time, {r(TAXI_SCORE, 4)} AS score, {_MINUTES} AS minutes FROM tt"""
ORACLES["trip_scores_bus"] = f"""WITH {TEL}, {BUS_TRIPS}
SELECT jsy, begin_time, end_time, {r(BUS_SCORE, 4)} AS score, {_MINUTES} AS minutes FROM tt"""
ORACLES["running_score"] = f"""WITH RECURSIVE {TEL}, {TAXI_TRIPS},
rq AS (SELECT jsy, end_time, {TAXI_SCORE} AS score, row_number() OVER (PARTITION BY jsy ORDER BY end_time) AS n FROM tt),
rf AS (SELECT jsy, n, end_time, score, round(score + 1e-9, 2) AS running FROM rq WHERE n = 1
  UNION ALL SELECT q.jsy, q.n, q.end_time, q.score, round((f.running + q.score) / 2 + 1e-9, 2)
  FROM rf f JOIN rq q ON q.jsy = f.jsy AND q.n = f.n + 1)
SELECT jsy, end_time, round(score, 2) AS score, running FROM rf"""
ORACLES["status_rendezvous"] = f"""WITH {TEL}, {TAXI_TRIPS}
SELECT jsy, begin_time, end_time, {r(TAXI_SCORE, 4)} AS score FROM tt WHERE accelerations + brakings + turns > 3"""


# --- driver scores -----------------------------------------------------------

def weights_sql(src: str) -> str:
    return f"""rows_ AS (SELECT matrix_id, i, sum(v) AS r FROM {src} GROUP BY ALL),
sized AS (SELECT *, count(*) OVER (PARTITION BY matrix_id) AS n FROM rows_),
cons AS (SELECT a.matrix_id, a.i, a.n, sum((a.r - b.r) / (2 * (a.n - 1)) + 0.5) AS s
  FROM sized a JOIN sized b USING (matrix_id) WHERE a.n > 1 GROUP BY ALL)
SELECT matrix_id, i, {r('2.0 / (n * (n - 1)) * s + 1.0 / n - 1.0 / (n - 1)')} AS weight FROM cons"""


ORACLES["ahp_weights"] = f"""WITH q AS (SELECT l_suppkey AS matrix_id, l_returnflag AS f, sum(l_quantity) AS q
  FROM lineitem GROUP BY ALL),
m AS (SELECT a.matrix_id, a.f AS i, b.f AS j, a.q / (a.q + b.q) AS v FROM q a JOIN q b USING (matrix_id)),
{weights_sql('m')}"""

_KINDS = ["over", "over_b", "over_c", "section", "cross", "station",
          *[f"{p}_{x}" for p in ("section", "cross", "station") for x in "bc"], "mark1", "mark2", "mark3"]
INPUTS = f"""{FREE},
si AS (SELECT *, {SIMPLE} AS rapid_mark, CASE event_id % 3 WHEN 0 THEN 'section' WHEN 1 THEN 'cross' ELSE 'station' END
  AS place, CASE WHEN v1 > 100 THEN 'c' WHEN v1 > 80 THEN 'b' WHEN v1 > 60 THEN 'a' END AS lv FROM mo),
kinds AS (SELECT jsy, longtime, 'over' AS kind FROM si WHERE lv IS NOT NULL
  UNION ALL SELECT jsy, longtime, 'over_' || lv FROM si WHERE lv IS NOT NULL
  UNION ALL SELECT jsy, longtime, place FROM si WHERE lv IS NOT NULL
  UNION ALL SELECT jsy, longtime, place || '_' || lv FROM si WHERE lv IS NOT NULL
  UNION ALL SELECT jsy, longtime, 'mark' || rapid_mark FROM si WHERE rapid_mark <> 0),
{fold_events('kinds', 'jsy, kind')},
pe AS (SELECT jsy, {', '.join(f"max(cnt) FILTER (WHERE kind = '{k}') AS ev_{k}" for k in _KINDS)} FROM ec GROUP BY jsy),
tot AS (SELECT jsy, sum(actual_dist / 1000) AS km,
  coalesce(sum(actual_dist / 1000) FILTER (WHERE ehstatus IN ('1', '3')), 0) AS loaded_km,
  coalesce(sum(actual_dist / 1000) FILTER (WHERE ehstatus NOT IN ('1', '3')), 0) AS empty_km,
  coalesce(sum(time_interval) FILTER (WHERE lv IS NOT NULL), 0) AS over_time,
  coalesce(sum(time_interval) FILTER (WHERE lv IN ('b', 'c')), 0) AS over_time_event,
  {', '.join(f"count(*) FILTER (WHERE place = '{p}' AND lv IS NOT NULL) AS {p}_count" for p in ('section', 'cross', 'station'))},
  {', '.join(f"count(*) FILTER (WHERE place = '{p}' AND lv = '{x}') AS {p}_{x}_count"
             for p in ('section', 'cross', 'station') for x in 'abc')},
  {', '.join(f"count(*) FILTER (WHERE lv = '{x}') AS over_{x}" for x in 'abc')},
  {', '.join(f"count(*) FILTER (WHERE rapid_mark = {i}) AS mark{i}" for i in (1, 2, 3))} FROM si GROUP BY jsy),
inp AS (SELECT tot.*, {', '.join(f"coalesce(ev_{k}, 0) AS ev_{k}" for k in _KINDS)} FROM tot LEFT JOIN pe USING (jsy))"""

DIMS = ("over_count", "over_level", "over_time", "rapid_up", "rapid_down", "rapid_turn")


def _sum(terms: list[tuple[float, str]]) -> str:
    return "(" + " + ".join(f"cast({w!r} AS double) * ({e})" for w, e in terms) + ")"


# Weights worked out from the judgement matrices by hand.
OVER, MARKS = [13 / 48, 1 / 3, 19 / 48], [23 / 60, 1 / 3, 17 / 60]
PLACE, ABC, BC = [31 / 120, 77 / 240, 101 / 240], [5 / 24, 1 / 3, 11 / 24], [0.3, 0.7]
OVER_SHARE, MARKS_SHARE = 0.65, 0.35
TAXI_OVER, TAXI_MARKS, TAXI_MILEAGE = 13 / 30, 83 / 240, 53 / 240


def bus_tree(event: bool = False) -> dict[str, list[float]]:
    levels = BC if event else ABC
    return {"total": [*[OVER_SHARE * x for x in OVER], *[MARKS_SHARE * x for x in MARKS]], "count": PLACE, "level": PLACE,
            "section": levels, "station": levels, "cross": levels}


def taxi_tree(event: bool = False) -> dict[str, list[float]]:
    return {"total": [*[TAXI_OVER * x for x in OVER], *[TAXI_MARKS * x for x in MARKS], TAXI_MILEAGE],
            "level": BC if event else ABC, "mileage": [0.3, 0.7]}


def _bus_features() -> str:
    w, e = bus_tree(), bus_tree(event=True)

    def level(p: str, xs: str, t: dict, col: str) -> str:
        return _sum([(t[p][i], f"{col.format(p=p, x=x)} / km") for i, x in enumerate(xs)])
    det, ev = "{p}_{x}_count", "ev_{p}_{x}"
    f = {
        "over_count": _sum([(w["count"][0], "(section_count + 1) / km"), (w["count"][1], "cross_count / km"),
                            (w["count"][2], "station_count / km")]),
        "over_level": _sum([(w["level"][0], level("section", "abc", w, det)),
                            (w["level"][1], level("cross", "abc", w, det)),
                            (w["level"][2], level("station", "abc", w, det))]),
        "over_time": "(over_time + 1) / km", "rapid_up": "(mark1 + 1) / km", "rapid_down": "(mark2 + 1) / km",
        "rapid_turn": "(mark3 + 1) / km",
        "over_count_event": _sum([(e["count"][i], f"ev_{p} / km") for i, p in enumerate(("section", "cross", "station"))]),
        "over_level_event": _sum([(e["level"][0], level("section", "bc", e, ev)),
                                  (e["level"][1], level("station", "bc", e, ev)),
                                  (e["level"][2], level("cross", "bc", e, ev))]),
        "over_time_event": "over_time_event / km", "rapid_up_event": "ev_mark1 / km",
        "rapid_down_event": "ev_mark2 / km", "rapid_turn_event": "ev_mark3 / km"}
    return "fe AS (SELECT jsy AS user_id, " + ", ".join(f"{v} AS {k}" for k, v in f.items()) + " FROM inp)"


def _taxi_features() -> str:
    w, e = taxi_tree(), taxi_tree(event=True)
    f = {
        "mileage": _sum([(w["mileage"][0], "loaded_km / km"), (w["mileage"][1], "empty_km / km")]),
        "over_count": "(over_a + over_b + over_c + 1) / km",
        "over_level": _sum([(w["level"][i], f"(over_{x} + 1) / km") for i, x in enumerate("abc")]),
        "over_time": "(over_time + 1) / km", "rapid_up": "(mark1 + 1) / km", "rapid_down": "(mark2 + 1) / km",
        "rapid_turn": "(mark3 + 1) / km", "over_count_event": "ev_over / km",
        "over_level_event": _sum([(e["level"][i], f"ev_over_{x} / km") for i, x in enumerate("bc")]),
        "over_time_event": "over_time_event / km", "rapid_up_event": "ev_mark1 / km",
        "rapid_down_event": "ev_mark2 / km", "rapid_turn_event": "ev_mark3 / km"}
    return ("fe AS (SELECT jsy AS user_id, " + ", ".join(f"{v} AS {k}" for k, v in f.items())
            + " FROM inp WHERE km > 5)")


_EVENT_DIMS = [f"{d}_event" for d in DIMS]
ORACLES["features_bus"] = (f"WITH RECURSIVE {TEL}, {INPUTS}, {_bus_features()} "
                           f"SELECT user_id, {rr(' '.join([*DIMS, *_EVENT_DIMS]))} FROM fe")
ORACLES["features_taxi"] = (f"WITH RECURSIVE {TEL}, {INPUTS}, {_taxi_features()} "
                            f"SELECT user_id, {rr(' '.join(['mileage', *DIMS, *_EVENT_DIMS]))} FROM fe")

BANDS = ((80, 95), (75, 80), (70, 75), (60, 70), (50, 60), (35, 50))
BANDS_OLD = ((85, 95), (75, 85), (70, 75), (60, 70), (50, 60), (35, 50))


def _score(c: str, bands: tuple, interpolate: bool) -> str:
    def inside(i: int) -> str:
        lo, hi, (base, top) = f"q_{c}[{i + 1}]", f"q_{c}[{i + 2}]", bands[i]
        if interpolate:
            return f"{base} + ({hi} - {c}) / nullif({hi} - {lo}, 0) * {top - base}"
        return f"{base} + ({hi} - {c}) / nullif({hi} - {lo} * {top - base}, 0)"
    rules = " ".join(f"WHEN {c} >= q_{c}[{i + 1}] AND {c} <= q_{c}[{i + 2}] THEN {inside(i)}" for i in range(5))
    return f"CASE WHEN {c} = 0 THEN cast(100 AS double) {rules} ELSE {inside(5)} END"


def _scores(kind: str, bands: tuple = BANDS, interpolate: bool = False, cap: bool = True) -> str:
    features = _taxi_features() if kind == "taxi" else _bus_features()
    extra = ["mileage"] if kind == "taxi" else []
    detail_probs = (0, 0.05, 0.2, 0.45, 0.75, 0.9, 1)
    event_probs = detail_probs if kind == "taxi" else (0, 0.05, 0.3, 0.5, 0.8, 0.95, 1)

    def arrays(cols: list[str], probs: tuple) -> list[str]:
        return [f"[{', '.join(f'quantile_disc({c}, {p})' for p in probs)}] AS q_{c}" for c in cols]
    cols = [*extra, *DIMS, *_EVENT_DIMS]
    qs = ", ".join([*arrays([*extra, *DIMS], detail_probs), *arrays(_EVENT_DIMS, event_probs)])
    graded = ", ".join(f"{_score(c, bands, interpolate)} AS {c}" for c in cols)
    blended = ", ".join([*[f"{c} AS {c}_score" for c in extra],
                         *[f"0.7 * {d} + 0.3 * {d}_event AS {d}_score" for d in DIMS]])
    total = (taxi_tree() if kind == "taxi" else bus_tree())["total"]
    parts = [f"{d}_score" for d in (*DIMS, *extra)]
    capped = [f"CASE WHEN {p} = 100 THEN 95 ELSE {p} END" if cap else p for p in parts]
    comp = _sum(list(zip(total, capped)))
    names = [f"{d}_score" for d in (*extra, *DIMS)]
    return (f"WITH RECURSIVE {TEL}, {INPUTS}, {features}, qq AS (SELECT {qs} FROM fe), "
            f"gr AS (SELECT user_id, {graded} FROM fe, qq), bl AS (SELECT user_id, {blended} FROM gr) "
            f"SELECT user_id, {rr(' '.join(names), 4)}, {r(comp, 4)} AS comprehensive_score FROM bl")


ORACLES["scores_bus"] = _scores("bus")
ORACLES["scores_bus_plain"] = _scores("bus", BANDS_OLD, True, False)
ORACLES["scores_taxi"] = _scores("taxi")


# --- accidents ---------------------------------------------------------------

ACC = f"""{TAXI_TRIPS},
sc AS (SELECT jsy, round((avg({TAXI_SCORE}) - 90) * 10 + 1e-9, 2) AS comprehensive_score FROM tt GROUP BY jsy),
ac AS (SELECT event_id AS accident_no, CASE WHEN event_id % 50 <> 0 THEN cast(user_id AS varchar) END AS driver
  FROM events WHERE event_type = 'error' AND value > 150),
ak AS (SELECT accident_no, cast(cast(coalesce(driver, '000000') AS bigint) AS varchar) AS jsy FROM ac),
sa AS (SELECT jsy, comprehensive_score, accident_no FROM sc JOIN ak USING (jsy)),
edge AS (SELECT unnest(range(0, 100, 10)) AS low)"""


def _hist(src: str, name: str) -> str:
    return (f"SELECT low || '-' || (low + 10) AS bins, count(s.jsy) AS {name} FROM edge LEFT JOIN {src} s "
            "ON s.comprehensive_score >= low AND s.comprehensive_score < low + 10 GROUP BY low")


ORACLES["score_hist"] = f"WITH {TEL}, {ACC} {_hist('sc', 'score_count')}"
ORACLES["accident_scores"] = f"WITH {TEL}, {ACC} SELECT * FROM sa"
ORACLES["accident_rate"] = f"""WITH {TEL}, {ACC}, h1 AS ({_hist('sc', 'score_count')}), h2 AS ({_hist('sa', 'accident_count')})
SELECT bins, score_count, accident_count, {r('coalesce(accident_count / nullif(score_count, 0), 0)')} AS accident_rate
FROM h1 JOIN h2 USING (bins)"""


# --- cells -------------------------------------------------------------------

CELLS = """
ord AS (SELECT reverse(cast(o_orderkey AS varchar)) AS rowkey, o_orderkey, printf('%.2f', o_totalprice) AS price,
  o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS priority FROM orders),
cell AS (
  SELECT rowkey, 'o' AS family, 'price' AS qualifier, o_orderkey AS version, price AS value FROM ord
  UNION ALL SELECT rowkey, 'o', 'status', o_orderkey, status FROM ord
  UNION ALL SELECT rowkey, 'm', 'date', o_orderkey, date FROM ord
  UNION ALL SELECT rowkey, 'm', 'priority', o_orderkey, priority FROM ord
  UNION ALL SELECT rowkey, 'o', 'price', o_orderkey + 1000000000, '9' || price FROM ord WHERE o_orderkey % 3 = 0),
newest AS (SELECT rowkey, family, qualifier, max(version) AS version, arg_max(value, version) AS value
  FROM cell WHERE value IS NOT NULL GROUP BY ALL)"""


def _wide(columns: dict[str, list[str]]) -> str:
    return f"WITH {CELLS} SELECT rowkey, " + ", ".join(
        f"max(value) FILTER (WHERE family = '{f}' AND qualifier = '{c}') AS {f}_{c}"
        for f, cs in columns.items() for c in cs) + " FROM newest GROUP BY rowkey"


ORACLES["cells_put"] = f"WITH {CELLS} SELECT * FROM cell WHERE value IS NOT NULL"
ORACLES["cells_read"] = _wide({"o": ["price", "status"], "m": ["priority"]})
ORACLES["cells_families"] = f"WITH {CELLS} SELECT rowkey, " + ", ".join(
    f"max({v}) FILTER (WHERE family = '{f}' AND qualifier = '{c}') AS {f}_{c}{end}"
    for v, end in (("value", ""), ("version", "_version")) for f, c in (("o", "price"), ("o", "status"), ("m", "date"), ("m", "priority"))
) + " FROM newest WHERE family IN ('o', 'm') GROUP BY rowkey"
ORACLES["cells_read_ts"] = f"""WITH {CELLS} SELECT rowkey, value AS price, version FROM newest
WHERE family = 'o' AND qualifier = 'price'"""
ORACLES["cells_where"] = f"""WITH {CELLS} SELECT * FROM cell WHERE rowkey >= '3' AND rowkey < '6'
AND qualifier = 'status' AND value = 'F'"""
ORACLES["cells_get"] = f"""WITH {CELLS} SELECT * FROM newest WHERE rowkey IN
(SELECT reverse(cast(l_orderkey AS varchar)) FROM lineitem WHERE l_quantity = 50)"""
ORACLES["cells_delete"] = f"""WITH {CELLS},
k AS (SELECT c.*, o.o_orderkey AS k FROM cell c JOIN ord o USING (rowkey) WHERE value IS NOT NULL)
SELECT rowkey, family, qualifier, version, value FROM k WHERE k % 11 <> 0
  AND NOT (k % 7 = 0 AND family = 'm') AND NOT (k % 5 = 0 AND family = 'o' AND qualifier = 'status')
  AND NOT (k % 13 = 0 AND family = 'm' AND qualifier IN ('date', 'priority'))
  AND NOT (k % 9 = 0 AND qualifier = 'price' AND version = k + 1000000000)"""
ORACLES["cells_delete_listed"] = f"""WITH {CELLS},
k AS (SELECT c.*, o.o_orderkey AS k FROM cell c JOIN ord o USING (rowkey) WHERE value IS NOT NULL)
SELECT rowkey, family, qualifier, version, value FROM k
WHERE NOT (k % 3 = 0 AND family = 'o' AND qualifier = 'price' AND (k % 2 <> 0 OR version = k))"""
ORACLES["cells_bulk_load"] = f"""WITH {CELLS} SELECT * FROM cell
WHERE value IS NOT NULL AND family = 'o' AND rowkey >= '3' AND rowkey < '6'"""
SPLITS = """tile AS (SELECT rowkey, ntile(8) OVER (ORDER BY rowkey) AS n FROM cell WHERE value IS NOT NULL),
split AS (SELECT cast(n - 1 AS int) AS split, min(rowkey) AS rowkey FROM tile WHERE n > 1 GROUP BY n)"""
ORACLES["cells_splits"] = f"WITH {CELLS}, {SPLITS} SELECT * FROM split"
ORACLES["cells_regions"] = f"""WITH {CELLS}, {SPLITS},
p AS (SELECT rowkey, cast((SELECT count(*) FROM split s WHERE s.rowkey <= cell.rowkey) AS int) AS region FROM cell
  WHERE value IS NOT NULL)
SELECT region, count(*) AS cells, min(rowkey) AS first_key, max(rowkey) AS last_key FROM p GROUP BY region"""
_DETAIL_COLUMNS = {
    "dbuscard": "dbuscard", "time": "strftime(make_timestamp(longtime * 1000000), '%Y-%m-%d %H:%M:%S')", "lut": "cast(llon AS varchar)",
    "lat": "cast(llat AS varchar)", "ppspeed": "cast(pp AS varchar)", "pspeed": "cast(v0 AS varchar)", "speed": "cast(v1 AS varchar)",
    "actualMileage": _num("actual_dist", 2), "theryAvgMileage": _num("avg_dist", 2), "theroyUpMin": _num("up_min", 2),
    "theroyUpMax": _num("up_max", 2), "theroyDnMin": _num("dn_min", 2), "theroyDnMax": _num("dn_max", 2),
    "timeInterval": "cast(time_interval AS varchar)", "angle": "cast(orient AS varchar)",
    "status": "CASE rapid_mark WHEN 3 THEN '5' ELSE cast(rapid_mark AS varchar) END"}
DETAIL_CELLS = " UNION ALL ".join(
    f"SELECT jsy || '_' || reverse(cast(longtime AS varchar)) AS rowkey, 'cf' AS family, '{name}' AS qualifier, longtime AS version, "
    f"{e} AS value FROM mk" for name, e in _DETAIL_COLUMNS.items())
ORACLES["mark_detail_cells"] = f"WITH {TEL}, {DETAIL_MARKS} {DETAIL_CELLS}"


# --- records and snapshots ---------------------------------------------------

ORACLES["wire_round_trip"] = f"""WITH {TEL} SELECT jsy, dbuscard, longtime,
  {rr('speed llon llat orientation')} FROM tel"""
ORACLES["raw_text_parse"] = f"WITH {TEL} SELECT jsy, longtime, {rr('llon llat speed orientation')} FROM tel"
ORACLES["raw_text_files"] = ORACLES["raw_text_parse"]
ORACLES["csv_append"] = ORACLES["driver_limits"]
_TIME = "strftime(make_timestamp(longtime * 1000000), '%Y-%m-%d %H:%M:%S')"
_TURN = "CASE WHEN abs(orientation - o1) > 180 THEN 360 - abs(orientation - o1) ELSE abs(orientation - o1) END"
ORACLES["mark_messages"] = f"""WITH {TEL}, {STEPS},
st AS (SELECT *, CASE WHEN mark = 3 THEN (speed + v1) / 2 ELSE (v1 + v2) / 2 END AS mean, {_TURN} AS turn FROM steps)
SELECT jsy AS key, cast(15 AS int) AS fields, true AS in_order, jsy || ',' || dbuscard || ',' || {_TIME} || ',' || llon || ',' || llat
  || ',' || speed || ',' || mean || ',' || (longtime - t1) || ',' || turn || ',' || mark || ',' || ehstatus AS record
FROM st WHERE mark IS NOT NULL"""
ORACLES["bus_mark_messages"] = (ORACLES["marks_or_rule"][:ORACLES["marks_or_rule"].rindex(" SELECT ")]
    + f""" SELECT jsy AS key, jsy || ',' || dbuscard || ',' || {_TIME} || ',' || llon || ',' || llat || ',' || pp || ',' || v0 || ',' || v1
  || ',' || {_num('avg_dist', 2)} || ',' || {_num('actual_dist', 2)} || ',' || time_interval || ',' || orient || ',' || rapid_mark AS value FROM mk""")
ORACLES["published_snapshot"] = f"""WITH {TEL}, {stats('stat', 'two_pass', True)}
SELECT stat.*, true AS time, (SELECT count(*) FROM tel WHERE speed <= 120) AS cnt FROM stat"""
ORACLES["ride_status"] = f"""WITH {TEL}, {TAXI_TRIPS} SELECT jsy, begin_time, end_time, cast(null AS varchar) AS tag FROM tt"""
ORACLES["json_snapshot"] = f"""WITH {TEL}, {stats('stat', 'two_pass', True)}
SELECT avg_upaspeed, std_upaspeed, iqr_updist, iqr_dnaspeed, avg_turn, std_aturn FROM stat"""


ORACLES["csv_round_trip"] = f"""WITH {TEL} SELECT jsy, dbuscard, wayname, waytype, ehstatus,
  {rr('llon llat speed carheadangle')}, strftime(make_timestamp(longtime * 1000000), '%Y-%m-%d %H:%M:%S') AS lutc,
  longtime, strftime(make_timestamp(longtime * 1000000), '%Y%m') AS month FROM tel"""
ALARM_ROWS = f"""tip AS (SELECT *, CASE WHEN rapid_mark = 1 AND actual_dist > 0 THEN {_tip('0.503', 'up_min', 'up_max')}
  WHEN rapid_mark = 2 AND actual_dist > 0 THEN {_tip('-0.500', 'dn_min', 'dn_max')}
  WHEN rapid_mark = 3 THEN 'hard turn' END AS tips FROM mk)
SELECT dbuscard, jsy AS dguid, strftime(make_timestamp(pretime * 1000000), '%Y-%m-%d %H:%M:%S') AS starttime,
  strftime(make_timestamp(longtime * 1000000), '%Y-%m-%d %H:%M:%S') AS endtime, time_interval AS contime,
  CASE rapid_mark WHEN 3 THEN '5' ELSE cast(rapid_mark AS varchar) END AS alarmtype, 0 AS alarmlevel,
  sha256(jsy || '_' || pretime || '_' || longtime || '_' || rapid_mark) AS uid, tips,
  prelon || ',' || prelat AS startpos, llon || ',' || llat AS endpos FROM tip WHERE tips IS NOT NULL"""
ORACLES["alarm_rows"] = f"WITH {TEL}, {DETAIL_MARKS}, {ALARM_ROWS}"
ORACLES["score_messages"] = f"""WITH RECURSIVE {TEL}, {TAXI_TRIPS},
rq AS (SELECT *, {TAXI_SCORE} AS score, row_number() OVER (PARTITION BY jsy ORDER BY end_time) AS n FROM tt),
rf AS (SELECT jsy, n, round(score + 1e-9, 2) AS running FROM rq WHERE n = 1
  UNION ALL SELECT q.jsy, q.n, round((f.running + q.score) / 2 + 1e-9, 2)
  FROM rf f JOIN rq q ON q.jsy = f.jsy AND q.n = f.n + 1)
SELECT jsy AS key, concat_ws(',', strftime(make_timestamp(end_time * 1000000), '%Y-%m-%d %H:%M:%S'), jsy,
  {_num('score', 2)}, {_num('running', 2)}, over0, over1, over2, over3, accelerations, brakings, turns,
  printf('%.1f', round(seconds / 60 + 1e-9, 1))) AS value FROM rq JOIN rf USING (jsy, n)"""
ORACLES["trip_lookup"] = f"""WITH {TEL}, {TAXI_TRIPS} SELECT jsy, begin_time, end_time,
  CASE WHEN accelerations > 2 THEN accelerations ELSE 0 END AS accelerations,
  CASE WHEN accelerations > 2 THEN turns ELSE 0 END AS turns FROM tt"""
ORACLES["sql_functions"] = f"WITH {TEL}, {pairs()} SELECT jsy, event_id, {r(DIST)} AS metres, " + ", ".join(
    f"{r(e)} AS {k}" for k, e in limits("ramp", "(v0 / 3.6)", "(v1 / 3.6)").items()) + " FROM pr"
ORACLES["cells_put_forms"] = """WITH o AS (SELECT *, reverse(cast(o_orderkey AS varchar)) AS rowkey FROM orders)
SELECT rowkey, 'h' AS family, 'status' AS qualifier, o_orderkey AS version, o_orderstatus AS value FROM o
UNION ALL SELECT rowkey, 'h', 'priority', o_orderkey, o_orderpriority FROM o
UNION ALL SELECT rowkey, 'n', 'status', 5, o_orderstatus FROM o
UNION ALL SELECT rowkey, 'v', 'priority', o_custkey, o_orderpriority FROM o"""


# --- streams -----------------------------------------------------------------

STREAM = """
raw_fix AS (SELECT cast(user_id AS varchar) AS jsy, event_id, cast(floor(epoch(ts)) AS bigint) // 600 AS longtime,
  least(round(value, 1), cast(130 AS double)) AS speed, cast((event_id * 37) % 360 AS double) AS orientation,
  cast(1194000 + event_id % 1000 AS double) / 10000 AS llon, cast(322000 + event_id % 700 AS double) / 10000 AS llat,
  cast(event_id % 4 AS varchar) AS ehstatus FROM events{where}),
tel AS (SELECT * FROM raw_fix
  QUALIFY row_number() OVER (PARTITION BY jsy, longtime ORDER BY event_id) = 1)"""
EVERY = STREAM.format(where="")
ORACLES["stream_steps"] = f"""WITH {EVERY}, {STEPS} SELECT jsy, event_id, longtime, raw_mark, mark FROM steps
WHERE raw_mark IS NOT NULL"""
ORACLES["stream_scores"] = f"""WITH RECURSIVE {EVERY}, {TAXI_TRIPS},
rq AS (SELECT *, {TAXI_SCORE} AS score, row_number() OVER (PARTITION BY jsy ORDER BY end_time) AS n FROM tt),
rf AS (SELECT jsy, n, round(score + 1e-9, 2) AS running FROM rq WHERE n = 1
  UNION ALL SELECT q.jsy, q.n, round((f.running + q.score) / 2 + 1e-9, 2)
  FROM rf f JOIN rq q ON q.jsy = f.jsy AND q.n = f.n + 1)
SELECT jsy, begin_time, end_time, over0, over1, over2, over3, accelerations, brakings, turns,
  round(score, 2) AS score, running FROM rq JOIN rf USING (jsy, n)"""
ORACLES["stream_alarms"] = alarms().replace(f"{TEL}, {SIMPLE_MARKS}", f"{EVERY}, {STEPS}, mk AS (SELECT jsy, "
    "raw_mark AS rapid_mark, longtime, t1 AS pretime FROM steps WHERE raw_mark <> 0)")
ORACLES["stream_windows"] = f"""WITH {EVERY.replace('FROM raw_fix', 'FROM raw_fix WHERE speed <= 120')},
sw AS (SELECT *, lag(llon) OVER w AS prelon, lag(llat) OVER w AS prelat, lag(longtime) OVER w AS pretime,
  lag(speed) OVER w AS v0, lag(orientation) OVER w AS preorien
  FROM tel WINDOW w AS (PARTITION BY jsy ORDER BY longtime, event_id)),
wp AS (SELECT *, speed AS v1, v0 / 3.6 AS prespeed, speed / 3.6 AS lspeed, longtime - pretime AS time_interval
  FROM sw WHERE pretime IS NOT NULL), {published('wp', 'wq')},
ws AS (SELECT *, unnest([longtime // 300 * 300 - 900, longtime // 300 * 300 - 600, longtime // 300 * 300 - 300,
  longtime // 300 * 300]) AS window_start FROM wq)
SELECT window_start, {updn(False)}, {turning('turn > 60', False, True)} FROM ws
WHERE pretime >= window_start GROUP BY window_start"""


# fixes of the stream with the columns that pairs look at
STREAM_FIXES = EVERY.replace("tel AS (SELECT * FROM raw_fix", "tel AS (SELECT *, 'B' || (cast(jsy AS bigint) % 40) AS dbuscard, "
                             "NULL AS roadcross, 0 AS isturn, NULL AS roadsection, NULL AS wayname, NULL AS waytype FROM raw_fix")
ORACLES["stream_simple"] = f"""WITH {STREAM_FIXES}, {pairs(after=None, lo=1, hi=None)}, {motion()},
mk AS (SELECT *, {SIMPLE} AS rapid_mark FROM mo) SELECT jsy, event_id, longtime, time_interval, rapid_mark FROM mk WHERE rapid_mark <> 0"""
ORACLES["stream_fixed_detail"] = f"WITH {STREAM_FIXES}, {DETAIL_MARKS}, {ALARM_ROWS}"
ORACLES["stream_detail_cells"] = f"WITH {STREAM_FIXES}, {DETAIL_MARKS} {DETAIL_CELLS}"
_EVENT = band("0.885", "-0.878", "26.256", "41.484", 89.29677, 14.98, 28.95, turn_first=False)
_FIRED = alarms().replace(f"{TEL}, {SIMPLE_MARKS}", f"{STREAM_FIXES}, {pairs(after=None, third=True)}, {motion(variant='ramp')}, "
    f"mk AS (SELECT * FROM (SELECT *, {_EVENT} AS rapid_mark FROM mo) WHERE rapid_mark <> 0)")
ORACLES["stream_event_alarms"] = f"""SELECT 'B' || (cast(jsy AS bigint) % 40) AS dbuscard, jsy AS dguid,
  strftime(make_timestamp(opened * 1000000), '%Y-%m-%d %H:%M:%S') AS starttime,
  strftime(make_timestamp(ends * 1000000), '%Y-%m-%d %H:%M:%S') AS endtime, 180 AS contime, cast(rapid_mark AS varchar) AS alarmtype,
  0 AS alarmlevel, 0 AS deal, sha256(jsy || '_' || opened || '_' || rapid_mark) AS uid, 0 AS speed, 0 AS wspeed FROM ({_FIRED})"""


def _fences(kind: str, condition: str) -> str:
    """Fences of the mileage gap, to a tenth of a metre, over the pairs of each window."""
    return f"""
{kind}_x AS (SELECT e, floor(distance * 10 + 0.5) AS x, count(*) AS n FROM lw WHERE {condition} GROUP BY ALL),
{kind}_c AS (SELECT e, x, sum(n) OVER (PARTITION BY e ORDER BY x) AS upto, sum(n) OVER (PARTITION BY e) AS n FROM {kind}_x),
{kind}_q AS (SELECT e, min(x) FILTER (WHERE upto >= 0.25 * n) / 10 AS q1, min(x) FILTER (WHERE upto >= 0.75 * n) / 10 AS q3 FROM {kind}_c GROUP BY e)"""


_LEARNED = band("avg_upaspeed + 3 * std_upaspeed", "avg_dnaspeed - 3 * std_upaspeed", "iqr_updist", "iqr_updist_max",
                turn="avg_turn", rate="avg_aturn + 3 * std_aturn", speed="avg_tnspeed + 3 * std_tnspeed",
                straight=30, turn_first=False, dlo="iqr_dndist", dhi="iqr_dndist_max")
ORACLES["stream_learned"] = f"""WITH {STREAM_FIXES},
lf AS (SELECT *, lag(llon) OVER w AS prelon, lag(llat) OVER w AS prelat, lag(longtime) OVER w AS pretime,
  lag(speed) OVER w AS v0, lag(orientation) OVER w AS preorien FROM (SELECT * FROM raw_fix WHERE speed <= 120
  QUALIFY row_number() OVER (PARTITION BY jsy, longtime ORDER BY event_id) = 1) WINDOW w AS (PARTITION BY jsy ORDER BY longtime)),
lp AS (SELECT *, speed AS v1, v0 / 3.6 AS prespeed, speed / 3.6 AS lspeed, longtime - pretime AS time_interval
  FROM lf WHERE pretime IS NOT NULL), {published('lp', 'lq')},
lw AS (SELECT *, unnest(range(longtime // 300 + 1, pretime // 300 + 5)) AS e FROM lq),
lt AS (SELECT e, avg(turn) FILTER (WHERE turn > 45) AS avg_turn FROM lw GROUP BY e),
{_fences('up', 'aspeed > 0')}, {_fences('dn', 'aspeed < 0')},
ls AS (SELECT e, avg(aspeed) FILTER (WHERE aspeed > 0) AS avg_upaspeed, stddev_samp(aspeed) FILTER (WHERE aspeed > 0) AS std_upaspeed,
  avg(aspeed) FILTER (WHERE aspeed < 0) AS avg_dnaspeed, stddev_samp(aspeed) FILTER (WHERE aspeed < 0) AS std_dnaspeed,
  any_value(avg_turn) AS avg_turn, avg(aturn) FILTER (WHERE turn > avg_turn) AS avg_aturn,
  stddev_samp(aturn) FILTER (WHERE turn > avg_turn) AS std_aturn, avg(tnspeed) FILTER (WHERE turn > avg_turn) AS avg_tnspeed,
  stddev_samp(tnspeed) FILTER (WHERE turn > avg_turn) AS std_tnspeed FROM lw JOIN lt USING (e) GROUP BY e),
published AS (SELECT ls.*, u.q3 + 1.5 * (u.q3 - u.q1) AS iqr_updist, u.q3 + 3 * (u.q3 - u.q1) AS iqr_updist_max,
  d.q3 + 1.5 * (d.q3 - d.q1) AS iqr_dndist, d.q3 + 3 * (d.q3 - d.q1) AS iqr_dndist_max
  FROM ls JOIN up_q u USING (e) JOIN dn_q d USING (e)
  WHERE e <= (SELECT max(longtime // 300) FROM lq) AND std_upaspeed IS NOT NULL AND std_dnaspeed IS NOT NULL AND std_aturn IS NOT NULL),
{pairs(after=120, strict=True, third=True)}, {motion(variant='ramp')},
near AS (SELECT unnest(range(e, e + 4)) AS slide, e FROM published),
ms AS (SELECT mo.*, published.* EXCLUDE (e) FROM mo JOIN (SELECT slide, max(e) AS e FROM near GROUP BY slide) n ON mo.longtime // 300 = n.slide
  JOIN published USING (e)),
mk AS (SELECT *, {_LEARNED} AS rapid_mark FROM ms)
SELECT {MARKED}, {rr("avg_upaspeed std_upaspeed iqr_updist iqr_updist_max avg_dnaspeed std_dnaspeed iqr_dndist iqr_dndist_max "
                     "avg_turn avg_aturn std_aturn avg_tnspeed std_tnspeed")} FROM mk"""

ORACLES["stream_rendezvous_scores"] = f"""WITH RECURSIVE {TEL}, {TAXI_TRIPS},
zb AS (SELECT min(end_time) AS t0, max(end_time) AS t1 FROM tt),
zt AS (SELECT tt.*, (end_time - t0) * 3 // (t1 - t0 + 1) AS part,
  CASE WHEN begin_time % 11 = 0 THEN 2 WHEN begin_time % 5 = 0 THEN 1 ELSE 0 END AS late FROM tt, zb),
zo AS (SELECT jsy, begin_time, end_time, part AS sent FROM zt
  UNION ALL SELECT jsy, begin_time, end_time, part + 1 FROM zt WHERE begin_time % 7 = 0),
zm AS (SELECT jsy, begin_time, end_time, part + late AS sent FROM zt),
low AS (SELECT sent, least((SELECT max(end_time) FROM zo WHERE zo.sent < s.sent), (SELECT max(end_time) FROM zm WHERE zm.sent < s.sent))
  - 899.5 AS low FROM (SELECT unnest(range(5)) AS sent) s),
met AS (SELECT DISTINCT jsy, begin_time, end_time FROM zo JOIN low USING (sent) WHERE low IS NULL OR end_time > low
  INTERSECT SELECT jsy, begin_time, end_time FROM zm JOIN low USING (sent) WHERE low IS NULL OR end_time > low),
rq AS (SELECT tt.*, {TAXI_SCORE} AS score, row_number() OVER (PARTITION BY jsy ORDER BY end_time) AS n
  FROM tt JOIN met USING (jsy, begin_time, end_time)),
rf AS (SELECT jsy, n, round(score + 1e-9, 2) AS running FROM rq WHERE n = 1
  UNION ALL SELECT q.jsy, q.n, round((f.running + q.score) / 2 + 1e-9, 2)
  FROM rf f JOIN rq q ON q.jsy = f.jsy AND q.n = f.n + 1)
SELECT jsy, begin_time, end_time, over0, over1, over2, over3, accelerations, brakings, turns, round(score, 2) AS score,
  round(seconds / 60 + 1e-9, 1) AS minutes, running FROM rq JOIN rf USING (jsy, n)"""
