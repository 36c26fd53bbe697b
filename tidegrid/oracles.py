"""DuckDB SQL equivalent to the registered queries, over the same tables."""

from __future__ import annotations

from tidegrid import engine_oracles, replay_oracles
from tidegrid.queries import FAST, SLOW

# The hourly grid of event types.
GRID = """
ev AS (SELECT event_type, event_id, user_id, value, epoch_us(ts) AS us FROM events),
mes AS (SELECT event_type, (us // 3600000000 + 1) * 3600 AS end_s, count(*) AS n, sum(value) AS dollars, list(value ORDER BY us DESC, event_id DESC)[1] AS price FROM ev GROUP BY 1, 2),
hrs AS (SELECT unnest(generate_series((SELECT min(end_s) FROM mes), (SELECT max(end_s) FROM mes), 3600)) AS end_s),
g AS (
  SELECT t.event_type, h.end_s, CAST(coalesce(n, 0) AS BIGINT) AS n, coalesce(dollars, 0.0) AS dollars, price,
         CASE WHEN (h.end_s - 3600) % 86400 < 43200 THEN 'am' ELSE 'pm' END AS session, (h.end_s - 3600) // 86400 AS day,
         coalesce(n, 0) > 0 AS eligible, coalesce(n, 0) > 0 AND coalesce(dollars, 0) > 30.005 AS matching
  FROM (SELECT DISTINCT event_type FROM mes) t CROSS JOIN hrs h LEFT JOIN mes m ON m.event_type = t.event_type AND m.end_s = h.end_s
)
"""
W = "OVER (PARTITION BY event_type ORDER BY end_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
O = "OVER (PARTITION BY event_type ORDER BY end_s)"  # noqa: E741


def _trail(h: int) -> str:
    w = f"OVER (PARTITION BY event_type ORDER BY end_s ROWS BETWEEN {h - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(*) {w} = {h} THEN sum(n) {w} / {h}.0 END AS rate_{h}, CASE WHEN count(*) {w} = {h} THEN sum(dollars) {w} / {h} * 4 END AS dollars_{h}"


STUDY = GRID + f""",
tr AS (SELECT *, (end_s - max(CASE WHEN n > 0 THEN end_s END) {W}) // 3600 AS age_hours, {_trail(FAST)}, {_trail(SLOW)} FROM g),
ps AS (
  SELECT *, {', '.join(f"rate_{h} IS NOT NULL AND dollars_{h} IS NOT NULL AND age_hours IS NOT NULL AS {v}_available, coalesce(rate_{h} >= 2.5, false) AS {v}_pass_rate, coalesce(dollars_{h} > 60.005, false) AS {v}_pass_dollars, coalesce(age_hours <= 1, false) AS {v}_pass_freshness" for v, h in (("fast", FAST), ("slow", SLOW)))}
  FROM tr
),
st AS (
  SELECT *, fast_available AND slow_available AS common_eligible,
    {', '.join(f"fast_available AND slow_available AND {v}_pass_rate AND {v}_pass_dollars AND {v}_pass_freshness AS {v}_match" for v in ("fast", "slow"))},
    fast_available AND fast_pass_rate AND fast_pass_dollars AND fast_pass_freshness AS fast_own_match
  FROM ps
)
"""
STATUS = GRID + """,
s AS (
  SELECT *, CASE WHEN n = 0 THEN CASE WHEN price IS NULL THEN 'unavailable' ELSE 'nonmatching' END WHEN price IS NULL THEN 'unavailable' WHEN n >= 2 AND price > 5 AND price < 40 THEN 'matching' ELSE 'nonmatching' END AS status
  FROM g
)
"""
ACCOUNT = STATUS + """,
acc AS (
  SELECT event_type, count(*) AS selected, count(*) FILTER (WHERE status <> 'unavailable') AS eligible, count(*) FILTER (WHERE status = 'matching') AS matching,
         count(*) FILTER (WHERE status = 'nonmatching') AS nonmatching, count(*) FILTER (WHERE status = 'unavailable') AS unavailable
  FROM s GROUP BY 1
)
"""


def periods(source: str, part: str, name: str = "per", eligible: str = "eligible", matching: str = "matching") -> str:
    """Gap-tolerant periods (3 steps off, 5 long, occupancy 0.6) as CTEs ending in ``name``."""
    return f""",
{name}_a AS (SELECT {part}, end_s, coalesce({eligible}, false) AS e, coalesce({matching}, false) AS m, lag(end_s) OVER (PARTITION BY {part} ORDER BY end_s) AS pe FROM {source}),
{name}_b AS (SELECT *, sum(CASE WHEN NOT e OR (pe IS NOT NULL AND end_s - pe <> 3600) THEN 1 ELSE 0 END) OVER (PARTITION BY {part} ORDER BY end_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM {name}_a),
{name}_c AS (SELECT *, end_s - lag(end_s) OVER (PARTITION BY {part}, seg ORDER BY end_s) AS gap FROM {name}_b WHERE m),
{name}_d AS (SELECT *, CASE WHEN gap IS NULL OR gap > 10800 THEN 1 ELSE 0 END AS nw FROM {name}_c),
{name}_e AS (SELECT *, sum(nw) OVER (PARTITION BY {part}, seg ORDER BY end_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep FROM {name}_d),
{name}_f AS (
  SELECT {part}, seg, ep, min(end_s) AS first_s, max(end_s) AS episode_end, count(*) AS matching_steps, CAST(max(CASE WHEN nw = 1 THEN 0 ELSE gap // 3600 - 1 END) AS BIGINT) AS longest_gap_steps FROM {name}_e GROUP BY {part}, seg, ep
),
{name}_g AS (SELECT *, (episode_end - first_s) // 3600 + 1 AS elapsed_steps, first_s - 3600 AS episode_start FROM {name}_f),
{name} AS (
  SELECT {part}, row_number() OVER (PARTITION BY {part} ORDER BY episode_start) AS episode_id, episode_start, episode_end, elapsed_steps, matching_steps, elapsed_steps - matching_steps AS nonmatching_steps,
         matching_steps / elapsed_steps AS occupancy, longest_gap_steps
  FROM {name}_g WHERE elapsed_steps >= 5 AND matching_steps * 5 >= elapsed_steps * 3
)
"""


CONDITIONS = ("rate", "dollars", "freshness")


def _omit(view: str, key: str) -> str:
    return "common_eligible AND " + " AND ".join(f"{view}_pass_{c}" for c in CONDITIONS if c != key)


_VARIANTS = [("fast_own_baseline", "fast_available", "fast_own_match")] + [
    x for v in ("fast", "slow") for x in [(v, "common_eligible", f"{v}_match"), *[(f"{v}_without_{c}", "common_eligible", _omit(v, c)) for c in CONDITIONS]]
]
VARIANT_ROWS = " UNION ALL ".join(f"SELECT event_type, session, end_s, '{n}' AS variant, {e} AS eligible, {m} AS matching FROM st" for n, e, m in _VARIANTS)
VARIANTS = STUDY + f", vr AS ({VARIANT_ROWS})" + periods("vr", "event_type, session, variant")
SCOPE = "CASE WHEN grouping(event_type) = 1 THEN 'overall' WHEN grouping(session) = 1 THEN 'type' ELSE 'member' END AS scope"
SETS = "GROUP BY GROUPING SETS ((event_type, session), (event_type), ())"


def _count(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


OVERLAP = ", ".join([
    _count("fast_match", "fast_rows"), _count("slow_match", "slow_rows"), _count("fast_match AND slow_match", "shared_rows"), _count("fast_match AND NOT slow_match", "fast_only_rows"),
    _count("slow_match AND NOT fast_match", "slow_only_rows"), _count("fast_match OR slow_match", "union_rows"),
])


def _ratios(unit: str) -> str:
    return ", ".join(f"round(shared_{unit}::DOUBLE / nullif({d}_{unit}, 0), 6) AS shared_over_{d}" for d in ("union", "fast", "slow"))


def _disagreement(x: str, y: str) -> str:
    w = f"{x}_match AND NOT {y}_match"
    total = " + ".join(f"(NOT {y}_pass_{c})::INT" for c in CONDITIONS)
    name = f"{x}_pass_{y}_fail"
    single = " UNION ALL ".join(
        f"SELECT 'condition' AS record_type, '{c}' AS failure, count(*) FILTER (WHERE NOT {y}_pass_{c}) AS rows, count(*) FILTER (WHERE NOT {y}_pass_{c} AND ({total}) = 1) AS sole_rows, count(*) AS direction_rows, '{name}' AS direction FROM st WHERE {w}"
        for c in CONDITIONS
    )
    label = f"concat_ws(',', {', '.join(f'CASE WHEN NOT {y}_pass_{c} THEN {chr(39)}{c}{chr(39)} END' for c in CONDITIONS)})"
    combo = f"SELECT * FROM (SELECT 'combination', {label} AS f, count(*) AS k, NULL::BIGINT, (SELECT count(*) FROM st WHERE {w}), '{name}' FROM st WHERE {w} GROUP BY f ORDER BY k DESC, f LIMIT 20)"
    return f"{single} UNION ALL {combo}"


def _contribution(v: str) -> str:
    def row(c: str) -> str:
        gone = f"(SELECT DISTINCT event_type FROM per WHERE variant = '{v}_without_{c}')"
        base = f"(SELECT DISTINCT event_type FROM per WHERE variant = '{v}')"
        return f"""SELECT '{v}' AS view, '{c}' AS condition, {_count('common_eligible', 'common_eligible')}, {_count(f'common_eligible AND {v}_pass_{c}', 'standalone_pass')},
          round(count(*) FILTER (WHERE common_eligible AND {v}_pass_{c})::DOUBLE / nullif(count(*) FILTER (WHERE common_eligible), 0), 6) AS standalone_rate, {_count(f'{v}_match', 'baseline_matching')},
          {_count(_omit(v, c), 'removed_matching')}, count(*) FILTER (WHERE {_omit(v, c)}) - count(*) FILTER (WHERE {v}_match) AS added_matching,
          (SELECT count(*) FROM {gone}) AS retained_symbol_days, (SELECT count(*) FROM (SELECT * FROM {gone} EXCEPT SELECT * FROM {base})) AS gained_symbol_days,
          (SELECT count(*) FROM (SELECT * FROM {base} EXCEPT SELECT * FROM {gone})) AS lost_symbol_days FROM st"""

    return " UNION ALL ".join(row(c) for c in CONDITIONS)


def _stretch(flag: str, failed: str, name: str) -> str:
    p = "PARTITION BY event_type, session ORDER BY end_s"
    return f""",
{name}_a AS (SELECT *, coalesce({flag}, false) AS f, end_s - lag(end_s) OVER ({p}) AS d FROM st),
{name}_b AS (SELECT *, CASE WHEN f AND (d IS NULL OR d <> 3600 OR NOT lag(f) OVER ({p})) THEN 1 ELSE 0 END AS nw FROM {name}_a),
{name}_c AS (SELECT *, sum(nw) OVER ({p} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS id FROM {name}_b),
{name} AS (SELECT event_type, session, min(end_s) - 3600 AS stretch_start, max(end_s) AS stretch_end, count(*) AS steps, CAST(sum((NOT {failed})::INT) AS BIGINT) AS failed_rate_steps FROM {name}_c WHERE f GROUP BY event_type, session, id)
"""


BARS = """
ev AS (SELECT event_type, event_id, user_id, value, epoch_us(ts) AS us FROM events),
bars AS (
  SELECT event_type AS symbol, us // 21600000000 * 21600 AS window_start, count(*)::DOUBLE AS transactions, sum(value) AS volume, list(value ORDER BY us, event_id)[1] AS open,
         list(value ORDER BY us DESC, event_id DESC)[1] AS close, max(value) AS high, min(value) AS low FROM ev GROUP BY 1, 2
),
ref AS (SELECT DISTINCT event_type AS symbol, CASE WHEN event_type IN ('click', 'purchase', 'error') THEN 'CS' WHEN event_type = 'view' THEN 'ADRC' ELSE 'ETF' END AS kind FROM ev),
seen AS (SELECT b.*, r.kind, open > 0 AND close > 0 AND low > 0 AND high >= greatest(open, close, low) AND low <= least(open, close, high) AS quality FROM bars b JOIN ref r USING (symbol) WHERE kind IN ('CS', 'ADRC') AND close > 0),
pr AS (SELECT *, lag(window_start) OVER w AS ps, lag(transactions) OVER w AS pt, lag(high) OVER w AS ph, lag(low) OVER w AS pl, lag(quality) OVER w AS pq FROM seen WINDOW w AS (PARTITION BY symbol ORDER BY window_start)),
hit AS (
  SELECT *, 10000 * ln(greatest(high, ph) / least(low, pl)) AS range_bps, transactions + pt AS pair_transactions, least(transactions, pt) AS least_transactions FROM pr
  WHERE quality AND pq AND window_start - ps = 21600 AND 10000 * ln(greatest(high, ph) / least(low, pl)) >= 30000 AND transactions + pt >= 24 AND least(transactions, pt) >= 8
)
"""


def _ew(half_life: int, x: str, name: str) -> str:
    return f"sum({x} * pow(2.0, -(a.o - b.o) / {half_life}.0)) AS {name}"


def _bin(axis: tuple[float, ...], x: str) -> str:
    below = " + ".join(f"({e} <= {x})::INT" for e in axis)
    return f"CASE WHEN {x} = 0 THEN 0 WHEN {x} = {axis[-1]} THEN {len(axis)} ELSE ({below}) + 1 END"


_EDGES = [i * 10.0 for i in range(21)]
MARGINAL = """
v AS (SELECT l_quantity AS value, l_returnflag AS m, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT m, sum(n) AS mn FROM v GROUP BY 1),
q AS (SELECT value, CAST(sum(n) AS BIGINT) AS n, sum(n / mn) AS mass FROM v JOIN t USING (m) GROUP BY 1),
c AS (SELECT *, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS cum, sum(mass) OVER (ORDER BY value) AS cm FROM q)
"""


def oracle_sql() -> dict[str, str]:
    g, st, acc, status = f"WITH {GRID}", f"WITH {STUDY}", f"WITH {ACCOUNT}", f"WITH {STATUS}"
    one = g + periods("g", "event_type")
    sql = {
        "endpoint_screen": g + "SELECT event_type, end_s, session, n, round(dollars, 6) AS dollars, (end_s - (SELECT min(end_s) FROM g)) // 3600 AS hours_open FROM g WHERE n >= 3 AND dollars > 100.005 AND price <= 90",
        "prepared_sql": g + "SELECT event_type, count(*) AS hours, CAST(sum(n) AS BIGINT) AS events FROM g WHERE n >= 2 AND session = 'am' GROUP BY 1",
        "three_state_predicates": status + "SELECT event_type, end_s, status, concat_ws(',', CASE WHEN n < 2 THEN 'n' END, CASE WHEN price <= 5 OR price >= 40 THEN 'price' END) AS failing, concat_ws(',', CASE WHEN price IS NULL THEN 'price' END) AS missing FROM s",
        "activity_bands": g + "SELECT event_type, CASE WHEN n = 0 THEN -1 WHEN dollars = 0 THEN 0 WHEN dollars < 1 THEN 1 WHEN dollars < 10 THEN 2 WHEN dollars < 30 THEN 3 WHEN dollars < 100 THEN 4 ELSE 5 END AS band, count(*) AS hours FROM g GROUP BY 1, 2",
        "gate_accounting": g + "SELECT CASE WHEN grouping(session) = 1 THEN 'pooled' WHEN grouping(event_type) = 1 THEN 'session' ELSE 'member' END AS scope, event_type, session, count(*) AS represented, count(*) FILTER (WHERE n > 0) AS valid, count(*) FILTER (WHERE n >= 2 AND dollars >= 30.005) AS pass, count(*) FILTER (WHERE n > 0 AND NOT (n >= 2 AND dollars >= 30.005)) AS fail, count(*) FILTER (WHERE n = 0) AS unavailable FROM g GROUP BY GROUPING SETS ((event_type, session), (session), ())",
        "member_accounting": acc + "SELECT *, round(matching / nullif(eligible, 0), 6) AS match_fraction, CASE WHEN eligible = 0 THEN 'no_eligible_rows' WHEN matching = 0 THEN 'valid_zero_match' ELSE 'positive_match' END AS eligibility_class FROM acc",
        "contributions": acc + "SELECT event_type, matching, round(matching / nullif((SELECT sum(matching) FROM acc), 0), 6) AS share FROM acc",
        "reason_tallies": g + "SELECT 'none' AS reason, count(*) FILTER (WHERE n = 0) AS rows FROM g UNION ALL SELECT 'closed', count(*) FILTER (WHERE session = 'pm') FROM g UNION ALL SELECT 'low', count(*) FILTER (WHERE dollars < 10.005) FROM g",
        "concentration": "WITH p AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1) SELECT count(*) AS members, CAST(sum(n) AS BIGINT) AS rows, round(max(n) / sum(n), 6) AS largest_share, round(sum(n * n) / (sum(n) * sum(n)), 6) AS herfindahl FROM p",
        "daily_population": g + "SELECT day, count(*) FILTER (WHERE n > 0) AS active_hours, CAST(sum(n) AS BIGINT) AS events, count(DISTINCT CASE WHEN matching THEN event_type END) AS matching_types FROM g GROUP BY 1",
        "selection_segments": g + """, sp AS (SELECT event_type, min(end_s) AS a, max(end_s) AS b, (max(end_s) - min(end_s)) // 14400 * 3600 AS h FROM g GROUP BY 1), sg AS (SELECT event_type, 0 AS seg, a AS f, a + h AS l FROM sp UNION ALL SELECT event_type, 1, b - h, b FROM sp)
            SELECT g.event_type, seg, count(*) AS hours, CAST(sum(n) AS BIGINT) AS events, count(*) FILTER (WHERE end_s = f) AS starts, count(*) FILTER (WHERE end_s = l) AS ends FROM g JOIN sg ON g.event_type = sg.event_type AND end_s BETWEEN f AND l GROUP BY 1, 2""",
        "window_slice": g + ", c AS (SELECT * FROM g WHERE end_s > (SELECT max(end_s) FROM g) - 172800), f AS (SELECT event_type, arg_min(price, end_s) FILTER (WHERE price IS NOT NULL) AS p0 FROM c GROUP BY 1) SELECT event_type, end_s, round(10000 * (price / p0 - 1), 6) AS rebased_bps FROM c JOIN f USING (event_type)",
        "gap_periods": one + "SELECT * REPLACE (round(occupancy, 6) AS occupancy) FROM per",
        "period_summary": one + "SELECT event_type, count(*) AS periods, CAST(sum(elapsed_steps) AS BIGINT) AS covered_steps, CAST(sum(matching_steps) AS BIGINT) AS matching_steps, round(avg(elapsed_steps), 6) AS mean_steps, round(median(elapsed_steps), 6) AS median_steps, round(sum(matching_steps) / sum(elapsed_steps), 6) AS weighted_occupancy FROM per GROUP BY 1",
        "period_variants": f"WITH {VARIANTS} SELECT event_type, session, variant, episode_id, episode_start, episode_end, elapsed_steps, matching_steps, longest_gap_steps FROM per",
        "best_window": g + """, r AS (SELECT event_type, session, end_s AS window_end, min(end_s) OVER w AS f, count(*) OVER w AS represented_steps, CAST(sum(eligible::INT) OVER w AS BIGINT) AS eligible_steps, CAST(sum(matching::INT) OVER w AS BIGINT) AS matching_steps FROM g WINDOW w AS (PARTITION BY event_type, session ORDER BY end_s ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
            k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY matching_steps DESC, window_end, session) AS rn FROM r WHERE represented_steps = 6 AND eligible_steps = 6 AND window_end - f = 18000 AND matching_steps * 2 >= 6)
            SELECT event_type, session, window_end - 21600 AS window_start, window_end, represented_steps, eligible_steps, matching_steps, round(matching_steps / represented_steps, 6) AS occupancy FROM k WHERE rn = 1""",
        "directional_stretches": st + _stretch("fast_match AND NOT slow_match", "slow_pass_rate", "sx") + "SELECT event_type, session, stretch_start, stretch_end, steps, failed_rate_steps AS failed_rate FROM sx",
        "top_stretches": st + _stretch("fast_match AND NOT slow_match", "slow_pass_rate", "sx") + _stretch("slow_match AND NOT fast_match", "fast_pass_rate", "sy")
        + "SELECT * FROM (SELECT 'fast_only' AS direction, * FROM sx ORDER BY steps DESC, event_type, stretch_start LIMIT 3) UNION ALL SELECT * FROM (SELECT 'slow_only', * FROM sy ORDER BY steps DESC, event_type, stretch_start LIMIT 3)",
        "inside_period_semi": one + "SELECT event_type, session, count(*) AS hours, CAST(sum(n) AS BIGINT) AS events FROM g WHERE EXISTS (SELECT 1 FROM per WHERE per.event_type = g.event_type AND g.end_s > episode_start AND g.end_s <= episode_end) GROUP BY 1, 2",
        "period_overlap": f"""WITH {VARIANTS}, hs AS (SELECT DISTINCT p.event_type, variant, g.end_s FROM per p JOIN g ON g.event_type = p.event_type AND g.end_s > episode_start AND g.end_s <= episode_end WHERE variant IN ('fast', 'slow')),
            mm AS (SELECT t.event_type, count(*) FILTER (WHERE f AND NOT coalesce(s, false)) AS fo, count(*) FILTER (WHERE s AND NOT coalesce(f, false)) AS so, count(*) FILTER (WHERE f AND s) AS sh FROM (SELECT DISTINCT event_type FROM g) t
              LEFT JOIN (SELECT event_type, end_s, bool_or(variant = 'fast') AS f, bool_or(variant = 'slow') AS s FROM hs GROUP BY 1, 2) USING (event_type) GROUP BY 1),
            al AS (SELECT 'member' AS scope, event_type, fo + sh AS fast_steps, so + sh AS slow_steps, sh AS shared_steps, fo AS fast_only_steps, so AS slow_only_steps, fo + so + sh AS union_steps FROM mm
              UNION ALL SELECT 'overall', NULL, sum(fo + sh)::BIGINT, sum(so + sh)::BIGINT, sum(sh)::BIGINT, sum(fo)::BIGINT, sum(so)::BIGINT, sum(fo + so + sh)::BIGINT FROM mm)
            SELECT *, {_ratios('steps')} FROM al""",
        "interval_union": """WITH i AS (SELECT event_type, epoch_us(ts) AS start, epoch_us(ts) + CAST(trunc(value * 60000000) AS BIGINT) AS stop FROM events),
            a AS (SELECT *, max(stop) OVER (PARTITION BY event_type ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
            b AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM a)
            SELECT event_type, min(start) AS start, max(stop) AS stop FROM b GROUP BY event_type, k""",
        "dollar_periods": st + f", fl AS (SELECT *, common_eligible AND dollars_{FAST} IS NOT NULL AND dollars_{SLOW} IS NOT NULL AS valid FROM st)"
        + periods("fl", "event_type, session", "pf", "valid", f"fast_match AND dollars_{FAST} >= 80.005") + periods("fl", "event_type, session", "pz", "valid", f"slow_match AND dollars_{SLOW} >= 80.005")
        + "SELECT 'fast' AS view, event_type, session, episode_start, episode_end, elapsed_steps, matching_steps FROM pf UNION ALL SELECT 'slow', event_type, session, episode_start, episode_end, elapsed_steps, matching_steps FROM pz",
        "period_reproduction": "SELECT CAST(0 AS BIGINT) AS differing_rows",
        "availability_scopes": st + f"SELECT {SCOPE}, event_type, session, count(*) AS represented, {_count('fast_available AND slow_available', 'both_available')}, {_count('fast_available AND NOT slow_available', 'fast_only_available')}, {_count('slow_available AND NOT fast_available', 'slow_only_available')}, {_count('NOT fast_available AND NOT slow_available', 'neither_available')} FROM st {SETS}",
        "overlap_by_scope": st + f", o AS (SELECT {SCOPE}, event_type, session, {OVERLAP} FROM st {SETS}) SELECT *, {_ratios('rows')} FROM o",
        "disagreements": st + f", d AS ({_disagreement('fast', 'slow')} UNION ALL {_disagreement('slow', 'fast')}) SELECT *, round(rows / nullif(direction_rows, 0), 6) AS share_of_direction FROM d",
        "filter_contribution": f"WITH {VARIANTS} {_contribution('fast')} UNION ALL {_contribution('slow')}",
        "membership": f"""WITH {VARIANTS}, e AS (SELECT event_type, count(*) FILTER (WHERE common_eligible) AS ce, bool_or(fast_match) AS f, bool_or(slow_match) AS s FROM st GROUP BY 1),
            d AS (SELECT event_type, ce, f, s, 'matching_second' AS definition FROM e UNION ALL SELECT event_type, ce, EXISTS (SELECT 1 FROM per WHERE per.event_type = e.event_type AND variant = 'fast'), EXISTS (SELECT 1 FROM per WHERE per.event_type = e.event_type AND variant = 'slow'), 'retained_period' FROM e)
            SELECT event_type, ce AS common_eligible, ce = 0 AS no_common_eligible, CASE WHEN f AND s THEN 'both' WHEN f THEN 'fast_only' WHEN s THEN 'slow_only' ELSE 'neither' END AS classification, definition FROM d""",
        "membership_change": f"""WITH {VARIANTS}, a AS (SELECT DISTINCT event_type, session FROM per WHERE variant = 'fast'), b AS (SELECT DISTINCT event_type, session FROM per WHERE variant = 'fast_without_rate')
            SELECT (SELECT count(*) FROM b) AS retained, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS gained, (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS lost""",
        "threshold_crossings": g + f", p AS (SELECT event_type, matching, lag(matching) {O} AS b FROM g) SELECT event_type, count(*) FILTER (WHERE matching AND NOT b) AS turned_on, count(*) FILTER (WHERE NOT matching AND b) AS turned_off FROM p GROUP BY 1",
        "set_algebra": g + ", a AS (SELECT DISTINCT event_type, day FROM g WHERE matching), b AS (SELECT DISTINCT event_type, day FROM g WHERE n >= 4) SELECT *, 'gained' AS part FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'lost' FROM (FROM b EXCEPT FROM a) UNION ALL SELECT *, 'kept' FROM (FROM a INTERSECT FROM b)",
        "ew_rates": g + f""", p AS (SELECT *, row_number() {O} - 1 AS o FROM g), w AS (SELECT a.event_type, a.end_s, {_ew(6, 'b.n', 'sn')}, {_ew(6, 'b.dollars', 'sd')}, {_ew(6, '(b.n > 0)::INT', 'sw')}, {_ew(6, '1', 's1')} FROM p a JOIN p b ON a.event_type = b.event_type AND b.o <= a.o GROUP BY 1, 2)
            SELECT event_type, end_s, round(sn / s1, 6) AS rate, round(sd / nullif(sw, 0), 6) AS mean_dollars, round(sw / s1, 6) AS coverage FROM w""",
        "ew_rms_participation": g + f""", p AS (SELECT *, row_number() {O} - 1 AS o, 10000 * ln(price / lag(price, 5) {O}) AS r FROM g),
            w AS (SELECT a.event_type, a.end_s, {_ew(24, 'abs(b.r)', 'u1')}, {_ew(24, 'b.r * b.r', 'u2')}, {_ew(24, '(b.r IS NOT NULL)::INT', 'w')}, count(b.r) AS k FROM p a JOIN p b ON a.event_type = b.event_type AND b.o <= a.o GROUP BY 1, 2)
            SELECT event_type, end_s, CASE WHEN k > 0 THEN round(sqrt(u2 / w), 4) END AS rms_bps, CASE WHEN k > 0 AND u2 > 0 THEN round(least(1.0, u1 * u1 / w / u2), 6) END AS participation FROM w""",
        "age_p90": st + ", p AS (SELECT *, CASE WHEN age_hours > 0 THEN age_hours::DOUBLE END AS v FROM st) SELECT event_type, end_s, round(quantile_cont(v, 0.9) OVER w, 6) AS p90, CAST(count(v) OVER w AS INT) AS samples, CAST(count(*) OVER w AS INT) AS slots FROM p WINDOW w AS (PARTITION BY event_type ORDER BY end_s ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)",
        "current_ages": g + ", x AS (SELECT g.event_type, g.end_s, (SELECT max(us) FROM ev WHERE ev.event_type = g.event_type AND ev.us < g.end_s * 1000000) AS s FROM g) SELECT event_type, end_s, (SELECT max(event_id) FROM ev WHERE ev.event_type = x.event_type AND ev.us = x.s) AS event_id, round((end_s * 1000000 - s) / 1000000, 6) AS age_s FROM x",
        "asof_prevailing": "WITH ev AS (SELECT event_type, event_id, user_id, value, epoch_us(ts) AS us FROM events), p AS (SELECT user_id, us FROM ev WHERE event_type = 'purchase'), v AS (SELECT user_id, us, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM ev WHERE event_type = 'view' GROUP BY 1, 2) SELECT p.user_id, p.us, v.event_id AS view_id, v.value AS view_value FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.us > v.us",
        "interval_integral": """WITH ev AS (SELECT event_type, event_id, value, epoch_us(ts) AS us FROM events), s AS (SELECT event_type, value, us AS a, lead(us) OVER (PARTITION BY event_type ORDER BY us, event_id) AS b FROM ev),
            x AS (SELECT event_type, value, a, b, unnest(generate_series(a // 3600000000, (b - 1) // 3600000000)) AS h FROM s WHERE b > a), y AS (SELECT *, least(b, (h + 1) * 3600000000) - greatest(a, h * 3600000000) AS us FROM x)
            SELECT event_type, (h + 1) * 3600 AS end_s, CAST(sum(us) AS BIGINT) AS valid_us, round(sum(value * us / 1000000), 4) AS integral, round(sum(value * us / 1000000) / (sum(us) / 1000000), 6) AS average FROM y GROUP BY 1, 2""",
        "screen_two_bars": f"WITH {BARS} SELECT symbol, arg_min(kind, window_start) AS kind, min(window_start) + 21600 AS discovery_endpoint, arg_min(ps, window_start) AS window_start, round(arg_min(range_bps, window_start), 6) AS range_bps, arg_min(pair_transactions, window_start) AS pair_transactions, arg_min(least_transactions, window_start) AS least_transactions FROM hit GROUP BY 1",
        "screen_denominators": f"WITH {BARS} SELECT (SELECT count(*) FROM ref WHERE kind IN ('CS', 'ADRC')) AS reference_symbols, (SELECT count(*) FROM bars) AS input_rows, (SELECT count(*) FROM bars JOIN ref USING (symbol) WHERE kind IN ('CS', 'ADRC')) AS eligible_rows, (SELECT count(*) FROM seen) AS valid_session_rows, (SELECT count(*) FROM seen WHERE NOT quality) AS invalid_ohlc_rows, (SELECT count(DISTINCT symbol) FROM seen) AS eligible_source_symbols, (SELECT count(*) FROM hit) AS qualifying_windows, (SELECT count(DISTINCT symbol) FROM hit) AS candidates",
        "exact_ecdf": f"WITH {MARGINAL} SELECT value, n, cum AS cumulative_n, round(cum / (SELECT sum(n) FROM q), 6) AS pooled_share, round(mass / (SELECT count(*) FROM t), 6) AS equal_mass, round(cm / (SELECT count(*) FROM t), 6) AS equal_share FROM c",
        "ecdf_quantiles": f"WITH {MARGINAL} SELECT p.q::DOUBLE AS q, (SELECT min(value) FROM c WHERE cum >= greatest(ceil(p.q * (SELECT sum(n) FROM c)), 1)) AS pooled FROM (SELECT unnest([0.0::DOUBLE, 0.01::DOUBLE, 0.05::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE, 1.0::DOUBLE]) AS q) p",
        "joint_histogram": f"WITH v AS (SELECT l_linestatus, l_returnflag, {_bin((5.0, 10.0, 20.0, 40.0), 'l_quantity')} AS x_bin, {_bin((0.02, 0.04, 0.08), 'l_discount')} AS y_bin, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT l_linestatus, l_returnflag, sum(n) AS mn FROM v GROUP BY ALL), k AS (SELECT l_linestatus, count(*) AS c FROM t GROUP BY 1) SELECT l_linestatus, x_bin, y_bin, CAST(sum(n) AS BIGINT) AS n, round(sum(n / mn) / max(c), 6) AS equal_probability FROM v JOIN t USING (l_linestatus, l_returnflag) JOIN k USING (l_linestatus) GROUP BY 1, 2, 3",
        "joint_coverage": g + ", m AS (SELECT event_type, price AS x, CASE WHEN n > 2 THEN dollars / n END AS y FROM g) SELECT event_type, count(*) AS represented, count(*) FILTER (WHERE x IS NULL AND y IS NOT NULL) AS x_invalid, count(*) FILTER (WHERE y IS NULL AND x IS NOT NULL) AS y_invalid, count(*) FILTER (WHERE x IS NULL AND y IS NULL) AS both_invalid, count(*) FILTER (WHERE x < 50 AND y < 40) AS plotted, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL AND NOT (x < 50 AND y < 40)) AS off_axis FROM m GROUP BY 1",
        "expanded_joint": g + f""", d AS (SELECT event_type, session, n, CASE WHEN n > 0 THEN dollars END AS x FROM g), b AS (SELECT *, CASE WHEN x IS NULL THEN -1 WHEN x = 0 THEN 0 WHEN x < 1 THEN 1 WHEN x < 10 THEN 2 WHEN x < 30 THEN 3 WHEN x < 100 THEN 4 ELSE 5 END AS k FROM d),
            l AS (SELECT unnest(['pooled', session]) AS scope, x, k, n FROM b), l2 AS (SELECT scope, unnest(['all', 'band_' || k]) AS band, x, k, n FROM l), l3 AS (SELECT scope, band, unnest(CASE WHEN n >= 2 AND k >= 1 THEN ['unconditional', 'gated'] ELSE ['unconditional'] END) AS gate, x FROM l2)
            SELECT scope, band, gate, CASE WHEN x IS NULL THEN NULL WHEN x < 0 THEN 'underflow' WHEN x > 200 THEN 'overflow' ELSE 'finite' END AS status, CASE WHEN x BETWEEN 0 AND 200 THEN least({' + '.join(f'({e} <= x)::INT' for e in _EDGES)} - 1, 19) END AS bin, count(*) AS hours FROM l3 GROUP BY ALL""",
        "binned_ecdf": g + """, l AS (SELECT session, 'dollars' AS metric, CASE WHEN dollars + 0.00123 = 0 THEN 0 ELSE floor((dollars + 0.00123) / 5.0)::BIGINT + 1 END AS bin FROM g WHERE n > 0 UNION ALL SELECT session, 'mean', CASE WHEN dollars / n = 0 THEN 0 ELSE floor(ln(1 + dollars / n) / 0.25)::BIGINT + 1 END FROM g WHERE n > 0),
            c AS (SELECT metric, bin, session, grouping(session) = 1 AS pooled, count(*) AS n FROM l GROUP BY GROUPING SETS ((metric, bin, session), (metric, bin)))
            SELECT *, CAST(sum(n) OVER (PARTITION BY metric, pooled, session ORDER BY bin) AS BIGINT) AS cumulative_n, round(sum(n) OVER (PARTITION BY metric, pooled, session ORDER BY bin) / sum(n) OVER (PARTITION BY metric, pooled, session), 6) AS share FROM c""",
        "activity_ecdf": g + """, v AS (SELECT session, dollars AS x, CASE WHEN dollars = 0 THEN 0 ELSE floor(ln(1 + dollars) / 0.05)::BIGINT + 1 END AS bin FROM g WHERE n > 0),
            f AS (SELECT CASE WHEN grouping(session) = 1 THEN 'pooled' ELSE session END AS session, bin, count(*) AS n, count(*) FILTER (WHERE x >= 30.005) AS passes, round(min(x), 6) AS low, round(max(x), 6) AS high FROM v GROUP BY GROUPING SETS ((session, bin), (bin)))
            SELECT *, CAST(sum(n) OVER (PARTITION BY session ORDER BY bin) AS BIGINT) AS cumulative_n, round(sum(n) OVER (PARTITION BY session ORDER BY bin) / sum(n) OVER (PARTITION BY session), 6) AS share FROM f""",
        "panel_summary": g + """, m AS (SELECT event_type, price AS x, CASE WHEN n > 2 THEN dollars / n END AS y FROM g),
            p AS (SELECT event_type, count(*) AS s, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS v, count(*) FILTER (WHERE x IS NULL AND y IS NOT NULL) AS xi, count(*) FILTER (WHERE y IS NULL AND x IS NOT NULL) AS yi, count(*) FILTER (WHERE x IS NULL AND y IS NULL) AS b,
              count(*) FILTER (WHERE x BETWEEN 0.1 AND 200 AND y BETWEEN 0 AND 100) AS pl, count(*) FILTER (WHERE y IS NOT NULL AND x = 0) AS xz, count(*) FILTER (WHERE x IS NOT NULL AND y = 0) AS yz FROM m GROUP BY 1)
            SELECT CAST(sum(s) AS BIGINT) AS selected, CAST(sum(v) AS BIGINT) AS pair_valid, CAST(sum(xi) AS BIGINT) AS x_invalid_only, CAST(sum(yi) AS BIGINT) AS y_invalid_only, CAST(sum(b) AS BIGINT) AS both_invalid, CAST(sum(pl) AS BIGINT) AS plotted, CAST(sum(xz) AS BIGINT) AS x_zero,
              CAST(sum(yz) AS BIGINT) AS y_zero, count(*) AS selected_members, count(*) FILTER (WHERE v > 0) AS contributing_members, (SELECT event_type FROM p ORDER BY v DESC, event_type DESC LIMIT 1) AS largest_member, max(v) AS largest_pair_valid, CAST(sum(v) - sum(pl) AS BIGINT) AS off_axis, round(max(v) / sum(v), 6) AS largest_share FROM p""",
        "active_hours": g + "SELECT day, count(*) AS represented, count(*) FILTER (WHERE n > 0) AS valid, count(*) FILTER (WHERE n >= 3 AND dollars >= 60.005) AS pass, count(*) FILTER (WHERE n > 0 AND NOT (n >= 3 AND dollars >= 60.005)) AS fail, count(*) FILTER (WHERE n = 0) AS unavailable, count(*) FILTER (WHERE n >= 3 AND dollars >= 60.005) / 1.0 AS active_hours FROM g GROUP BY 1",
        "daily_members": g + "SELECT day, count(DISTINCT event_type) AS completed_members, count(DISTINCT event_type) * 24.0::DOUBLE AS represented_hours FROM g WHERE n > 0 GROUP BY 1",
        "view_crossings": st + f"SELECT {_count(f'common_eligible AND dollars_{FAST} >= 80.005 AND dollars_{SLOW} < 80.005', 'fast_above_slow_below')}, {_count(f'common_eligible AND dollars_{SLOW} >= 80.005 AND dollars_{FAST} < 80.005', 'slow_above_fast_below')}, {_count('fast_match AND NOT slow_match', 'fast_only')}, {_count('slow_match AND NOT fast_match', 'slow_only')}, {_count(f'fast_match AND NOT slow_match AND dollars_{FAST} < 80.005', 'fast_only_low')}, {_count(f'slow_match AND NOT fast_match AND dollars_{SLOW} < 80.005', 'slow_only_low')} FROM st",
        "dimension_totals": st + f"SELECT CASE WHEN grouping(event_type) = 0 AND grouping(day) = 0 THEN 'member' WHEN grouping(day) = 0 THEN 'day' WHEN grouping(event_type) = 0 THEN 'type' ELSE 'overall' END AS scope, event_type, day, count(*) AS represented, {_count('common_eligible', 'common_eligible')}, {_count('fast_match', 'matching')}, {_count(f'fast_match AND dollars_{FAST} < 80.005', 'below_floor')}, {_count('fast_own_match', 'own_matching')} FROM st GROUP BY GROUPING SETS ((event_type, day), (day), (event_type), ())",
        "feature_catalog": "SELECT \"table\", family, source, CAST(fields AS BIGINT) AS fields FROM (VALUES ('features', 'return', 'quote', 2), ('features', 'participation', 'quote', 2), ('features', 'spread', 'quote', 2), ('features', 'activity', 'trade', 6), ('features', 'bid_size', 'quote', 2), ('features', 'ask_size', 'quote', 2), ('features', 'ratio', 'quote', 2), ('features', 'trade_age', 'trade', 2), ('features', 'quote_age', 'quote', 2), ('features', 'midpoint_change_age', 'quote', 2), ('current_ages', 'trade_current_age', 'trade', 1), ('current_ages', 'quote_current_age', 'quote', 1), ('current_ages', 'midpoint_change_current_age', 'quote', 1)) t(\"table\", family, source, fields)",
        "quantile_grid": "WITH p AS (SELECT o_orderpriority, count(o_totalprice) AS n, quantile_disc(o_totalprice, [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS v FROM orders GROUP BY 1) SELECT o_orderpriority, n, unnest([0.0::DOUBLE, 0.05::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.95::DOUBLE, 1.0::DOUBLE]) AS q, unnest(v) AS value FROM p",
        "dollar_profile": st + ", l AS (" + " UNION ALL ".join(f"SELECT '{v}' AS view, '{p}' AS population, dollars_{h} AS x FROM st WHERE {c} AND dollars_{h} IS NOT NULL" for v, h in (("fast", FAST), ("slow", SLOW)) for p, c in (("common", "common_eligible"), ("matching", "fast_match")))
        + ") SELECT view, population, count(*) AS n, round(min(x), 6) AS minimum, " + ", ".join(f"round(quantile_disc(x, {q}), 6) AS p{p}" for q, p in ((0.01, 1), (0.05, 5), (0.1, 10), (0.25, 25), (0.5, 50))) + ", round(count(*) FILTER (WHERE x < 80.005) / count(*), 6) AS share_below FROM l GROUP BY 1, 2",
        "running_shares": "WITH p AS (SELECT p_size, count(*) AS n, sum(p_retailprice) AS price FROM part GROUP BY 1) SELECT p_size, n, round(price, 6) AS price, CAST(sum(n) OVER (ORDER BY p_size) AS BIGINT) AS cum_n, round(sum(price) OVER (ORDER BY p_size), 6) AS cum_price FROM p",
        "stratified_sample": """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS session_date, o_orderpriority AS symbol, count(*) AS event_count FROM orders GROUP BY 1, 2), r AS (SELECT *, substr(session_date, 1, 7) AS month, sha256('seed-1|' || session_date || '|' || symbol) AS selection_hash FROM m),
            k AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY event_count, session_date, symbol) - 1 AS monthly_rank, count(*) OVER (PARTITION BY month) AS monthly_members FROM r), s AS (SELECT *, CAST(least(3, 4 * monthly_rank // monthly_members) AS INT) AS stratum FROM k),
            c AS (SELECT *, row_number() OVER (PARTITION BY month, stratum ORDER BY selection_hash, session_date, symbol) AS cell_rank FROM s) SELECT month, stratum, cell_rank, session_date, symbol, event_count, monthly_rank, monthly_members, selection_hash FROM c WHERE cell_rank <= 2""",
        "validation_report": g + "SELECT 'counts' AS rule, count(*) FILTER (WHERE NOT n >= 0) AS rows FROM g UNION ALL SELECT 'some events', count(*) FILTER (WHERE n = 0) FROM g UNION ALL SELECT 'price where events', count(*) FILTER (WHERE (price IS NOT NULL) <> (n > 0)) FROM g UNION ALL SELECT 'cheap', count(*) FILTER (WHERE price IS NULL OR price >= 50) FROM g",
        "grid_check": g + f", x AS (SELECT event_type, end_s, end_s - lag(end_s) {O} AS d FROM g WHERE n > 0) SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE end_s % 3600 <> 0) AS misaligned, count(*) FILTER (WHERE d <> 3600) AS gaps_or_repeats, CAST(0 AS BIGINT) AS outside FROM x GROUP BY 1",
        "order_violations": "WITH e AS (SELECT event_type, epoch_us(ts) // 60000000 AS m, user_id, count(*) AS n FROM events GROUP BY 1, 2, 3) SELECT event_type, CAST(sum(n) AS BIGINT) AS events, CAST(0 AS BIGINT) AS null_keys, CAST(sum(n - 1) AS BIGINT) AS repeated_keys FROM e GROUP BY 1",
        "key_alignment": g + "SELECT event_type, end_s, (n > 0)::BIGINT AS a, (n < 3)::BIGINT AS b, CAST(1 AS BIGINT) AS c FROM g WHERE NOT (n > 0 AND n < 3)",
        "exact_share_parse": "SELECT l_linenumber, count(*) AS n, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE count(*) END AS admitted, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(20, 3))) AS DECIMAL(38, 9)) AS VARCHAR) END AS total FROM lineitem GROUP BY 1",
        "multi_join_star": "SELECT r_name, c_mktsegment, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines, count(DISTINCT o_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_quantity < 24 GROUP BY 1, 2",
        "strict_runs": status + f""", z AS (SELECT *, event_type || ':' || session AS seg, end_s % 104400 = 0 AS halt, row_number() {O} AS rn FROM s),
            a AS (SELECT *, status = 'matching' AND NOT halt AS m, CASE WHEN halt THEN 'halt' WHEN status <> 'matching' THEN status END AS own, CASE WHEN rn = 1 THEN 'member_boundary' WHEN seg <> lag(seg) {O} THEN 'selection_boundary' END AS entry FROM z),
            b AS (SELECT *, m AND (entry IS NOT NULL OR NOT lag(m) {O}) AS st, coalesce(entry, lag(own) {O}) AS pre, coalesce(lead(entry) {O}, lead(own) {O}, CASE WHEN lead(end_s) {O} IS NULL THEN CASE WHEN event_type = (SELECT max(event_type) FROM g) THEN 'selection_boundary' ELSE 'member_boundary' END END) AS post FROM a),
            c AS (SELECT *, sum(st::INT) {W} AS r FROM b WHERE m),
            d AS (SELECT event_type, r, arg_min(seg, end_s) AS selection_segment_id, min(end_s) AS first_endpoint, max(end_s) AS last_endpoint, count(*) AS match_count, arg_min(pre, end_s) AS preceding_reason, arg_max(post, end_s) AS closure_reason FROM c GROUP BY 1, 2),
            e AS (SELECT *, row_number() OVER (ORDER BY event_type, first_endpoint) - 1 AS run_ordinal FROM d)
            SELECT sha256(concat_ws('|', 'demo', event_type, selection_segment_id, first_endpoint, run_ordinal)) AS run_id, run_ordinal, event_type, selection_segment_id, first_endpoint, last_endpoint, match_count, (last_endpoint - first_endpoint) // 3600 AS elapsed_steps,
              preceding_reason, closure_reason, preceding_reason = 'selection_boundary' AS left_censored, closure_reason = 'selection_boundary' AS right_censored FROM e""",
    }
    sql["dense_histogram"] = f"""WITH h AS ({sql["joint_histogram"]}) SELECT p.l_linestatus, CAST(x AS INTEGER) AS x_bin, CAST(y AS INTEGER) AS y_bin, CAST(coalesce(n, 0) AS BIGINT) AS n
      FROM (SELECT DISTINCT l_linestatus FROM h) p CROSS JOIN range(6) a(x) CROSS JOIN range(5) b(y) LEFT JOIN h ON h.l_linestatus = p.l_linestatus AND h.x_bin = x AND h.y_bin = y"""
    sql["ecdf_curve"] = f"""WITH b AS ({sql["binned_ecdf"]}) SELECT session, bin, n, share, round(least(exp(bin * 0.25) - 1, 60.0), 6) AS x FROM b WHERE metric = 'mean'"""
    return sql | replay_oracles.oracle_sql() | engine_oracles.oracle_sql()
