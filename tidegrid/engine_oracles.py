"""DuckDB SQL of the source and engine queries, from the events table alone."""

from __future__ import annotations

from tidegrid.replay_oracles import EVENTS, FEATURED, REPLAY, RUN_TAIL, S

_MEMBERS = "symbol IN ('CLICK', 'ERROR', 'VIEW')"
_SCOPE = f"{_MEMBERS} AND second BETWEEN 51 AND 849"
_FIELDS = "trade_rate_per_second_hl4s_reason_mask = 0 AND quote_age_reason_mask = 0"
_HOLDS = "trade_rate_per_second_hl4s > 0.2 AND quote_age_seconds <= 1.5"
STATUS = FEATURED + f""",
es AS (SELECT *, CASE WHEN NOT ({_FIELDS}) THEN 'unavailable' WHEN {_HOLDS} THEN 'matching' ELSE 'nonmatching' END AS status FROM ft WHERE {_SCOPE}),
u0 AS (SELECT *, NULL::VARCHAR AS bef, NULL::VARCHAR AS aft FROM es)"""
PAIRS = f"""WITH {EVENTS},
st AS (SELECT symbol, 'quotes' AS stream, r, seq FROM qa UNION ALL SELECT symbol, 'trades', r, seq FROM tc),
un AS (SELECT symbol, stream, r, seq, count(*) AS n FROM st GROUP BY ALL),
pr AS (SELECT symbol, stream, CAST(sum(n) AS BIGINT) AS rows, min(r) AS first, max(r) AS last, CAST(sum(n - 1) AS BIGINT) AS repeated_keys FROM un GROUP BY 1, 2)
"""


def oracle_sql() -> dict[str, str]:
    runs = f"WITH {STATUS}{RUN_TAIL}"
    return {
        "events_scanned": f"WITH {EVENTS} SELECT symbol, seq AS sequence_number, r, bid AS bid_price FROM qa WHERE r >= 200 * {S}::BIGINT AND r < 600 * {S}::BIGINT",
        "records_read": f"WITH {EVENTS} SELECT symbol, count(*) AS trades, sum(price) AS prices, count(DISTINCT CASE WHEN seq % 19 = 0 THEN '0' ELSE seq % 9 || '.5' END) AS sizes FROM tc GROUP BY 1",
        "pair_report": PAIRS + "SELECT symbol, stream, rows, first, last, repeated_keys FROM pr",
        "pair_inventory": PAIRS + """, pl AS (SELECT DISTINCT symbol FROM ev UNION ALL SELECT 'NONE'),
          ct AS (SELECT symbol, count(*) AS streams, CAST(sum(rows) AS BIGINT) AS event_count, sum(repeated_keys) AS rep FROM pr WHERE NOT (symbol = 'VIEW' AND stream = 'trades') GROUP BY 1)
          SELECT symbol, event_count, coalesce(streams = 2 AND rep = 0, false) AS complete, streams IS NULL AS missing FROM pl LEFT JOIN ct USING (symbol)""",
        "study_pair_written": PAIRS + "SELECT symbol, stream, rows, form FROM pr, (VALUES ('json'), ('csv')) f(form)",
        "catalog_verified": "SELECT symbol, CAST(CASE WHEN symbol = 'ERROR' THEN 1 ELSE 0 END AS BIGINT) AS changed FROM (SELECT DISTINCT upper(event_type) AS symbol FROM events)",
        "engine_sql": f"""WITH {FEATURED} SELECT symbol, second, 'premarket' AS session, round(share_rate_per_second_hl4s, 6) AS share_rate, round(trade_age_seconds, 9) AS trade_age FROM ft
          WHERE {_MEMBERS} AND share_rate_per_second_hl4s > 0.55 AND trade_age_seconds <= 2 AND share_rate_per_second_hl4s_reason_mask = 0""",
        "engine_projected": f"""WITH {FEATURED} SELECT symbol, second, round(CASE WHEN midpoint_rms_5s_to_spread_hl16s_reason_mask = 0 THEN midpoint_rms_5s_to_spread_hl16s END, 6) AS midpoint_rms_5s_to_spread_hl16s,
          CAST(midpoint_rms_5s_to_spread_hl16s_reason_mask AS BIGINT) AS midpoint_rms_5s_to_spread_hl16s_reason_mask, round(midpoint_change_age_seconds, 9) AS midpoint_change_age_seconds,
          CAST(midpoint_change_age_reason_mask AS BIGINT) AS midpoint_change_age_reason_mask FROM ft WHERE {_MEMBERS}""",
        "engine_observations": f"""WITH {STATUS} SELECT symbol, second, round(trade_rate_per_second_hl4s, 6) AS trade_rate_per_second_hl4s, CAST(trade_rate_per_second_hl4s_reason_mask AS BIGINT) AS trade_rate_per_second_hl4s_reason_mask,
          round(quote_age_seconds, 6) AS quote_age_seconds, CAST(quote_age_reason_mask AS BIGINT) AS quote_age_reason_mask, round(quoted_spread_bps_hl4s, 6) AS quoted_spread_bps_hl4s,
          CAST(quoted_spread_bps_hl4s_reason_mask AS BIGINT) AS quoted_spread_bps_hl4s_reason_mask FROM es WHERE status = 'matching'""",
        "engine_runs": runs + """ SELECT symbol, CAST(first_second AS BIGINT) AS first_second, CAST(last_second AS BIGINT) AS last_second, match_count, row_number() OVER (ORDER BY symbol, first_second) - 1 AS run_ordinal,
          pre AS preceding_reason, post AS closure_reason FROM u6""",
        "engine_accounting": f"""WITH {STATUS} SELECT symbol, count(*) AS selected, count(*) FILTER (WHERE status <> 'unavailable') AS eligible, count(*) FILTER (WHERE status = 'matching') AS matching,
          count(*) FILTER (WHERE status = 'nonmatching') AS nonmatching, count(*) FILTER (WHERE status = 'unavailable') AS unavailable FROM es GROUP BY 1""",
        "engine_export": runs + """ SELECT 'observations' AS "table", CAST(count(*) AS BIGINT) AS rows FROM es WHERE status = 'matching' UNION ALL SELECT 'runs', count(*) FROM u6 UNION ALL SELECT 'accounting', count(DISTINCT symbol) FROM es
          UNION ALL SELECT 'contributions', count(DISTINCT symbol) FROM es""",
        "engine_results": f"""WITH {REPLAY}, a AS (SELECT symbol, trade_age_seconds AS x FROM rp WHERE {_MEMBERS}), c AS (SELECT count(*) AS n, count(x) AS k, count(DISTINCT symbol) AS s FROM a)
          SELECT 'arrow' AS way, CAST(n AS BIGINT) AS rows, CAST(k AS BIGINT) AS more FROM c UNION ALL SELECT 'frame', s, k FROM c UNION ALL SELECT 'preview', least(n, 60), CASE WHEN n > 60 THEN 1 ELSE 0 END FROM c
          UNION ALL SELECT 'export', n, 0 FROM c UNION ALL SELECT 'empty', 0, 2 UNION ALL SELECT 'columns', 2, 2""",
    }
