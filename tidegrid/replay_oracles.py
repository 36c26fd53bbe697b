"""DuckDB SQL of the replay, feature, validation and selection queries, from the events table alone.

Times are nanoseconds since the session's start.  Exponentially weighted sums
are direct sums of weighted terms, age quantiles aggregates over a self join.
"""

from __future__ import annotations

from tidegrid.functions import masks as M

S = 1_000_000_000
_QGAP, _TGAP = (300_300_000_000, 302_700_000_000), (500_000_000_000, 503_000_001_000)
_QBREAKS, _TBREAKS = (100_000_000_000, 250_000_123_000), (170_000_077_000,)
_HALTED = (701, 704)
W = "ORDER BY r, rk, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_SRC = {s: f"CASE {s}_status WHEN 0 THEN 2 WHEN 2 THEN 1 ELSE 0 END" for s in ("quote", "trade")}


def _in_gap(gap: tuple[int, int], at: str = "r") -> str:
    return f"({at} >= {gap[0]} AND {at} < {gap[1]})"


def _over(gap: tuple[int, int], a: str, b: str) -> str:
    return f"greatest(0, least({b}, {gap[1]}) - greatest({a}, {gap[0]}))"


def _resets(side_gap, breaks) -> str:
    return ", ".join(f"({x})" for x in (*breaks, side_gap[0], (_HALTED[0] - 1) * S))


def _marks(side_gap, breaks, test: str) -> str:
    return " OR ".join(f"({x} {test} t - {S} AND {x} < t)" for x in (*breaks, side_gap[0]))


def _supported(ns: str, side: str, invalid: str, broken: str) -> str:
    return (
        f"CASE WHEN coalesce({ns}, 0) > 0 THEN 0 ELSE 32 | CASE WHEN halt THEN 4 ELSE 0 END | {_SRC[side]} | CASE WHEN NOT halt AND {invalid} THEN 64 ELSE 0 END | CASE WHEN NOT halt AND {broken} THEN 512 ELSE 0 END END"
    )


def _current(valid: str, side: str, broken: str, missing: int = 64, bound: str = "false") -> str:
    return f"CASE WHEN halt THEN 4 | {_SRC[side]} WHEN {side}_status <> 1 THEN {_SRC[side]} WHEN {valid} THEN 0 WHEN {bound} THEN 256 ELSE {missing} | CASE WHEN {broken} THEN 512 ELSE 0 END END"


EVENTS = f"""
ev AS MATERIALIZED (SELECT upper(event_type) AS symbol, event_id, user_id, value, (epoch_us(ts) % 900000000) * 1000 AS r FROM events),
sec AS (SELECT symbol, k, k * {S}::BIGINT AS t, k BETWEEN {_HALTED[0]} AND {_HALTED[1]} AS halt FROM (SELECT DISTINCT symbol FROM ev), (SELECT CAST(k AS BIGINT) AS k FROM range(1, 901) x(k))),
qa AS (
  SELECT symbol, r, event_id AS seq, 100 + (CAST(floor(value) AS BIGINT) % 40) / 8.0::DOUBLE AS bid, 100 + (CAST(floor(value) AS BIGINT) % 40) / 8.0::DOUBLE + (event_id % 5 - 1) / 8.0::DOUBLE AS ask,
         (event_id % 4) * 10.0::DOUBLE AS bs, CASE WHEN user_id % 7 <> 0 THEN (user_id % 5) * 10.0::DOUBLE END AS sz, CASE WHEN event_id % 23 = 0 THEN 2 WHEN event_id % 29 = 0 THEN 85 ELSE 0 END AS code
  FROM ev WHERE event_id % 3 <> 0
),
qc AS (
  SELECT *, code <> 2 AND ask >= bid AS valid, code <> 2 AND ask >= bid AND NOT (code = 85 AND bid <> ask) AS spread_ok, code <> 2 AND ask >= bid AND bs > 0 AS bid_ok, code <> 2 AND ask >= bid AND coalesce(sz, 0) > 0 AS ask_ok
  FROM qa
),
tc AS (
  SELECT symbol, r, event_id AS seq, 100 + (CAST(floor(value) AS BIGINT) % 16) / 16.0::DOUBLE AS price, event_id % 9 + 0.5::DOUBLE AS shares,
         CASE WHEN event_id % 13 = 0 THEN 'excluded' WHEN event_id % 17 = 0 THEN 'uncertain' WHEN event_id % 11 = 0 OR event_id % 4 = 3 OR event_id % 19 = 0 THEN 'excluded' ELSE 'eligible' END AS kind
  FROM ev WHERE event_id % 3 = 0
)
"""

REPLAY = EVENTS + f""",
q0 AS (
  SELECT symbol, r, 1 AS rk, seq, valid, spread_ok, bid_ok, ask_ok, CASE WHEN valid THEN bid END AS bid, CASE WHEN valid THEN ask END AS ask, CASE WHEN bid_ok THEN bs * 100 END AS bsh, CASE WHEN ask_ok THEN sz * 100 END AS ash
  FROM qc WHERE NOT {_in_gap(_QGAP)} AND NOT (r // {S} + 1 BETWEEN {_HALTED[0]} AND {_HALTED[1]})
  UNION ALL SELECT symbol, x.r, 0, -1, false, false, false, false, NULL, NULL, NULL, NULL FROM (SELECT DISTINCT symbol FROM ev), (VALUES {_resets(_QGAP, _QBREAKS)}) x(r)
),
q1 AS (
  SELECT *, sum(CASE WHEN rk = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol {W}) AS reset_id, sum(CASE WHEN rk = 0 OR NOT valid THEN 1 ELSE 0 END) OVER (PARTITION BY symbol {W}) AS run,
         coalesce(lead(r) OVER (PARTITION BY symbol ORDER BY r, rk, seq), 900 * {S}::BIGINT) AS until, CASE WHEN valid THEN bid / 2 + ask / 2 END AS mid
  FROM q0
),
q2 AS (
  SELECT *, last_value(mid IGNORE NULLS) OVER (PARTITION BY symbol, run ORDER BY r, rk, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous,
         bool_or(rk = 1 AND NOT valid) OVER (PARTITION BY symbol, reset_id {W}) AS invalid_seen, max(CASE WHEN rk = 1 THEN r END) OVER (PARTITION BY symbol, reset_id {W}) AS last_quote,
         CASE WHEN valid THEN min(CASE WHEN valid THEN r END) OVER (PARTITION BY symbol, run {W}) END AS origin
  FROM q1
),
q3 AS (SELECT *, CASE WHEN valid THEN max(CASE WHEN valid AND mid <> previous THEN r END) OVER (PARTITION BY symbol, run {W}) END AS last_change FROM q2),
pc AS (
  SELECT s.symbol, s.k, q.*, greatest(q.r, s.t - {S}) AS a, least(q.until, s.t) AS b FROM q3 q JOIN sec s ON s.symbol = q.symbol AND q.r < s.t AND q.until > s.t - {S} WHERE q.valid AND q.until > q.r AND NOT s.halt
),
pn AS (SELECT *, (b - a) - {_over(_QGAP, "a", "b")} AS ns FROM pc),
ig AS (
  SELECT symbol, k, sum(bid * (ns / {S}.0::DOUBLE)) AS bid_sum, sum(ask * (ns / {S}.0::DOUBLE)) AS ask_sum, sum(ns) AS price_ns,
         sum(10000 * (ask - bid) / mid * (ns / {S}.0::DOUBLE)) FILTER (WHERE spread_ok) AS spread_sum, sum(ns) FILTER (WHERE spread_ok) AS spread_ns, sum(bsh * (ns / {S}.0::DOUBLE)) FILTER (WHERE bid_ok) AS bid_size_sum,
         sum(ns) FILTER (WHERE bid_ok) AS bid_size_ns, sum(ash * (ns / {S}.0::DOUBLE)) FILTER (WHERE ask_ok) AS ask_size_sum, sum(ns) FILTER (WHERE ask_ok) AS ask_size_ns
  FROM pn WHERE ns > 0 GROUP BY symbol, k
),
ql AS (SELECT * FROM q3 QUALIFY row_number() OVER (PARTITION BY symbol, r ORDER BY rk DESC, seq DESC) = 1),
qs AS (
  SELECT s.symbol, s.k, coalesce(valid, false) AS valid, bid, ask, coalesce(bid_ok, false) AS bid_ok, coalesce(ask_ok, false) AS ask_ok, bsh, ash, origin, last_change, last_quote, coalesce(invalid_seen, false) AS invalid_seen,
         coalesce(rk = 0, false) AS broken, coalesce(reset_id, 0) AS qcont
  FROM sec s ASOF LEFT JOIN ql ON s.symbol = ql.symbol AND s.t > ql.r
),
ta AS (SELECT * FROM tc WHERE kind <> 'excluded' AND NOT {_in_gap(_TGAP)} AND NOT (r // {S} + 1 BETWEEN {_HALTED[0]} AND {_HALTED[1]})),
ac AS (
  SELECT symbol, r // {S} + 1 AS k, count(*) FILTER (WHERE kind = 'eligible') AS n, sum(shares) FILTER (WHERE kind = 'eligible') AS shares, sum(price * shares) FILTER (WHERE kind = 'eligible') AS dollars, bool_or(kind = 'uncertain') AS uncertain
  FROM ta GROUP BY ALL
),
t0 AS (SELECT symbol, r, 1 AS rk, seq, kind FROM ta UNION ALL SELECT symbol, x.r, 0, -1, 'reset' FROM (SELECT DISTINCT symbol FROM ev), (VALUES {_resets(_TGAP, _TBREAKS)}) x(r)),
t1 AS (
  SELECT *, CASE WHEN kind = 'eligible' THEN r END AS last_trade, last_value(CASE WHEN kind <> 'uncertain' THEN kind = 'reset' END IGNORE NULLS) OVER (PARTITION BY symbol {W}) AS t_broken,
         sum(CASE WHEN rk = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol {W}) AS t_cont
  FROM t0
),
tl AS (SELECT * FROM t1 QUALIFY row_number() OVER (PARTITION BY symbol, r ORDER BY rk DESC, seq DESC) = 1),
ts AS (SELECT s.symbol, s.k, last_trade, coalesce(t_broken, false) AS t_broken, coalesce(t_cont, 0) AS tcont FROM sec s ASOF LEFT JOIN tl ON s.symbol = tl.symbol AND s.t > tl.r),
j AS (
  SELECT s.symbol, s.k, s.t, s.halt, CASE WHEN {_in_gap(_QGAP, "s.t - 1")} THEN 2 ELSE 1 END AS quote_status, CASE WHEN {_in_gap(_TGAP, "s.t - 1")} THEN 2 ELSE 1 END AS trade_status,
         {S} - {_over(_QGAP, f"s.t - {S}", "s.t")} AS q_obs, {S} - {_over(_TGAP, f"s.t - {S}", "s.t")} AS t_obs, qs.* EXCLUDE (symbol, k), ts.* EXCLUDE (symbol, k), ig.* EXCLUDE (symbol, k), n, shares, dollars, coalesce(uncertain, false) AS uncertain
  FROM sec s JOIN qs USING (symbol, k) JOIN ts USING (symbol, k) LEFT JOIN ig USING (symbol, k) LEFT JOIN ac USING (symbol, k)
),
j2 AS (
  SELECT *, CASE WHEN halt OR uncertain THEN 0 ELSE t_obs END AS active_ns, CASE WHEN halt OR NOT valid THEN 0 WHEN last_change IS NOT NULL THEN 2 ELSE 1 END AS mid_status, k = {_HALTED[0]} AS entry FROM j
),
rp AS MATERIALIZED (
  SELECT symbol, k AS second, halt AS halt_active, CASE WHEN halt THEN 'h1' END AS halt_id,
    CASE WHEN price_ns > 0 THEN bid_sum / (price_ns / {S}.0::DOUBLE) END AS bid_twap_usd, CASE WHEN price_ns > 0 THEN ask_sum / (price_ns / {S}.0::DOUBLE) END AS ask_twap_usd,
    CASE WHEN price_ns > 0 THEN bid_sum / (price_ns / {S}.0::DOUBLE) / 2 + ask_sum / (price_ns / {S}.0::DOUBLE) / 2 END AS midpoint_twap_usd, coalesce(price_ns, 0) AS price_valid_duration_ns,
    {_supported("price_ns", "quote", "invalid_seen", "broken")} AS price_twap_reason_mask, CASE WHEN valid AND NOT halt THEN bid END AS bid_end_usd, CASE WHEN valid AND NOT halt THEN ask END AS ask_end_usd,
    {_current("valid", "quote", "broken")} AS price_end_reason_mask, CASE WHEN spread_ns > 0 THEN spread_sum END AS spread_integral_bps_seconds, coalesce(spread_ns, 0) AS spread_valid_duration_ns,
    {_supported("spread_ns", "quote", "invalid_seen", "broken")} AS spread_integral_reason_mask,
    CASE WHEN bid_size_ns > 0 THEN bid_size_sum END AS bid_size_integral_shares_seconds, coalesce(bid_size_ns, 0) AS bid_size_valid_duration_ns, {_supported("bid_size_ns", "quote", "invalid_seen", "broken")} AS bid_size_integral_reason_mask,
    CASE WHEN ask_size_ns > 0 THEN ask_size_sum END AS ask_size_integral_shares_seconds, coalesce(ask_size_ns, 0) AS ask_size_valid_duration_ns, {_supported("ask_size_ns", "quote", "invalid_seen", "broken")} AS ask_size_integral_reason_mask,
    CASE WHEN bid_ok AND NOT halt THEN bsh END AS bid_size_end_shares, CASE WHEN ask_ok AND NOT halt THEN ash END AS ask_size_end_shares,
    {_current("bid_ok", "quote", "broken")} AS bid_size_end_reason_mask, {_current("ask_ok", "quote", "broken")} AS ask_size_end_reason_mask,
    CASE WHEN active_ns > 0 THEN coalesce(n, 0) END AS trade_count_1s, CASE WHEN active_ns > 0 THEN coalesce(shares, 0) END AS share_volume_1s, CASE WHEN active_ns > 0 THEN coalesce(dollars, 0) END AS dollar_volume_1s_usd,
    active_ns AS activity_valid_duration_ns, {_supported("active_ns", "trade", "uncertain", "t_broken")} AS activity_reason_mask,
    CASE WHEN NOT halt THEN (t - last_trade) / {S}.0::DOUBLE END AS trade_age_seconds, {_current("last_trade IS NOT NULL", "trade", "t_broken", 128)} AS trade_age_reason_mask,
    CASE WHEN NOT halt THEN (t - last_quote) / {S}.0::DOUBLE END AS quote_age_seconds, {_current("last_quote IS NOT NULL", "quote", "broken", 128)} AS quote_age_reason_mask,
    CASE WHEN mid_status = 2 THEN (t - last_change) / {S}.0::DOUBLE END AS midpoint_change_age_seconds, {_current("mid_status = 2", "quote", "broken", 64, "mid_status = 1")} AS midpoint_change_age_reason_mask,
    mid_status AS midpoint_age_status, CASE WHEN mid_status > 0 THEN origin END AS origin_ns, CASE WHEN mid_status = 1 THEN (t - origin) / {S}.0::DOUBLE END AS midpoint_age_lower_bound_seconds,
    quote_status AS quote_source_status, trade_status AS trade_source_status, quote_status, trade_status, q_obs AS quote_observed_duration_ns, t_obs AS trade_observed_duration_ns, qcont AS quote_continuity_id, tcont AS trade_continuity_id,
    entry OR {_marks(_QGAP, _QBREAKS, ">=")} AS quote_continuity_break_in_second, entry OR {_marks(_TGAP, _TBREAKS, ">=")} AS trade_continuity_break_in_second,
    {_marks(_QGAP, _QBREAKS, ">")} AS quote_interior_break, {_marks(_TGAP, _TBREAKS, ">")} AS trade_interior_break
  FROM j2
)
"""

_ROUND = {
    "bid_twap_usd", "ask_twap_usd", "midpoint_twap_usd", "bid_end_usd", "ask_end_usd", "bid_size_integral_shares_seconds", "ask_size_integral_shares_seconds", "bid_size_end_shares", "ask_size_end_shares", "dollar_volume_1s_usd",
    "trade_age_seconds", "quote_age_seconds", "midpoint_change_age_seconds", "midpoint_age_lower_bound_seconds",
}
_FLAGS = {"halt_active", "halt_id", "shares", "selected"} | {f"{s}_{k}" for s in ("quote", "trade") for k in ("continuity_break_in_second", "interior_break")}


def _show(*names: str, places: int = 9, source: str = "rp", floats: bool | None = None) -> str:
    def one(n):
        if floats or (floats is None and n in _ROUND):
            return f"round({n}, {places}) AS {n}"
        return n if n in _FLAGS else f"CAST({n} AS BIGINT) AS {n}"

    return f"SELECT symbol, second, {', '.join(one(n) for n in names)} FROM {source}"


_QUOTE_COLS = (
    "bid_twap_usd", "ask_twap_usd", "midpoint_twap_usd", "price_valid_duration_ns", "price_twap_reason_mask", "bid_end_usd", "ask_end_usd", "price_end_reason_mask", "spread_valid_duration_ns", "spread_integral_reason_mask",
    "bid_size_integral_shares_seconds", "bid_size_valid_duration_ns", "bid_size_integral_reason_mask", "ask_size_integral_shares_seconds", "ask_size_valid_duration_ns", "ask_size_integral_reason_mask", "bid_size_end_shares",
    "ask_size_end_shares", "bid_size_end_reason_mask", "ask_size_end_reason_mask",
)

# --- features ---------------------------------------------------------------------

VIEWS = ((4, 10), (16, 40))
FAMILIES = {"return": ("quote", "ring", 0.8), "spread": ("quote", "possible", 0.9), "activity": ("trade", "possible", 0.8), "bid_size": ("quote", "possible", 0.8), "ask_size": ("quote", "possible", 0.8)}
_INPUTS = {
    "u1": "abs(ret)", "u2": "ret * ret", "possible": "1.0", "ring": "CASE WHEN elapsed > 5 THEN 1.0 END", "n_spread": "spread_integral_bps_seconds", "n_trades": "trade_count_1s", "n_shares": "share_volume_1s",
    "n_dollars": "dollar_volume_1s_usd", "n_bid": "bid_size_integral_shares_seconds", "n_ask": "ask_size_integral_shares_seconds", "w_return": "CASE WHEN ret IS NOT NULL THEN 1.0 END",
    **{f"w_{k}": f"{k}_valid_duration_ns / {S}.0::DOUBLE" for k in ("spread", "activity", "bid_size", "ask_size")},
}
EW = REPLAY + f""",
f0 AS (SELECT *, CAST(sum(halt_active::INT) OVER (PARTITION BY symbol ORDER BY second) AS BIGINT) AS epoch, CASE WHEN NOT halt_active AND price_end_reason_mask = 0 THEN bid_end_usd / 2 + ask_end_usd / 2 END AS mid FROM rp),
f1 AS (
  SELECT *, row_number() OVER e - 1 AS o, lag(mid, 5) OVER e AS back, lag(quote_continuity_id, 5) OVER e = quote_continuity_id AS same FROM f0 WINDOW e AS (PARTITION BY symbol, epoch ORDER BY second)
),
f2 AS (SELECT *, o + CASE WHEN epoch = 0 THEN 1 ELSE 0 END AS elapsed, CASE WHEN same AND back IS NOT NULL AND mid IS NOT NULL THEN 10000 * ln(mid / back) END AS ret FROM f1),
f3 AS MATERIALIZED (SELECT *, {', '.join(f"CAST(CASE WHEN NOT halt_active THEN {x} END AS DOUBLE) AS {k}" for k, x in _INPUTS.items())} FROM f2),
f4 AS MATERIALIZED (
  SELECT symbol, second, {', '.join(f"coalesce(bool_or(w_{k} > 0) OVER e, false) AS has_{k}" for k in FAMILIES)}, coalesce(bool_or(ret <> 0) OVER e, false) AS moved FROM f3 WINDOW e AS (PARTITION BY symbol, epoch ORDER BY second)
)""" + "".join(f""",
s{h} AS (
  SELECT a.symbol, a.second, {', '.join(f"sum(coalesce(b.{k}, 0) * pow(2.0, (b.o - a.o) / {h}.0::DOUBLE)) AS {k}" for k in _INPUTS)} FROM f3 a JOIN f3 b ON a.symbol = b.symbol AND a.epoch = b.epoch AND b.o <= a.o GROUP BY a.symbol, a.second
),
m{h} AS (
  SELECT s.*, f4.* EXCLUDE (symbol, second), elapsed, {', '.join(
    f"CASE f.{side}_status WHEN 0 THEN 2 WHEN 2 THEN 1 ELSE 0 END | CASE WHEN f.halt_active THEN 4 ELSE 0 END | CASE WHEN elapsed < {startup} THEN 8 ELSE 0 END | CASE WHEN NOT has_{k} THEN 32 WHEN elapsed >= {startup} AND s.w_{k} < {floor} * s.{possible} THEN 16 ELSE 0 END AS m_{k}"
    for k, (side, possible, floor) in FAMILIES.items())}
  FROM s{h} s JOIN f3 f USING (symbol, second) JOIN f4 USING (symbol, second)
),
v{h} AS (
  SELECT symbol, second, m_return AS midpoint_rms_5s_bps_hl{h}s_reason_mask, CASE WHEN m_return = 0 THEN CASE WHEN moved THEN sqrt(u2 / w_return) ELSE 0 END END AS midpoint_rms_5s_bps_hl{h}s,
    m_return | CASE WHEN m_return = 0 AND NOT moved THEN 1024 ELSE 0 END AS movement_participation_hl{h}s_reason_mask, CASE WHEN m_return = 0 AND moved THEN least(1, u1 * u1 / u2 / w_return) END AS movement_participation_hl{h}s,
    m_spread AS quoted_spread_bps_hl{h}s_reason_mask, CASE WHEN m_spread = 0 THEN n_spread / w_spread END AS quoted_spread_bps_hl{h}s,
    {', '.join(f"m_activity AS {stem}_hl{h}s_reason_mask, CASE WHEN m_activity = 0 THEN {n} / w_activity END AS {stem}_hl{h}s" for stem, n in (("trade_rate_per_second", "n_trades"), ("share_rate_per_second", "n_shares"), ("dollar_rate_usd_per_second", "n_dollars")))},
    {', '.join(f"m_{k}_size AS {k}_size_mean_shares_hl{h}s_reason_mask, CASE WHEN m_{k}_size = 0 THEN n_{k} / w_{k}_size END AS {k}_size_mean_shares_hl{h}s" for k in ("bid", "ask"))},
    m_return | m_spread | CASE WHEN m_return | m_spread = 0 AND n_spread = 0 THEN 2048 ELSE 0 END AS midpoint_rms_5s_to_spread_hl{h}s_reason_mask,
    CASE WHEN m_return | m_spread = 0 AND n_spread <> 0 THEN CASE WHEN moved THEN sqrt(u2 / w_return) ELSE 0 END / (n_spread / w_spread) END AS midpoint_rms_5s_to_spread_hl{h}s,
    w_return AS return_usable_weight_hl{h}s, ring AS return_possible_weight_hl{h}s, {', '.join(f"w_{k} AS {k}_usable_exposure_seconds_hl{h}s, possible AS {k}_possible_exposure_seconds_hl{h}s" for k in list(FAMILIES)[1:])}
  FROM m{h}
)""" for h, startup in VIEWS)

STEMS = ("midpoint_rms_5s_bps", "movement_participation", "quoted_spread_bps", "trade_rate_per_second", "share_rate_per_second", "dollar_rate_usd_per_second", "bid_size_mean_shares", "ask_size_mean_shares", "midpoint_rms_5s_to_spread")
VALUES = [f"{s}_hl{h}s" for h, _ in VIEWS for s in STEMS]
SUPPORT = [f"{f}_hl{h}s" for h, _ in VIEWS for f in ("return_usable_weight", "return_possible_weight", *[f"{k}_{u}_exposure_seconds" for k in list(FAMILIES)[1:] for u in ("usable", "possible")])]

AGES = ("trade", "quote", "midpoint_change")
WINDOWS = (20, 60)


def _age(age: str, w: int) -> str:
    side = "trade" if age == "trade" else "quote"
    return f""",
x_{age}_{w} AS (
  SELECT a.symbol, a.second, least(a.slot_{side}, {w}) AS slots, count(b.{age}_known) AS n, quantile_cont(b.{age}_known, 0.9) AS p, any_value(a.{side}_status) AS status, any_value(a.halt_active) AS halt
  FROM a1 a JOIN a1 b ON a.symbol = b.symbol AND a.e_{side} = b.e_{side} AND b.slot_{side} BETWEEN a.slot_{side} - {w - 1} AND a.slot_{side} GROUP BY a.symbol, a.second, a.slot_{side}
),
y_{age}_{w} AS (
  SELECT *, CASE status WHEN 0 THEN 2 WHEN 2 THEN 1 ELSE 0 END | CASE WHEN halt THEN 4 ELSE 0 END | CASE WHEN slots < {w} THEN 8 ELSE 0 END | CASE WHEN n = 0 THEN 32 WHEN slots >= {w} AND n < ceil(0.8 * {w}) THEN 16 ELSE 0 END AS mask FROM x_{age}_{w}
),
z_{age}_{w} AS (
  SELECT symbol, second, CASE WHEN mask = 0 THEN p END AS {age}_age_p90_seconds_window{w}s, mask AS {age}_age_p90_seconds_window{w}s_reason_mask, n AS {age}_age_sample_count_window{w}s, slots AS {age}_age_elapsed_slots_window{w}s FROM y_{age}_{w}
)"""


_AGE_ROWS = ", ".join(f"sum(({s}_a)::INT) OVER (PARTITION BY symbol, e_{s} ORDER BY second) AS slot_{s}" for s in ("quote", "trade"))
AGE = f""",
a0 AS (
  SELECT *, {', '.join(f"sum((halt_active OR {s}_continuity_break_in_second)::INT) OVER (PARTITION BY symbol ORDER BY second) AS e_{s}, NOT halt_active AND {s}_observed_duration_ns = {S} AND NOT {s}_interior_break AS {s}_a" for s in ("quote", "trade"))}
  FROM rp
),
a1 AS MATERIALIZED (
  SELECT *, {_AGE_ROWS}, {', '.join(f"CASE WHEN {'trade' if a == 'trade' else 'quote'}_a AND {a}_age_reason_mask = 0 THEN {a}_age_seconds END AS {a}_known" for a in AGES)} FROM a0
)""" + "".join(_age(a, w) for w in WINDOWS for a in AGES)
_AGE_JOIN = " JOIN ".join(f"z_{a}_{w}{' USING (symbol, second)' if i else ''}" for i, (a, w) in enumerate((a, w) for w in WINDOWS for a in AGES))


def _ages_shown() -> str:
    cols = []
    for w in WINDOWS:
        for a in AGES:
            p = f"{a}_age_p90_seconds_window{w}s"
            cols += [f"round({p}, 8) AS {p}", f"CAST({p}_reason_mask AS BIGINT) AS {p}_reason_mask", f"CAST({a}_age_sample_count_window{w}s AS BIGINT) AS {a}_age_sample_count_window{w}s", f"CAST({a}_age_elapsed_slots_window{w}s AS BIGINT) AS {a}_age_elapsed_slots_window{w}s"]
    return f"SELECT symbol, second, {', '.join(cols)} FROM {_AGE_JOIN}"


# --- validation ---------------------------------------------------------------------


def _finite(x: str) -> str:
    return f"({x} IS NULL OR isfinite(CAST({x} AS DOUBLE)))"


def _implies(a: str, b: str) -> str:
    return f"(NOT coalesce({a}, false) OR coalesce({b}, false))"


def _has(mask: str, value: int) -> str:
    return f"({mask} & {value} <> 0)"


def _near(a: str, b: str, rtol: float, atol: float = 0.0) -> str:
    return f"(abs({a} - ({b})) <= greatest({atol}, {rtol} * greatest(abs({a}), abs({b}))))"


def _value(name: str, mask: str, allowed: int, positive: bool = False, most: float | None = None) -> dict[str, str]:
    domain = f"isfinite(CAST({name} AS DOUBLE)) AND {name} {'>' if positive else '>='} 0" + (f" AND {name} <= {most}" if most is not None else "")
    return {f"{name}: reasons": f"{mask} & {~allowed & 0xFFFF} = 0", f"{name}: null if and only if masked": f"({name} IS NULL) = ({mask} <> 0)", f"{name}: domain": f"({name} IS NULL OR ({domain}))"}


_BASE = M.SOURCE_UNAVAILABLE | M.SOURCE_UNVERIFIED | M.HALT | M.NO_SUPPORTED_DATA | M.INVALID_CURRENT_VALUE | M.CONTINUITY_BREAK
_BASE_VALUES = {
    "price_twap": ("bid_twap_usd", "ask_twap_usd", "midpoint_twap_usd"), "price_end": ("bid_end_usd", "ask_end_usd"), "spread_integral": ("spread_integral_bps_seconds",), "bid_size_integral": ("bid_size_integral_shares_seconds",),
    "ask_size_integral": ("ask_size_integral_shares_seconds",), "bid_size_end": ("bid_size_end_shares",), "ask_size_end": ("ask_size_end_shares",), "activity": ("trade_count_1s", "share_volume_1s", "dollar_volume_1s_usd"),
    **{f"{a}_age": (f"{a}_age_seconds",) for a in AGES},
}
_EXPOSED = {"price_twap": "price", "spread_integral": "spread", "bid_size_integral": "bid_size", "ask_size_integral": "ask_size", "activity": "activity"}
_NULLABLE = {n for names in _BASE_VALUES.values() for n in names}


def base_rules() -> dict[str, str]:
    durations = [f"{k}_valid_duration_ns" for k in ("price", "spread", "bid_size", "ask_size", "activity")] + ["quote_observed_duration_ns", "trade_observed_duration_ns"]
    needed = ["session_date", "symbol", "interval_end_ns", "midpoint_age_status", "halt_active", *durations, *[f"{g}_reason_mask" for g in _BASE_VALUES]]
    needed += [f"{s}_{k}" for s in ("quote", "trade") for k in ("source_status", "continuity_id", "continuity_break_in_second")]
    out = {f"{n}: not null": "true" if n in ("session_date", "interval_end_ns") else f"{n} IS NOT NULL" for n in needed}
    out |= {f"{n}: finite": _finite(n) for n in (*sorted(_NULLABLE - {"trade_count_1s", "share_volume_1s"}), "midpoint_age_lower_bound_seconds")}
    for g, names in _BASE_VALUES.items():
        allowed = _BASE | (128 if g.endswith("_age") else 0) | (256 if g == "midpoint_change_age" else 0)
        for n in names:
            out |= _value(n, f"{g}_reason_mask", allowed, g in ("price_twap", "price_end", "bid_size_end", "ask_size_end"))
        out[f"{g}: a halt is named"] = _implies("halt_active", _has(f"{g}_reason_mask", 4))
    for g, k in _EXPOSED.items():
        ns, m = f"{k}_valid_duration_ns", f"{g}_reason_mask"
        out |= {f"{g}: exposure and mask agree": f"({ns} = 0) = ({m} <> 0)", f"{g}: no exposure is named": _implies(f"{ns} = 0", _has(m, 32)), f"{g}: closed in a halt": _implies("halt_active", f"{ns} = 0")}
    out |= {f"{n}: within a second": f"{n} BETWEEN 0 AND {S}" for n in durations}
    out["price exposure within observation"] = "price_valid_duration_ns <= quote_observed_duration_ns"
    out["activity exposure within observation"] = "activity_valid_duration_ns <= trade_observed_duration_ns"
    out |= {f"{k} exposure within prices": f"{k}_valid_duration_ns <= price_valid_duration_ns" for k in ("spread", "bid_size", "ask_size")}
    for side, groups in (("quote", ("price_end", "bid_size_end", "ask_size_end", "quote_age", "midpoint_change_age")), ("trade", ("trade_age",))):
        status = f"{side}_source_status"
        out |= {f"{side}: known status": f"{status} IN (0, 1, 2)", f"{side}: continuity": f"{side}_continuity_id >= 0"}
        bit = f"CASE {status} WHEN 0 THEN 2 WHEN 2 THEN 1 ELSE 0 END"
        out |= {f"{g}: names its source's state": f"{g}_reason_mask & {bit} = {bit}" for g in groups}
    out |= {f"{k} size needs prices": _implies(f"{k}_size_end_shares IS NOT NULL", "bid_end_usd IS NOT NULL") for k in ("bid", "ask")}
    age, low, mask = "midpoint_change_age_seconds", "midpoint_age_lower_bound_seconds", "midpoint_change_age_reason_mask"
    out |= {
        "prices not crossed": "bid_end_usd IS NULL OR bid_end_usd <= ask_end_usd",
        "averages agree": f"midpoint_twap_usd IS NULL OR (bid_twap_usd <= ask_twap_usd AND {_near('midpoint_twap_usd', 'bid_twap_usd / 2 + ask_twap_usd / 2', 1e-12)})",
        "midpoint status known": "midpoint_age_status IN (0, 1, 2)", "observable midpoint needs a price": _implies("midpoint_age_status <> 0", "bid_end_usd IS NOT NULL"),
        "unobservable midpoint is empty": _implies("midpoint_age_status = 0", f"{age} IS NULL AND origin_ns IS NULL AND {low} IS NULL"),
        "lower bound state": _implies("midpoint_age_status = 1", f"{age} IS NULL AND origin_ns IS NOT NULL AND {low} IS NOT NULL AND {_has(mask, 256)}"),
        "lower bound value": _implies("midpoint_age_status = 1", _near(low, f"(second * {S}::BIGINT - origin_ns) / {S}.0::DOUBLE", 1e-12)),
        "known age state": _implies("midpoint_age_status = 2", f"{age} IS NOT NULL AND origin_ns IS NOT NULL AND {low} IS NULL"),
        "origin in session": f"origin_ns IS NULL OR (origin_ns >= 0 AND origin_ns < second * {S}::BIGINT)", "halt has an id": "(halt_id IS NOT NULL) = halt_active",
    }
    return out


def _feature_values() -> dict[str, str]:
    out: dict[str, str] = {}
    for n in VALUES:
        allowed = M.HISTORY | (1024 if n.startswith("movement") else 0) | (2048 if "to_spread" in n else 0)
        out |= _value(n, f"{n}_reason_mask", allowed, most=1.0 if n.startswith("movement") else None)
    for w in WINDOWS:
        for a in AGES:
            n = f"{a}_age_p90_seconds_window{w}s"
            out |= _value(n, f"{n}_reason_mask", M.HISTORY)
    return out


def feature_rules() -> dict[str, str]:
    out = _feature_values()
    for h, _ in VIEWS:
        rms, part, spread, ratio = (f"{k}_hl{h}s" for k in ("midpoint_rms_5s_bps", "movement_participation", "quoted_spread_bps", "midpoint_rms_5s_to_spread"))
        both = f"({rms}_reason_mask = 0 AND {spread}_reason_mask = 0)"
        out |= {
            f"{part}: history of what it derives from": f"{part}_reason_mask & 63 = {rms}_reason_mask", f"{part}: undefined only where it must be": _implies(_has(f"{part}_reason_mask", 1024), f"{rms}_reason_mask = 0 AND {rms} = 0"),
            f"{ratio}: history of what it derives from": f"{ratio}_reason_mask & 63 = {rms}_reason_mask | {spread}_reason_mask",
            f"{ratio}: undefined only where it must be": _implies(_has(f"{ratio}_reason_mask", 2048), f"{both} AND {spread} = 0"),
            f"{ratio}: undefined wherever it must be": _implies(f"{both} AND {spread} = 0", f"{ratio}_reason_mask = 2048"),
            f"{ratio}: value": _implies(f"{both} AND {spread} <> 0", f"{ratio}_reason_mask = 0 AND {_near(ratio, f'{rms} / {spread}', 1e-10, 1e-12)}"),
        }
    return out


def support_rules() -> dict[str, str]:
    needed = ["session_date", "symbol", "interval_end_ns", *SUPPORT, "quote_ew_startup_elapsed_seconds", "trade_ew_startup_elapsed_seconds", *[f"{a}_age_{k}_window{w}s" for w in WINDOWS for a in AGES for k in ("sample_count", "elapsed_slots")]]
    out = {f"{n}: not null": "true" if n in ("session_date", "interval_end_ns") else f"{n} IS NOT NULL" for n in needed}
    for h, _ in VIEWS:
        for p in ("return_{}_weight", *[f"{k}_{{}}_exposure_seconds" for k in list(FAMILIES)[1:]]):
            u, q = f"{p.format('usable')}_hl{h}s", f"{p.format('possible')}_hl{h}s"
            out[f"{u} within possible"] = f"{u} >= 0 AND {u} <= {q} * (1 + 1e-12)"
    out |= {f"{s}: startup clock": f"{s}_ew_startup_elapsed_seconds BETWEEN 0 AND 57600" for s in ("quote", "trade")}
    for a in AGES:
        for w in WINDOWS:
            n, slots = f"{a}_age_sample_count_window{w}s", f"{a}_age_elapsed_slots_window{w}s"
            out[f"{a}, window {w}: counts"] = f"{n} >= 0 AND {n} <= {slots} AND {slots} <= {w}"
    return out


def projected_rules() -> dict[str, str]:
    rate, part = "trade_rate_per_second_hl4s", "movement_participation_hl16s"
    out = _value(rate, f"{rate}_reason_mask", M.HISTORY) | _value(part, f"{part}_reason_mask", M.HISTORY | 1024)
    out |= _value("trade_age_seconds", "trade_age_reason_mask", _BASE | 128)
    return out | _value("midpoint_change_age_seconds", "midpoint_change_age_reason_mask", _BASE | 128 | 256)


FEATURED = EW + AGE + f""",
ft AS (
  SELECT rp.*, v4.* EXCLUDE (symbol, second), v16.* EXCLUDE (symbol, second), ag.* EXCLUDE (symbol, second), elapsed AS quote_ew_startup_elapsed_seconds, elapsed AS trade_ew_startup_elapsed_seconds
  FROM rp JOIN v4 USING (symbol, second) JOIN v16 USING (symbol, second) JOIN (SELECT * FROM {_AGE_JOIN}) ag USING (symbol, second) JOIN (SELECT symbol, second, elapsed FROM f2) USING (symbol, second)
)"""


def _counted(ctes: str, source: str, changes: dict[str, tuple[int, str]], rules: dict[str, str]) -> str:
    spoiled = ", ".join(f"CASE WHEN second % {n} = 0 THEN {x} ELSE {c} END AS {c}" for c, (n, x) in changes.items())
    names = list(rules)
    counts = ", ".join(f"count(*) FILTER (WHERE NOT coalesce({rules[n]}, false)) AS r{i}" for i, n in enumerate(names))
    rows = " UNION ALL ".join("SELECT '{}' AS rule, r{} AS rows FROM counted".format(n.replace("'", "''"), i) for i, n in enumerate(names))
    return f"WITH {ctes}, spoiled AS (SELECT * REPLACE ({spoiled}) FROM {source}), counted AS MATERIALIZED (SELECT {counts} FROM spoiled) {rows}"


# --- selection and runs ---------------------------------------------------------------

RANGES = ", rg AS (SELECT symbol, greatest(51, length(symbol) * 20 + 1) AS first_second, 849 AS last_second FROM (SELECT DISTINCT symbol FROM ev))"
RUNS = REPLAY + RANGES + """,
u0 AS (
  SELECT rp.*, CASE WHEN price_end_reason_mask <> 0 THEN 'unavailable' WHEN bid_end_usd >= 101 THEN 'matching' ELSE 'nonmatching' END AS status, CASE WHEN second % 211 = 0 THEN 'explicit_before' END AS bef,
         CASE WHEN second % 223 = 0 THEN 'explicit_after' END AS aft
  FROM rp JOIN rg USING (symbol) WHERE second BETWEEN first_second AND last_second
)
"""
RUN_TAIL = """,
u1 AS (
  SELECT *, NOT halt_active AND status = 'matching' AS m, CASE WHEN halt_active THEN 'halt' WHEN status <> 'matching' THEN status END AS own,
    lag(second) OVER p IS NOT NULL AND (quote_continuity_break_in_second OR trade_continuity_break_in_second OR lag(quote_continuity_id) OVER p <> quote_continuity_id OR lag(trade_continuity_id) OVER p <> trade_continuity_id) AS cut,
    lag(second) OVER p IS NULL AS first, lead(second) OVER p IS NULL AS last, lag(aft) OVER p AS after_prev
  FROM u0 WINDOW p AS (PARTITION BY symbol ORDER BY second)
),
u2 AS (
  SELECT *, lag(own) OVER p AS own_prev, lag(m) OVER p AS m_prev, lead(own) OVER p AS own_next, lead(cut) OVER p AS cut_next, lead(bef) OVER p AS bef_next FROM u1 WINDOW p AS (PARTITION BY symbol ORDER BY second)
),
u3 AS (
  SELECT *, m AND (first OR cut OR bef IS NOT NULL OR NOT coalesce(m_prev, false) OR after_prev IS NOT NULL) AS begins,
    coalesce(bef, CASE WHEN cut THEN 'source_continuity' END, CASE WHEN first THEN 'member_boundary' END, after_prev, own_prev) AS pre,
    coalesce(aft, CASE WHEN cut_next THEN 'source_continuity' END, bef_next, own_next, CASE WHEN last THEN 'end' END) AS post
  FROM u2
),
u4 AS (SELECT *, sum(begins::INT) OVER (PARTITION BY symbol ORDER BY second) AS run FROM u3 WHERE m),
u5 AS (SELECT symbol, run, min(second) AS first_second, max(second) AS last_second, count(*) AS match_count, first(pre ORDER BY second) AS pre, last(post ORDER BY second) AS post FROM u4 GROUP BY 1, 2),
u6 AS (SELECT * EXCLUDE (post), CASE WHEN post = 'end' THEN CASE WHEN symbol = (SELECT max(symbol) FROM u0) THEN 'selection_boundary' ELSE 'member_boundary' END ELSE post END AS post FROM u5)
"""
BEST = REPLAY + """,
b0 AS (SELECT symbol, second, CASE WHEN second <= 450 THEN 'early' ELSE 'late' END AS session, price_end_reason_mask = 0 AS e, coalesce(ask_end_usd - bid_end_usd >= 0.25, false) AS m FROM rp),
b1 AS (SELECT *, count(*) OVER w AS n, sum(e::INT) OVER w AS ne, sum(m::INT) OVER w AS nm FROM b0 WINDOW w AS (PARTITION BY symbol, session ORDER BY second ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
b2 AS (SELECT * FROM b1 WHERE n = 30 AND ne = 30 AND nm >= 9 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY nm DESC, second, session) = 1)
"""

# Contexts as lists of [start, end), with the faults that the query plants, and every rule on them.
_APART = "len(list_filter(range(2, len(halts) + 1), lambda i: halts[i][1] // 1000000000 <= (halts[i - 1][2] - 1) // 1000000000 + 1)) = 0"
_PROPER = "len(list_filter(range(1, len(gaps) + 1), lambda i: gaps[i][1] < 0 OR gaps[i][1] >= gaps[i][2] OR gaps[i][2] > stop OR (i > 1 AND gaps[greatest(i - 1, 1)][2] > gaps[i][1]))) = 0"
ADMISSION = f"""
WITH c AS (
  SELECT symbol, 900 * {S}::BIGINT AS seen, 900 * {S}::BIGINT + CASE WHEN symbol = 'VIEW' THEN 5 ELSE 0 END AS stop,
         CASE WHEN symbol = 'CLICK' THEN [[{_QGAP[0]}, {_QGAP[1]}], [1, 2]] ELSE [[{_QGAP[0]}, {_QGAP[1]}]] END AS gaps, CASE WHEN symbol = 'ERROR' THEN [-1] ELSE [{_TBREAKS[0]}] END AS breaks,
         CASE WHEN symbol = 'SIGNUP' THEN [[700200000000, 703250000000]] ELSE [[700200000000, 703250000000], [703260000000, 704000000000]] END AS halts
  FROM (SELECT DISTINCT upper(event_type) AS symbol FROM events)
),
twice AS (SELECT * FROM c UNION ALL SELECT * FROM c WHERE symbol = 'PURCHASE'),
ruled AS (
  SELECT symbol, list_sort(list_filter([
    CASE WHEN NOT (stop > 0 AND stop <= 57600 * {S}::BIGINT AND stop % {S} = 0) THEN 'coverage on the grid' END, CASE WHEN seen <> stop THEN 'quote intervals cover' END, CASE WHEN seen <> stop THEN 'trade intervals cover' END,
    CASE WHEN NOT {_PROPER} THEN 'quote gaps' END, CASE WHEN len(list_filter(breaks, lambda x: x < 0 OR x >= stop)) > 0 THEN 'trade breaks' END, CASE WHEN NOT {_APART} THEN 'halt closures apart' END,
    CASE WHEN count(*) OVER (PARTITION BY symbol) > 1 THEN 'repeated member' END], lambda x: x IS NOT NULL)) AS reasons
  FROM twice
)
SELECT symbol, CASE WHEN len(reasons) = 0 THEN 'admitted' ELSE 'blocked' END AS state, array_to_string(reasons, ',') AS reasons FROM ruled
"""


def oracle_sql() -> dict[str, str]:
    w = f"WITH {REPLAY} "
    spoiled_base = {"bid_end_usd": (97, "-1.0"), "activity_valid_duration_ns": (89, str(S + 1)), "quote_age_seconds": (83, "'nan'::DOUBLE"), "trade_source_status": (79, "2"), "halt_id": (73, "'h'")}
    spoiled_features = {"movement_participation_hl4s": (97, "1.5"), "midpoint_rms_5s_to_spread_hl16s": (89, "7.0"), "quoted_spread_bps_hl4s_reason_mask": (83, "8")}
    spoiled_support = {"spread_usable_exposure_seconds_hl4s": (97, "-1.0"), "quote_age_sample_count_window20s": (89, "21"), "trade_ew_startup_elapsed_seconds": (83, "60000")}
    values = ", ".join([f"round({n}, 6) AS {n}" for n in VALUES] + [f"CAST({n}_reason_mask AS BIGINT) AS {n}_reason_mask" for n in VALUES])
    support = ", ".join(f"round({n}, 6) AS {n}" for n in SUPPORT)
    elapsed = "(SELECT symbol, second, CAST(elapsed AS BIGINT) AS quote_ew_startup_elapsed_seconds, CAST(elapsed AS BIGINT) AS trade_ew_startup_elapsed_seconds FROM f2)"
    return {
        "replay_quotes": w + _show(*_QUOTE_COLS, places=10).replace(" FROM rp", ", round(spread_integral_bps_seconds, 6) AS spread_integral_bps_seconds FROM rp"),
        "replay_trades": w + "SELECT symbol, second, CAST(trade_count_1s AS BIGINT) AS trade_count_1s, CAST(CAST(share_volume_1s AS DECIMAL(38, 9)) AS VARCHAR) AS shares, round(dollar_volume_1s_usd, 9) AS dollar_volume_1s_usd, CAST(activity_valid_duration_ns AS BIGINT) AS activity_valid_duration_ns, CAST(activity_reason_mask AS BIGINT) AS activity_reason_mask FROM rp",
        "replay_ages": w + _show("trade_age_seconds", "trade_age_reason_mask", "quote_age_seconds", "quote_age_reason_mask", "midpoint_change_age_seconds", "midpoint_change_age_reason_mask", "midpoint_age_status", "origin_ns", "midpoint_age_lower_bound_seconds"),
        "replay_continuity": w + _show(
            "quote_source_status", "trade_source_status", "quote_observed_duration_ns", "trade_observed_duration_ns", "quote_continuity_id", "trade_continuity_id", "quote_continuity_break_in_second", "trade_continuity_break_in_second",
            "halt_active", "halt_id", "quote_interior_break", "trade_interior_break",
        ),
        "quote_classes": f"WITH {EVENTS} SELECT symbol, seq AS sequence_number, valid, spread_ok, bid_ok, ask_ok FROM qc",
        "trade_classes": f"WITH {EVENTS} SELECT symbol, seq AS sequence_number, kind, CASE WHEN kind = 'eligible' THEN CAST(CAST(shares AS DECIMAL(38, 9)) AS VARCHAR) END AS shares FROM tc",
        "member_admission": ADMISSION,
        "ew_values": f"WITH {EW} SELECT symbol, second, {values} FROM v4 JOIN v16 USING (symbol, second)",
        "ew_support": f"WITH {EW} SELECT symbol, second, {support}, quote_ew_startup_elapsed_seconds, trade_ew_startup_elapsed_seconds FROM v4 JOIN v16 USING (symbol, second) JOIN {elapsed} USING (symbol, second)",
        "age_quantiles": f"WITH {REPLAY}{AGE} {_ages_shown()}",
        "base_validation": _counted(REPLAY, "rp", spoiled_base, base_rules()),
        "feature_validation": _counted(FEATURED, "ft", spoiled_features, feature_rules()),
        "support_validation": _counted(FEATURED, "ft", spoiled_support, support_rules()),
        "projected_validation": _counted(FEATURED, "ft", {"trade_rate_per_second_hl4s": (97, "-1.0"), "trade_age_seconds": (89, "NULL")}, projected_rules()),
        "selection_ranges": f"WITH {EVENTS}{RANGES} SELECT symbol, 0 AS segment_index, 'premarket' AS session, CAST(first_second AS BIGINT) AS first_second, CAST(last_second AS BIGINT) AS last_second FROM rg",
        "selection_annotated": w + f"""{RANGES.replace(', rg', ', rg', 1)} SELECT symbol, second, true AS selected, '2026-09-02/' || symbol || ':0' AS selection_segment_id, second = first_second AS selection_segment_start, second = last_second AS selection_segment_end
          FROM rp JOIN rg USING (symbol) WHERE second BETWEEN first_second AND last_second""",
        "strict_runs_sources": f"""WITH {RUNS}{RUN_TAIL} SELECT symbol, CAST(first_second AS BIGINT) AS first_second, CAST(last_second AS BIGINT) AS last_second, match_count, row_number() OVER (ORDER BY symbol, first_second) - 1 AS run_ordinal, pre AS preceding_reason,
          post AS closure_reason, pre = 'selection_boundary' AS left_censored, post = 'selection_boundary' AS right_censored FROM u6""",
        "best_quoted_window": f"""WITH {BEST} SELECT symbol, session, CAST(second - 30 AS BIGINT) AS window_start, CAST(second AS BIGINT) AS window_end, CAST(n AS BIGINT) AS represented_steps, CAST(ne AS BIGINT) AS eligible_steps, CAST(nm AS BIGINT) AS matching_steps,
          round(nm / n, 6) AS occupancy FROM b2""",
    }
