"""Replay and features against literal values and sequential oracles."""

import random

import pytest

import sequential as S
from tidegrid.config import NS, FeatureConfig, View
from tidegrid.grid import Grid, session_bounds
from tidegrid.operators import features as X
from tidegrid.operators import replay as R

START = session_bounds("2026-09-02")[0]
Q = "session_date string, symbol string, sip_timestamp bigint, sequence_number bigint, bid_price double, ask_price double, bid_size double, ask_size double, conditions array<bigint>, indicators array<bigint>"
T = "session_date string, symbol string, sip_timestamp bigint, sequence_number bigint, participant_timestamp bigint, price double, decimal_size string, size double, conditions array<bigint>, correction bigint"
C = "session_date string, symbol string, " + ", ".join(f"{k} {v}" for k, v in R.CONTEXT.items())
KEY = ("2026-09-02", "AAA")


def context(spark, seconds, ctx, key=KEY):
    full = [(START, START + seconds * NS)]
    row = (*key, START, START + seconds * NS, ctx.get("lot", 1.0), False, ctx.get("qo", full), ctx.get("qg", []), ctx.get("to", full), ctx.get("tg", []), ctx.get("qb", []), ctx.get("tb", []), ctx.get("halts", []))
    return spark.createDataFrame([row], C)


def test_literal_first_second(spark):
    q = spark.createDataFrame([(*KEY, START, 1, 99.0, 101.0, 10.0, 20.0, [], []), (*KEY, START + NS // 4, 2, 100.0, 102.0, 30.0, 40.0, [], [])], Q)
    t = spark.createDataFrame(
        [(*KEY, START + NS // 10, 1, START + NS // 10, 100.0, "0.1", 0.1, [], 0), (*KEY, START + NS // 5, 2, START + NS // 5, 102.0, "0.2", 0.2, [], None)], T
    )
    one = R.replay(q, t, context(spark, 3, {})).orderBy("interval_end_ns").first()
    assert one.bid_twap_usd == pytest.approx(99.75) and one.ask_twap_usd == pytest.approx(101.75) and one.midpoint_twap_usd == pytest.approx(100.75)
    assert one.spread_integral_bps_seconds == pytest.approx(0.25 * 200 + 0.75 * 20000 / 101)
    assert one.bid_size_integral_shares_seconds == pytest.approx(25) and one.ask_size_integral_shares_seconds == pytest.approx(35)
    assert one.trade_count_1s == 2 and str(one.share_volume_1s) == "0.300000000" and one.dollar_volume_1s_usd == pytest.approx(30.4)


def random_case(seed, seconds=60):
    rng = random.Random(seed)
    at = sorted(rng.sample(range(seconds * 1000), 160))
    quotes = []
    for k, ms in enumerate(at):
        bid = 100 + rng.randint(-3, 3) * 0.5
        ask = bid + rng.choice([0.0, 0.5, 1.0, -1.0]) if rng.random() < 0.9 else None
        quotes.append((START + ms * 1_000_000, k, bid, ask, rng.choice([0.0, 10.0, 20.0]), rng.choice([5.0, None, 20.0]), rng.choice([[], [1], [85], [2]]) if rng.random() < 0.4 else [], []))
    trades = []
    for k, ms in enumerate(sorted(rng.sample(range(seconds * 1000), 90))):
        kind = rng.choice(["eligible"] * 6 + ["excluded", "uncertain"])
        trades.append((START + ms * 1_000_000, k, kind, 100.0 + rng.randint(0, 9), float(rng.randint(1, 5))))
    ctx = {
        "qg": [(START + 20 * NS + 300_000_000, START + 22 * NS + 700_000_000)], "tg": [(START + 31 * NS, START + 33 * NS + 1)], "qb": [START + 5 * NS, START + 9 * NS + 123],
        "tb": [START + 7 * NS + 77], "halts": [(START + 40 * NS + 200_000_000, START + 43 * NS + 250_000_000, "h1"), (START + 43 * NS + 260_000_000, START + 44 * NS, "h2")], "lot": 100.0,
    }
    return quotes, trades, ctx


@pytest.fixture(scope="module")
def replayed(spark):
    quotes, trades, ctx = random_case(3)
    q = spark.createDataFrame([(*KEY, *x) for x in quotes], Q)
    code = {"eligible": ([], 0), "excluded": ([], 1), "uncertain": ([31], 0)}
    t = spark.createDataFrame([(*KEY, ts, seq, ts, price, f"{shares:g}", None, *code[kind]) for ts, seq, kind, price, shares in trades], T)
    rows = [r.asDict() for r in R.replay(q, t, context(spark, 60, ctx)).orderBy("interval_end_ns").collect()]
    want = S.replay(quotes, trades, {"start": START, "end": START + 60 * NS, "qo": [(START, START + 60 * NS)], "to": [(START, START + 60 * NS)], **ctx})
    return rows, want


def test_replay_against_sequential(replayed):
    rows, want = replayed
    assert len(rows) == len(want) == 60
    names = {
        "bid_twap": "bid_twap_usd", "spread": "spread_integral_bps_seconds", "bid_size": "bid_size_integral_shares_seconds", "ask_size": "ask_size_integral_shares_seconds", "bid_end": "bid_end_usd",
        "dollars": "dollar_volume_1s_usd", "trade_age": "trade_age_seconds", "quote_age": "quote_age_seconds", "mid_age": "midpoint_change_age_seconds",
    }
    exact = {"pn": "price_valid_duration_ns", "sn": "spread_valid_duration_ns", "n": "trade_count_1s", "active": "activity_valid_duration_ns", "qc": "quote_continuity_id", "tc": "trade_continuity_id", "halt": "halt_active", "origin": "midpoint_observation_start_ns"}
    for got, w in zip(rows, want, strict=True):
        for k, name in names.items():
            assert (got[name] is None) == (w[k] is None), (k, w["end"])
            if w[k] is not None:
                assert got[name] == pytest.approx(w[k], rel=1e-12), (k, w["end"])
        for k, name in exact.items():
            assert got[name] == w[k], (k, (w["end"] - START) // NS)
        assert (got["bid_twap_usd"] is None) == (got["price_twap_reason_mask"] != 0)
        assert (got["trade_age_seconds"] is None) == (got["trade_age_reason_mask"] != 0) or got["trade_source_status"] != 1


def test_features_against_sequential(spark, replayed):
    rng = random.Random(9)
    rows = []
    mid = 100.0
    for i in range(2600):
        halt = 700 <= i < 712
        mid = max(1.0, mid + rng.choice([0, 0, 0, 0.25, -0.25]) * (i < 900 or i > 1700))
        ok = rng.random() < 0.97 and not halt
        obs = NS if rng.random() < 0.95 else NS // 2
        rows.append({
            "session_date": "d", "symbol": "s", "interval_end_ns": (i + 1) * NS, "halt_active": halt, "quote_source_status": 1 if rng.random() < 0.98 else 2, "trade_source_status": 1,
            "bid_end_usd": mid - 0.5 if ok else None, "ask_end_usd": mid + 0.5 if ok else None, "price_end_reason_mask": 0 if ok else 64, "quote_continuity_id": i // 400,
            "trade_continuity_id": 0, "spread_integral_bps_seconds": 50.0 + rng.random() if ok else None, "spread_valid_duration_ns": NS if ok else 0,
            "trade_count_1s": None if halt else rng.choice([0, 0, 1, 5]), "share_volume_1s": None if halt else 1.0, "dollar_volume_1s_usd": None if halt else 3.0,
            "activity_valid_duration_ns": 0 if halt else obs, "bid_size_integral_shares_seconds": 10.0 if ok else None, "bid_size_valid_duration_ns": NS if ok else 0,
            "ask_size_integral_shares_seconds": 20.0 if ok else None, "ask_size_valid_duration_ns": NS if ok else 0,
            "quote_continuity_break_in_second": i % 400 == 0 and i > 0, "trade_continuity_break_in_second": False, "quote_observed_duration_ns": obs, "trade_observed_duration_ns": obs,
            "quote_interior_break": i % 800 == 0, "trade_interior_break": False,
            **{f"{a}_age_seconds": rng.random() * 5 for a in X.AGES}, **{f"{a}_age_reason_mask": 0 for a in X.AGES},
        })
    for r in rows:
        for a in X.AGES:
            if rng.random() < 0.05:
                r[f"{a}_age_seconds"], r[f"{a}_age_reason_mask"] = None, 128
    types = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    schema = ", ".join(f"{k} {types[type(next(r[k] for r in rows if r[k] is not None))]}" for k in rows[0])
    config = FeatureConfig(views=(View(2, 6), View(30, 60)), age_windows=(20, 60))
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = X.features(df, Grid(), config).orderBy("interval_end_ns").collect()
    stems = {"rms": "midpoint_rms_5s_bps", "participation": "movement_participation", "spread": "quoted_spread_bps", "rate": "trade_rate_per_second"}
    for v in config.views:
        for g, w in zip(got, S.ew(rows, v.half_life, v.startup), strict=True):
            for k, stem in stems.items():
                name = f"{stem}_hl{v.half_life}s"
                assert g[name + "_reason_mask"] == w[k][1], (name, g.interval_end_ns // NS)
                assert (g[name] is None) == (w[k][0] is None)
                if w[k][0] is not None and w[k][0] > 1e-140:
                    assert g[name] == pytest.approx(w[k][0], rel=1e-9, abs=1e-12), (name, g.interval_end_ns // NS)
    for a in X.AGES:
        for h in config.age_windows:
            for g, w in zip(got, S.age_p90(rows, a, h), strict=True):
                name = f"{a}_age_p90_seconds_window{h}s"
                assert (g[name + "_reason_mask"], g[f"{a}_age_sample_count_window{h}s"], g[f"{a}_age_elapsed_slots_window{h}s"]) == w[1:], (name, g.interval_end_ns // NS)
                assert g[name] == pytest.approx(w[0]) if w[0] is not None else g[name] is None
