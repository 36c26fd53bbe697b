"""Predicates, runs, periods, intervals, screen, bins, sampling and accounting against literals and plain versions."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import sequential as S
from tidegrid.config import NS, ContractError, FeatureConfig, View
from tidegrid.functions import bins as B
from tidegrid.functions.numbers import exact_shares
from tidegrid.grid import Grid, session_bounds, session_name, session_start
from tidegrid.operators import accounting as A
from tidegrid.operators import distributions as D
from tidegrid.operators import intervals as I
from tidegrid.operators import periods as P
from tidegrid.operators import sampling as Sa
from tidegrid.operators import screen as Sc
from tidegrid.operators.predicates import Field, Interval, compile_predicates
from tidegrid.operators.runs import stretches, strict_runs
from tidegrid.operators.selection import Selection, annotate

FIELDS = [Field("a", "a_mask", ("quote",)), Field("b", "b_mask", ("trade",))]


def test_predicates_intersect_and_contradict():
    p = compile_predicates([{"field": "b", "operator": ">", "value": -0.0}, {"field": "a", "operator": ">=", "value": 1}, {"field": "a", "operator": ">", "value": 1}, {"field": "a", "operator": "<=", "value": 9}], FIELDS)
    assert p.fields == ["a", "b"] and p.sources == ["quote", "trade"]
    assert p.terms[0][1] == Interval(1.0, False, 9.0, True) and str(p.terms[1][1].lower) == "0.0"
    assert p.identity == compile_predicates([{"field": "a", "range": {"lower": 1, "lower_inclusive": False, "upper": 9, "upper_inclusive": True}}, {"field": "b", "operator": ">", "value": 0}], FIELDS).identity
    for bad in (
        [], [{"field": "x", "operator": ">", "value": 1}], [{"field": "a", "operator": ">", "value": True}], [{"field": "a", "operator": "!=", "value": 1}], [{"field": "a", "operator": ">", "value": float("nan")}],
        [{"field": "a", "operator": ">", "value": 5}, {"field": "a", "operator": "<", "value": 3}], [{"field": "a", "operator": "==", "value": 5}, {"field": "a", "operator": "<", "value": 5}],
        [{"field": "a", "range": {"lower": None, "lower_inclusive": True, "upper": None, "upper_inclusive": True}}], [{"field": "a", "operator": ">", "value": 1, "range": {}}],
    ):
        with pytest.raises(ValueError):
            compile_predicates(bad, FIELDS)


def test_three_states(spark):
    p = compile_predicates([{"field": "a", "operator": ">", "value": 0}, {"field": "b", "operator": "<=", "value": 2}], FIELDS)
    rows = [(1.0, 0, 2.0, 0), (0.0, 0, 9.0, 0), (None, 4, 1.0, 0), (1.0, 8, 1.0, 0), (-1.0, 0, None, 1)]
    got = p.evaluate(spark.createDataFrame(rows, "a double, a_mask int, b double, b_mask int")).collect()
    assert [r.status for r in got] == ["matching", "nonmatching", "unavailable", "unavailable", "unavailable"]
    assert [r.failing_fields for r in got] == [[], ["a", "b"], [], [], ["a"]] and [r.unavailable_fields for r in got] == [[], [], ["a"], ["a"], ["b"]]


@pytest.mark.parametrize("explicit", [0.0, 0.04])
def test_strict_runs_against_sequential(spark, explicit):
    rng = random.Random(2)
    rows = []
    for d, s in (("2026-01-02", "A"), ("2026-01-02", "B"), ("2026-01-05", "A")):
        cont = 0
        for i in range(700):
            brk = rng.random() < 0.03
            cont += rng.random() < 0.02
            rows.append({
                "session_date": d, "symbol": s, "interval_end_ns": (i + 1) * NS, "selection_segment_id": f"{d}/{s}:{i // 300}", "status": rng.choices(["matching", "nonmatching", "unavailable"], [8, 2, 1])[0],
                "halt_active": rng.random() < 0.02, "quote_continuity_id": cont, "quote_continuity_break_in_second": brk,
                "before": "given_before" if rng.random() < explicit else None, "after": "given_after" if rng.random() < explicit else None,
            })
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "session_date string, symbol string, interval_end_ns long, selection_segment_id string, status string, halt_active boolean, quote_continuity_id long, quote_continuity_break_in_second boolean, before string, after string")
    got = strict_runs(df.repartition(5), Grid(), "q", sources=["quote"], before="before", after="after").orderBy("run_ordinal").collect()
    want = S.strict_runs(rows, "q", ["quote"])
    assert [((r.session_date, r.symbol), r.first_endpoint, r.last_endpoint, r.match_count, r.preceding_reason, r.closure_reason, r.run_ordinal) for r in got] == [
        (w["member"], w["first"], w["last"], w["count"], w["preceding"], w["closure"], w["ordinal"]) for w in want
    ]
    assert all(r.right_censored == (r.closure_reason == "selection_boundary") and r.represented_start == r.first_endpoint - NS for r in got)


def seconds(spark, flags, eligible=None):
    rows = [("d", "s", "rth", (i + 1) * NS, True if eligible is None else eligible[i], f) for i, f in enumerate(flags)]
    return spark.createDataFrame(rows, "session_date string, symbol string, session string, interval_end_ns long, eligible boolean, matching boolean")


def test_periods_bridge_29_misses_and_split_at_30(spark):
    bridge = [True] * 10 + [False] * 29 + [True] * 10
    split = [True] * 10 + [False] * 30 + [True] * 10
    one = P.gap_periods(seconds(spark, bridge), Grid(), least_elapsed=1, occupancy=0.1).collect()
    assert len(one) == 1 and (one[0].elapsed_steps, one[0].matching_steps, one[0].longest_gap_steps, one[0].episode_start) == (49, 20, 29, 0)
    assert len(P.gap_periods(seconds(spark, split), Grid(), least_elapsed=1, occupancy=0.1).collect()) == 2
    broken = [i != 12 for i in range(49)]
    assert len(P.gap_periods(seconds(spark, [f and e for f, e in zip(bridge, broken)], broken), Grid(), least_elapsed=1, occupancy=0.1).collect()) == 2
    assert P.gap_periods(seconds(spark, [True] * 8 + [False, True]), Grid(), least_elapsed=10, occupancy=0.9).count() == 1
    assert P.gap_periods(seconds(spark, [True] * 8 + [False, True]), Grid(), least_elapsed=10, occupancy=0.91).count() == 0


def test_variants_equal_single_plans(spark):
    rng = random.Random(90210)
    df = seconds(spark, [rng.random() < 0.6 for _ in range(900)], [rng.random() < 0.97 for _ in range(900)]).withColumn("matching", F.col("matching") & F.col("eligible")).withColumn("other", F.col("matching") & (F.pmod("interval_end_ns", F.lit(3 * NS)) != 0))
    options = {"off_delay": 4, "least_elapsed": 5, "occupancy": 0.5}
    both = P.period_variants(df, Grid(), {"a": (F.col("eligible"), F.col("matching")), "b": (F.col("eligible"), F.col("other"))}, **options)
    for name, match in (("a", "matching"), ("b", "other")):
        alone = P.gap_periods(df, Grid(), matching=match, **options)
        assert P.differences(both.where(F.col("variant") == name).select(*alone.columns), alone).count() == 0


def test_best_window_takes_the_earliest_of_equals(spark):
    flags = [i in (3, 4, 5, 12, 13, 14) for i in range(20)]
    got = P.best_window(seconds(spark, flags), Grid(), steps=4, occupancy=0.7).collect()
    assert len(got) == 1 and got[0].window_end == 6 * NS and got[0].matching_steps == 3


def test_stretches_split_at_gaps(spark):
    df = seconds(spark, [True] * 10).where(f"interval_end_ns <> {5 * NS}")
    assert sorted(r.steps for r in stretches(df, Grid(), F.col("matching")).collect()) == [4, 5]


def test_intervals(spark):
    rng = random.Random(5)
    make = lambda: [("m", a, a + rng.randrange(1, 40)) for a in (rng.randrange(500) for _ in range(30))]
    a, b = make(), make()
    cover = lambda rows: {x for _, s, e in rows for x in range(s, e)}
    df = lambda rows: spark.createDataFrame(rows, "m string, start long, stop long")
    one = I.overlap_lengths(df(a), df(b), spark.createDataFrame([("m",), ("none",)], "m string"), ["m"], step=1, width=17).collect()
    got = {r.m: r for r in one}
    assert (got["m"].fast_steps, got["m"].slow_steps, got["m"].shared_steps, got["m"].union_steps) == (len(cover(a)), len(cover(b)), len(cover(a) & cover(b)), len(cover(a) | cover(b)))
    assert got["none"].union_steps == 0
    inside = I.inside_intervals(spark.range(600).selectExpr("'m' AS m", "id AS t"), df(a), ["m"], "t", "start", "stop").count()
    assert inside == len({x for _, s, e in a for x in range(s + 1, e + 1)} & set(range(600)))


def test_as_of_is_strict(spark):
    points = spark.createDataFrame([("m", 10), ("m", 11), ("n", 5)], "m string, t long")
    events = spark.createDataFrame([("m", 10, 1.0, 1), ("m", 10, 2.0, 2), ("m", 3, 0.5, 0)], "m string, t long, v double, seq long")
    assert {(r.m, r.t): r.v for r in I.as_of(points, events, ["m"], "t", ["v"], tie="seq").collect()} == {("m", 10): 0.5, ("m", 11): 2.0, ("n", 5): None}
    assert {(r.m, r.t): r.v for r in I.as_of(points, events, ["m"], "t", ["v"], strict=False, tie="seq").collect()}[("m", 10)] == 2.0


def bars(spark, rows):
    return spark.createDataFrame([("X", m * 60 * NS, float(tr), 1e3, o, c, h, lo, 0, 10**15) for m, tr, o, c, h, lo in rows], "symbol string, window_start long, transactions double, volume double, open double, close double, high double, low double, session_start long, session_end long")


def test_screen_pairs(spark):
    ref = spark.createDataFrame([("X", "CS"), ("Y", "ETF")], "symbol string, kind string")
    good = [(0, 900, 10.0, 10.5, 10.5, 10.0), (1, 900, 10.5, 11.0, 11.0, 10.4)]
    hit = Sc.first_hits(Sc.screened_bars(bars(spark, good), ref)).collect()
    assert len(hit) == 1 and hit[0].discovery_endpoint == 2 * 60 * NS and hit[0].pair_transactions == 1800
    apart = [good[0], (2, *good[1][1:])]
    bad = [good[0], (1, 900, 10.5, 11.0, 10.0, 10.4), (2, 900, 10.5, 11.0, 11.0, 10.4)]  # its high is below its close
    thin = [good[0], (1, 99, *good[1][2:])]
    for rows in (apart, bad, thin):
        assert Sc.first_hits(Sc.screened_bars(bars(spark, rows), ref)).count() == 0
    counts = Sc.denominators(bars(spark, bad), ref).first()
    assert (counts.input_rows, counts.valid_session_rows, counts.invalid_ohlc_rows, counts.candidates) == (3, 3, 1, 0)


def test_exact_shares(spark):
    texts = ["1.5", "0.1000000000", "1.0000000001", "00012", "1e3", "12345678901234567890123456789.5", "123456789012345678901234567890", ".5", "+2.", "abc", "", None, "-1"]
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(exact_shares(F.col("t"), exponents=True).alias("x")).collect()]
    want = ["1.5", "0.1", None, "12", "1000", "12345678901234567890123456789.5", None, "0.5", "2", None, None, None, "-1"]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_bins(spark):
    axis, fixed = B.Axis.spaced(0.01, 1000, log=True), B.FixedAxis((1.0, 2.0, 4.0))
    values = [None, 0.0, 0.005, 0.01, axis.edges[7], 1000.0, 1001.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(axis.status(F.col("x")).alias("s"), axis.bin(F.col("x")).alias("b")).collect()
    assert [(r.s, r.b) for r in got] == [(None, None), ("zero", None), ("positive_underflow", None), ("finite", 0), ("finite", 7), ("finite", 49), ("overflow", None)]
    df = spark.createDataFrame([(v,) for v in (None, 0.0, 0.5, 1.0, 2.0, 3.9, 4.0, 4.1)], "x double")
    assert [r.b for r in df.select(fixed.bin(F.col("x")).alias("b")).collect()] == [None, 0, 1, 2, 3, 3, 3, 4]
    bands = spark.createDataFrame([(v,) for v in (None, 0.0, 0.5, 1.0, 10.0, 30.0, 99.9, 100.0)], "x double").select(B.bands(F.col("x")).alias("b"))
    assert [r.b for r in bands.collect()] == [-1, 0, 1, 2, 3, 4, 4, 5]


def test_marginal_weights(spark):
    """Members of unequal size: three of five rows pooled, but 3/8 of the equal-member mass... and its complement."""
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", 2.0)], "m string, x double")
    got = {r.value: r for r in D.exact_marginal(df, ["m"], "x").collect()}
    assert got[1.0].pooled_share == pytest.approx(3 / 5) and got[1.0].equal_share == pytest.approx(3 / 8) and got[2.0].equal_share == pytest.approx(1)
    q = {r.q: r for r in D.marginal_quantiles(D.exact_marginal(df, ["m"], "x")).collect()}
    assert q[0.5].pooled == 1.0 and q[0.5].equal_member == 2.0


def test_running_total_is_exact(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.randrange(5)) for i in rng.sample(range(10_000), 700)], "k long, n long")
    total = 0
    for r in D.running_total(df, "k", ["n"], buckets=16).orderBy("k").collect():
        total += r.n
        assert r.cum_n == total


def test_collapse_keeps_both_sides_of_an_atom():
    assert D.collapse_quantiles([(0, 1), (0.1, 2), (0.2, 2), (0.3, 2), (0.4, 3)]) == [(0, 1), (0.1, 2), (0.3, 2), (0.4, 3)]


def test_sampling_prefers_unseen_symbols(spark):
    rng = random.Random(1)
    rows = [(f"2026-0{m}-{d:02d}", f"S{rng.randrange(9)}", f"2026-0{m}", rng.randrange(100)) for m in (1, 2) for d in range(1, 28)]
    df = spark.createDataFrame(rows, "session_date string, symbol string, month string, event_count long").dropDuplicates(["session_date", "symbol"])
    got = Sa.select_members(df, "seed")
    assert len(got) == 8 and [(g["month"], g["stratum"]) for g in got] == [(m, s) for m in ("2026-01", "2026-02") for s in range(4)]
    assert len({g["symbol"] for g in got}) == 8 - sum(g["symbol_repeat_fallback"] for g in got)
    assert got == Sa.select_members(df.repartition(7), "seed")


def test_accounting_reconciles(spark):
    rows = spark.createDataFrame([("a", s) for s in ["matching"] * 2 + ["nonmatching"] + ["unavailable"]] + [("b", "unavailable")], "m string, status string")
    acc = A.member_accounting(rows, ["m"], spark.createDataFrame([("a",), ("b",), ("c",)], "m string"))
    got = {r.m: r for r in acc.collect()}
    assert A.unreconciled(acc).count() == 0 and got["a"].match_fraction == pytest.approx(2 / 3) and got["c"].selected == 0
    assert [got[k].eligibility_class for k in "abc"] == ["positive_match", "no_eligible_rows", "no_eligible_rows"]
    assert {r.m: r.share for r in A.contributions(acc, ["m"]).collect()} == {"a": 1.0, "b": 0.0, "c": 0.0}


def test_selection_ranges(spark):
    start, _ = session_bounds("2026-03-09")
    members = [{"session_date": "2026-03-09", "symbol": "A", "discovery_ns": start + 20_000 * NS + 5}]
    got = Selection().ranges(members)
    assert [((r["first_ns"] - start) // NS, (r["last_ns"] - start) // NS) for r in got] == [(1, 19_800), (19_801, 43_200), (43_201, 57_600)]
    late = Selection(sessions=("premarket", "rth"), timing="nominal_post_discovery").ranges(members)
    assert [((r["first_ns"] - start) // NS, (r["last_ns"] - start) // NS) for r in late] == [(20_001, 43_200)]
    cut = Selection(bounds=(start + 5 * NS - 1, start + 9 * NS + 1)).ranges(members)
    assert [((r["first_ns"] - start) // NS, (r["last_ns"] - start) // NS) for r in cut] == [(5, 9)]
    rows = spark.createDataFrame([("2026-03-09", "A", start + k * NS) for k in range(1, 12)], "session_date string, symbol string, interval_end_ns long")
    assert annotate(rows, cut).count() == 5
    with pytest.raises(ContractError):
        Selection(members=(("2026-03-09", "Z"),)).scope(members)
    with pytest.raises(ContractError):
        Selection(dates=("2020-01-01", "2020-01-02")).scope(members)


def test_sessions_follow_daylight_saving(spark):
    for day in ("2026-03-06", "2026-03-09", "2026-10-30", "2026-11-02"):
        got = spark.createDataFrame([(day,)], "d string").select(session_start(F.col("d")).alias("s")).first().s
        assert got == session_bounds(day)[0]
    names = spark.createDataFrame([(34_200,), (34_201,), (57_600,), (57_601,)], "s int").select(session_name(F.col("s")).alias("n")).collect()
    assert [r.n for r in names] == ["premarket", "rth", "rth", "after_hours"]
    with pytest.raises(ContractError):
        session_bounds("2026-3-9")


def test_configuration():
    c = FeatureConfig(views=(View(10, 20),), age_windows=(5, 30))
    assert FeatureConfig.from_dict(c.to_dict()) == c and c.identity != FeatureConfig().identity
    for bad in ({"views": ()}, {"views": (View(9, 9), View(5, 9))}, {"age_windows": (400,)}, {"age_windows": (5, 5)}, {"spread_coverage": 0}, {"other_coverage": True}):
        with pytest.raises(ContractError):
            FeatureConfig(**bad)
    for bad in ((0, 60), (30, 5), (True, 60)):
        with pytest.raises(ContractError):
            View(*bad)


def test_admission(spark):
    from tidegrid.operators.admission import admit
    from tidegrid.operators.replay import CONTEXT

    day = "2026-06-01"
    start = session_bounds(day)[0]
    end = start + 600 * NS
    good = dict(session_start_ns=start, session_end_ns=end, lot_multiplier=100.0, seed_verified=False, quote_observed=[(start, end)], quote_gaps=[], trade_observed=[(start, start + NS), (start + NS, end)], trade_gaps=[(start + 5, start + 9)], quote_breaks=[start], trade_breaks=[], halts=[(start + NS, start + 2 * NS, "h1"), (start + 4 * NS, start + 5 * NS, "h2")])
    bad = {
        "session start": {"session_start_ns": start + 1}, "quote intervals cover": {"quote_observed": [(start, end - NS)]}, "trade gaps": {"trade_gaps": [(start + 5, start + 9), (start + 8, start + 12)]}, "quote breaks": {"quote_breaks": [end]},
        "halt closures apart": {"halts": [(start + NS, start + 2 * NS, "h1"), (start + 2 * NS + 5, start + 3 * NS, "h2")]}, "halt ids": {"halts": [(start, start + NS, "h"), (start + 9 * NS, start + 10 * NS, "h")]}, "coverage on the grid": {"session_end_ns": end + 1},
    }
    rows = [(day, "GOOD", *good.values()), (day, "bad symbol", *good.values()), (day, "TWICE", *good.values()), (day, "TWICE", *good.values())]
    rows += [(day, f"B{i}", *(good | change).values()) for i, change in enumerate(bad.values())]
    df = spark.createDataFrame(rows, "session_date string, symbol string, " + ", ".join(f"{k} {CONTEXT[k]}" for k in good))
    got = {r.symbol: r for r in admit(df).collect()}
    assert got["GOOD"].state == "admitted" and got["bad symbol"].reasons == ["symbol"] and got["TWICE"].reasons == ["repeated member"]
    for i, rule in enumerate(bad):
        assert rule in got[f"B{i}"].reasons, rule


def test_active_gate_edges(spark):
    from tidegrid.operators.population import active_gate

    df = spark.createDataFrame([(1.0, 2.0), (0.999, 2.0), (1.0, 2.001), (None, 1.0), (5.0, None)], "trade_rate_per_second_hl30s double, trade_age_p90_seconds_window60s double")
    valid, passing = active_gate()
    assert [(r.v, bool(r.v and r.p)) for r in df.select(valid.alias("v"), passing.alias("p")).collect()] == [(True, True), (True, False), (True, False), (False, False), (False, False)]


def test_time_buckets_change_nothing(spark):
    """As-of, unions, next rows and EXISTS give the same with and without buckets, and as plain loops do."""
    import random
    from collections import Counter

    from tidegrid.operators import intervals as I

    rng = random.Random(21)
    keys = ["a", "b", None]
    ev = [(rng.choice(keys), rng.randrange(-50, 1000), i) for i in range(300)]
    pts = list({(rng.choice(keys), rng.randrange(-60, 1100)) for _ in range(200)})
    iv = [(rng.choice(keys[:2]), s, s + rng.choice([0, 3, 40, 300])) for s in (rng.randrange(-50, 1000) for _ in range(60))]
    events, points = spark.createDataFrame(ev, "k string, t long, v long"), spark.createDataFrame(pts, "k string, t long")
    spans = spark.createDataFrame(iv, "k string, start long, stop long")
    seen = lambda df: Counter(map(tuple, df.collect()))
    for strict in (True, False):
        want = Counter()
        for k, t in pts:
            before = [(x, v) for kk, x, v in ev if kk == k and (x < t if strict else x <= t)]
            want[k, t, max(before)[1] if before else None] += 1
        for width in (None, 7, 5000):
            assert seen(I.as_of(points, events, ["k"], "t", ["v"], strict=strict, tie="v", width=width)) == want
    later = Counter()
    for k in keys:
        own = sorted((t, v) for kk, t, v in ev if kk == k)
        later.update((k, t, v, nxt) for (t, v), nxt in zip(own, [t for t, _ in own[1:]] + [None]))
    union = Counter()
    for k in keys[:2]:
        open_ = None
        for s, e in sorted((s, e) for kk, s, e in iv if kk == k):
            if open_ and s <= open_[1]:
                open_[1] = max(open_[1], e)
            else:
                if open_:
                    union[k, *open_] += 1
                open_ = [s, e]
        union[k, *open_] += 1
    inside = Counter((k, t) for k, t in pts if any(k == kk and s < t <= e for kk, s, e in iv))
    for width in (None, 7, 5000):
        assert seen(I.next_value(events, ["k"], "t", "v", width).select("k", "t", "v", "until")) == later
        assert seen(I.union_intervals(spans, ["k"], width=width).select("k", "start", "stop")) == union
        assert seen(I.inside_intervals(points, spans, ["k"], "t", "start", "stop", width=width)) == inside
