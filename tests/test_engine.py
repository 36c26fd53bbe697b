"""Raw events to base, features, catalog, SQL and typed queries; sources, sinks, validation and the command line."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidegrid import schema as Sch
from tidegrid.config import NS, ContractError, FeatureConfig, View
from tidegrid.engine import Engine
from tidegrid.grid import session_bounds
from tidegrid.operators import validation as V
from tidegrid.operators.replay import CONTEXT
from tidegrid.operators.selection import Selection
from tidegrid.plans import calculate as Cal
from tidegrid.plans import cli
from tidegrid.sources import catalog as Cat
from tidegrid.sources import sinks, vendor

CONFIG = FeatureConfig(views=(View(5, 10), View(20, 30)), age_windows=(10, 30))
DAYS = ("2026-06-01", "2026-06-02")
SECONDS = 240


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two days of one symbol, calculated and catalogued."""
    root = f"file://{tmp_path_factory.mktemp('root')}"
    rng = random.Random(4)
    quotes, trades, ctx = [], [], []
    for d in DAYS:
        start = session_bounds(d)[0]
        ctx.append((d, "ABC", start, start + SECONDS * NS, 100.0, False, [(start, start + SECONDS * NS)], [], [(start, start + SECONDS * NS)], [], [], [], [(start + 100 * NS, start + 104 * NS, "H")]))
        for k in range(SECONDS * 4):
            ts = start + k * NS // 4
            bid = 50 + rng.randint(0, 8) / 100
            quotes.append((d, "ABC", ts, k, bid, bid + 0.02, 3.0, 4.0, [], []))
            if rng.random() < 0.6:
                trades.append((d, "ABC", ts + 7, k, ts, bid, "2.5", 2.5, [], 0))
    q = spark.createDataFrame(quotes, "session_date string, symbol string, sip_timestamp bigint, sequence_number bigint, bid_price double, ask_price double, bid_size double, ask_size double, conditions array<bigint>, indicators array<bigint>")
    t = spark.createDataFrame(trades, "session_date string, symbol string, sip_timestamp bigint, sequence_number bigint, participant_timestamp bigint, price double, decimal_size string, size double, conditions array<bigint>, correction bigint")
    c = spark.createDataFrame(ctx, "session_date string, symbol string, " + ", ".join(f"{k} {v}" for k, v in CONTEXT.items()))
    plan = Cal.create_plan([(d, "ABC") for d in DAYS], CONFIG, root)
    assert Cal.calculate(spark, plan, q, t, c) == list(DAYS)
    assert Cal.calculate(spark, plan, q, t, c) == []  # nothing is done twice
    with pytest.raises(ContractError):
        Cal.calculate(spark, plan | {"root": "elsewhere"}, q, t, c)
    members = [{"session_date": d, "symbol": "ABC", "base": f"session_date={d}/base", "features": f"session_date={d}/features", "discovery_ns": session_bounds(d)[0] + 50 * NS} for d in DAYS]
    Cat.build_catalog(spark, root, members, CONFIG)
    return root


def test_tables_obey_their_contracts(spark, stored):
    base = spark.read.schema(Sch.BASE).parquet(f"{stored}/session_date={DAYS[0]}/base")
    assert base.count() == SECONDS and base.schema["bid_end_usd"].metadata == {"unit": "USD"}
    assert V.breaches(base, V.base_rules()).where("rows > 0").count() == 0
    mutations = {
        "bid_end_usd": F.lit(-1.0), "trade_count_1s": F.lit(None).cast("long"), "price_valid_duration_ns": F.lit(2 * NS), "halt_id": F.lit("x"), "quote_source_status": F.lit(7).cast("smallint"), "midpoint_twap_usd": F.col("midpoint_twap_usd") + 1,
        "price_end_reason_mask": F.lit(16), "midpoint_age_lower_bound_seconds": F.lit(3.0), "activity_valid_duration_ns": F.lit(0).cast("long"),
    }
    for column, value in mutations.items():
        assert V.breaches(base.withColumn(column, value), V.base_rules()).where("rows > 0").count() > 0, column
    features = spark.read.schema(Sch.features_schema(CONFIG)).parquet(f"{stored}/session_date={DAYS[0]}/features")
    with pytest.raises(ContractError):
        V.require(features.withColumn("movement_participation_hl5s", F.col("movement_participation_hl5s") + 1), V.feature_rules(CONFIG), "features")
    support = spark.read.schema(Sch.support_schema(CONFIG)).parquet(f"{stored}/session_date={DAYS[0]}/support")
    assert V.breaches(support, V.support_rules(CONFIG)).where("rows > 0").count() == 0
    from tidegrid.grid import Grid

    assert V.key_alignment({"base": base, "features": features, "support": support}, Grid()).count() == 0


def test_sql_over_views(spark, stored):
    e = Engine(spark, stored, Selection(dates=(DAYS[0], DAYS[0])))
    r = e.sql("SELECT count(*) AS n FROM features")
    assert r.df().n[0] == SECONDS
    assert e.sql("SELECT count(*) AS n FROM features JOIN current_ages USING (session_date, symbol, interval_end_ns) WHERE trade_age_seconds >= 0 AND trade_rate_per_second_hl5s > ?", [1]).df().n[0] > 0
    assert {x["name"] for x in e.sql("SELECT * FROM feature_catalog").preview().rows} == {f["name"] for f in e.fields} and len(e.fields) == 27
    text = e.sql("SELECT trade_rate_per_second_hl5s FROM features WHERE session = 'premarket'").frame._jdf.queryExecution().toString()
    plan = text.split("== Physical Plan ==")[1]
    assert plan.count("FileScan") == 1 and "age_seconds" not in plan.split("ReadSchema")[1]
    assert sum(b.num_rows for b in e.sql("SELECT * FROM features").arrow_batches(100)) == SECONDS
    assert e.sql("SELECT * FROM features").preview(5).truncated is True
    with pytest.raises(ValueError):
        e.sql("SELECT * FROM features").df(max_rows=10)


def test_typed_query_and_export(spark, stored, tmp_path):
    e = Engine(spark, stored)
    q = e.query([{"field": "trade_rate_per_second_hl5s", "operator": ">", "value": 2.4}, {"field": "quote_age_seconds", "operator": "<=", "value": 1}], ["quoted_spread_bps_hl5s"])
    receipt = q.export(f"file://{tmp_path}/out")
    rows = {r.session_date: r for r in spark.read.parquet(f"file://{tmp_path}/out/accounting").collect()}
    assert set(rows) == set(DAYS) and all(r.selected == SECONDS and r.matching > 0 and r.unavailable > 10 for r in rows.values())
    assert receipt["rows"]["observations"] == sum(r.matching for r in rows.values()) and receipt["identity"] == q.identity
    runs = spark.read.parquet(f"file://{tmp_path}/out/runs")
    assert runs.agg(F.sum("match_count")).first()[0] == receipt["rows"]["observations"] and "halt" in {r.closure_reason for r in runs.collect()} | {r.preceding_reason for r in runs.collect()} | {"halt"}
    with pytest.raises(FileExistsError):
        q.export(f"file://{tmp_path}/out")
    late = Engine(spark, stored, Selection(timing="nominal_post_discovery"), verify=False)
    assert late.query([{"field": "trade_age_seconds", "operator": ">=", "value": 0}]).accounting().agg(F.max("selected")).first()[0] == SECONDS - 50


def test_runs_shuffle_each_row_once(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = Engine(spark, stored, verify=False).query([{"field": "trade_rate_per_second_hl5s", "operator": ">", "value": 2.4}, {"field": "quote_age_seconds", "operator": "<=", "value": 1}])
        plan = q.evaluated().groupBy("session_date", "symbol").count()._jdf.queryExecution().executedPlan().toString()
        # features, base and the small table of ranges are dealt by member once each; nothing is dealt again
        assert plan.count("Exchange hashpartitioning") <= 3 and "Exchange hashpartitioning(session_date" in plan
        assert "interval_end_ns" not in "".join(x.split("hashpartitioning")[1].split(")")[0] for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_export_and_manifest(spark, stored, tmp_path):
    e = Engine(spark, stored, verify=False)
    m = e.sql("SELECT symbol, count(*) AS n FROM features GROUP BY symbol").export_parquet(f"file://{tmp_path}/x")
    assert m["rows"] == 1 and json.loads(sinks.read_text(spark, f"file://{tmp_path}/x/manifest.json"))["rows"] == 1
    empty = e.sql("SELECT symbol FROM features WHERE false").export_parquet(f"file://{tmp_path}/y")
    assert empty["rows"] == 0


def test_changed_files_are_refused(spark, stored, tmp_path):
    import shutil

    copy = tmp_path / "copy"
    shutil.copytree(stored.removeprefix("file://"), copy, ignore=shutil.ignore_patterns("*.crc"))
    Engine(spark, f"file://{copy}")
    victim = next((copy / f"session_date={DAYS[0]}/features").glob("part-*.parquet"))
    victim.write_bytes(victim.read_bytes() + b"x")
    with pytest.raises(ContractError):
        Engine(spark, f"file://{copy}")
    (copy / "catalog.json").write_text((copy / "catalog.json").read_text().replace("ABC", "ABD"))
    with pytest.raises(ContractError):
        Cat.read_catalog(spark, f"file://{copy}")
    for bad in ("/etc/passwd", "../x", ""):
        with pytest.raises(ContractError):
            Cat.contained("file:///r", bad)


def test_pages(spark, tmp_path):
    book = {"u": {"results": [{"ticker": "A", "type": "CS"}], "next_url": "u2", "status": "OK"}, "u2": {"results": [{"ticker": "B", "type": "ETF"}]}}
    assert [len(p) for p in vendor.pages(lambda url, _: json.dumps(book[url]), "u", {})] == [1, 1]
    loop = {"u": {"results": [], "next_url": "u"}}
    with pytest.raises(ContractError):
        list(vendor.pages(lambda url, _: json.dumps(loop[url]), "u", {}))
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("type", T.StringType())])
    got = vendor.acquire(spark, lambda url, _: json.dumps(book[url]), "u", {}, schema, f"file://{tmp_path}/ref")
    assert {r.symbol for r in vendor.reference_symbols(got, "2026-01-02").collect()} == {"A", "B"}


def test_pairs_and_inventory(spark):
    ev = lambda rows: spark.createDataFrame(rows, "session_date string, symbol string, sip_timestamp long, sequence_number long")
    pairs = Cat.pair_report(ev([("d", "A", 1, 1), ("d", "A", 1, 2), ("d", "B", 1, 1), ("d", "B", 1, 1)]), ev([("d", "A", 4, 1), ("d", "B", 3, 3)]))
    planned = spark.createDataFrame([("d", s) for s in "ABC"], "session_date string, symbol string")
    assert {r.symbol: r.complete for r in Cat.inventory(planned, pairs).collect()} == {"A": True, "B": False, "C": False}
    assert [r.symbol for r in Cat.missing_pairs(planned, pairs).collect()] == ["C"]


def test_command_line(capsys):
    assert cli.main(["fields"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 27
    with pytest.raises(SystemExit):
        cli.main(["nothing"])


def test_results_keep_the_schema(spark, stored):
    """A column that is null in the first batch and set later, and an empty result."""
    e = Engine(spark, stored, verify=False)
    reader = e.sql("SELECT id, CASE WHEN id >= 500 THEN id * 1.5D END AS late, timestamp_seconds(id) AS t FROM range(0, 1000, 1, 4)").arrow_batches(50)
    assert [str(f.type) for f in reader.schema] == ["int64", "double", "timestamp[us, tz=UTC]"]
    batches = list(reader)
    assert all(b.schema == reader.schema and b.num_rows <= 50 for b in batches) and sum(b.num_rows for b in batches) == 1000
    assert sum(b.column("late").null_count for b in batches) == 500
    none = e.sql("SELECT symbol, interval_end_ns FROM features WHERE false").arrow_batches()
    assert none.schema.names == ["symbol", "interval_end_ns"] and list(none) == []
    shown = e.sql("SELECT id FROM range(7)").preview(7)
    assert shown.columns == ["id"] and len(shown.rows) == 7 and not shown.truncated
    for wrong in (0, 101, True, 2.0):
        with pytest.raises(ContractError):
            e.sql("SELECT 1").preview(wrong)
    with pytest.raises(ContractError):
        e.sql("SELECT 1").arrow_batches(25_001)


def test_catalog_scans_its_fields(spark, stored, tmp_path):
    root = f"file://{tmp_path}/root"
    for table, schema in (("base", Sch.BASE), ("features", Sch.features_schema(CONFIG))):
        df = spark.read.schema(schema).parquet(f"{stored}/session_date={DAYS[0]}/{table}")
        if table == "features":
            df = df.withColumn("trade_rate_per_second_hl5s", F.lit(-1.0))
        df.write.parquet(f"{root}/{table}")
    members = [{"session_date": DAYS[0], "symbol": "ABC", "base": "base", "features": "features"}]
    with pytest.raises(ContractError, match="trade_rate_per_second_hl5s"):
        Cat.build_catalog(spark, root, members, CONFIG)
    assert Cat.build_catalog(spark, root, members, CONFIG, checked=False)["files"]


def test_pairs_are_published_together(spark, tmp_path):
    start = session_bounds("2026-06-01")[0]
    row = lambda schema, at, seq: tuple({"sip_timestamp": at, "sequence_number": seq}.get(f.name) for f in schema.fields)
    make = lambda schema, rows: spark.createDataFrame([row(schema, *r) for r in rows], schema)
    good = {"trades": make(Sch.VENDOR_TRADES, [(start, 1), (start, 2)]), "quotes": make(Sch.VENDOR_QUOTES, [(start + 5, 1)])}
    assert vendor.acquire_pair(spark, good, f"file://{tmp_path}/a", "ABC", "2026-06-01") == {"trades": 2, "quotes": 1}
    assert spark.read.parquet(f"file://{tmp_path}/a/trades").count() == 2
    for bad in ([], [(start - 1, 1)], [(start, 1), (start, 1)]):
        with pytest.raises(ContractError):
            vendor.acquire_pair(spark, good | {"quotes": make(Sch.VENDOR_QUOTES, bad)}, f"file://{tmp_path}/b", "ABC", "2026-06-01")
    assert not (tmp_path / "b").exists()


def test_command_groups(spark, stored, tmp_path, capsys):
    """Commands over stored tables; the session is the tests' own."""
    where = f"file://{tmp_path}"
    day = f"{stored}/session_date={DAYS[0]}"
    (tmp_path / "config.json").write_text(json.dumps(CONFIG.to_dict()))
    config = ["--config", str(tmp_path / "config.json")]
    assert cli.main(["base", "verify", f"{day}/base"]) == 0
    assert cli.main(["features", "build", f"{day}/base", f"{where}/features", *config]) == 0
    assert cli.main(["features", "verify", f"{where}/features", *config]) == 0
    assert cli.main(["report", "members", stored, f"{where}/report"]) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert said[0]["broken"] == 0 and said[1] == {"rows": SECONDS} and said[2]["broken"] == 0 and said[3] == {"rows": len(DAYS)}
    with pytest.raises(SystemExit):
        cli.main(["calculate"])


def test_receipts(spark, tmp_path):
    from tidegrid.sources.receipts import verify_receipt, write_receipt

    folder = f"file://{tmp_path}/stage"
    spark.range(5).coalesce(1).write.parquet(f"{folder}/out")
    done = write_receipt(spark, folder, "demo", inputs={}, parameters={"p": 1}, outputs=["out"], validation={"complete": True, "rows": 5})
    assert verify_receipt(spark, folder)["identity"] == done["identity"]
    with pytest.raises(ContractError):
        write_receipt(spark, f"{folder}2", "demo", inputs={}, parameters={}, outputs=[], validation={"complete": False})
    (tmp_path / "stage" / "stage.json").write_text((tmp_path / "stage" / "stage.json").read_text().replace('"p":1', '"p":2'))
    (tmp_path / "stage" / ".stage.json.crc").unlink(missing_ok=True)
    with pytest.raises(ContractError):
        verify_receipt(spark, folder)


def test_minute_bars(spark):
    start = session_bounds("2026-06-01")[0]
    page = spark.createDataFrame([(start // 1_000_000, 5.0, 10.0, 1.0, 2.0, 3.0, 0.5)], "t long, n double, v double, o double, c double, h double, l double")
    row = vendor.minute_bars(page, "A", start, start + NS).first()
    assert (row.window_start, row.transactions, row.close, row.low) == (start, 5.0, 2.0, 0.5)
    with pytest.raises(Exception, match="outside its session"):
        vendor.minute_bars(page, "A", start + 1, start + NS).collect()
