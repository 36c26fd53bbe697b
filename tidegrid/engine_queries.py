"""Registered queries of sources, catalog, engine and typed queries, on tables written from the replayed events."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid import schema as S
from tidegrid.config import NS
from tidegrid.engine import Engine
from tidegrid.operators import features as Fe
from tidegrid.operators import validation as V
from tidegrid.operators.selection import Selection
from tidegrid.replay_queries import CONFIG, DAY, GRID, START, _shown, base, contexts, quotes, trades
from tidegrid.sources import catalog as C
from tidegrid.sources import events as E
from tidegrid.sources import sinks

PREDICATES = [{"field": "trade_rate_per_second_hl4s", "operator": ">", "value": 0.2}, {"field": "quote_age_seconds", "operator": "<=", "value": 1.5}]
DISPLAY = ["quoted_spread_bps_hl4s"]
CHOSEN = Selection(sessions=("premarket",), members=tuple((DAY, s) for s in ("CLICK", "ERROR", "VIEW")), bounds=(START + 50 * NS + 1, START + 850 * NS))


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared folder that the session names; a local session without one gets its own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set")
        where = f"file://{tempfile.mkdtemp(prefix='tidegrid-')}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    full = "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full
    return f"{full}/core-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(spark: SparkSession, sf: str) -> str:
    """Base and features of every member, validated and catalogued; the catalog's root."""
    root = _folder(spark)
    df = base(spark, sf)
    df.write.option("compression", "zstd").parquet(f"{root}/work")
    work = spark.read.schema(df.schema).parquet(f"{root}/work")
    tables = {"base": S.named(work, S.BASE), "features": S.named(Fe.features(work, GRID, CONFIG), S.features_schema(CONFIG))}
    for name, table in tables.items():
        table.withColumn("member", F.col("symbol")).write.option("compression", "zstd").partitionBy("member").parquet(f"{root}/{name}")
    symbols = sorted(r.symbol for r in contexts(spark, sf).select("symbol").collect())
    members = [{"session_date": DAY, "symbol": s, **{t: f"{t}/member={s}" for t in tables}} for s in symbols]
    C.build_catalog(spark, root, members, CONFIG)
    return root


# --- sources --------------------------------------------------------------------


def events_scanned(spark, sf):
    """Projected quotes of a time range from stored files."""
    folder = _folder(spark)
    df = quotes(spark, sf)
    df.write.parquet(f"{folder}/quotes")
    got = E.read_events(spark, [f"{folder}/quotes"], df.schema, ["symbol", "sip_timestamp", "sequence_number", "bid_price"], stop=START + 600 * NS, start=START + 200 * NS)
    return got.select("symbol", "sequence_number", (F.col("sip_timestamp") - START).alias("r"), "bid_price")


def records_read(spark, sf):
    """Trades through JSON lines and back."""
    folder = _folder(spark)
    df = trades(spark, sf).select("symbol", "sequence_number", "decimal_size", "price")
    df.write.json(f"{folder}/trades.jsonl")
    got = E.read_records(spark, f"{folder}/trades.jsonl", df.schema)
    return got.groupBy("symbol").agg(F.count("*").alias("trades"), F.sum("price").alias("prices"), F.countDistinct("decimal_size").alias("sizes"))


def pair_report(spark, sf):
    got = C.pair_report(quotes(spark, sf), trades(spark, sf))
    return got.select("symbol", "stream", "rows", (F.col("first_ns") - START).alias("first"), (F.col("last_ns") - START).alias("last"), "repeated_keys")


def pair_inventory(spark, sf):
    """Planned members, one of which has no events."""
    planned = contexts(spark, sf).select("session_date", "symbol").unionByName(spark.createDataFrame([(DAY, "NONE")], "session_date string, symbol string"))
    pairs = C.pair_report(quotes(spark, sf), trades(spark, sf).where("symbol <> 'VIEW'"))
    missing = C.missing_pairs(planned, pairs).select("symbol", F.lit(True).alias("missing"))
    return C.inventory(planned, pairs).join(missing, "symbol", "left").select("symbol", "event_count", "complete", F.coalesce("missing", F.lit(False)).alias("missing"))


def study_pair_written(spark, sf):
    """A study table as JSON lines and CSV, read back."""
    folder = _folder(spark)
    df = pair_report(spark, sf).select("symbol", "stream", "rows")
    sinks.write_pair(df, folder)
    one = spark.read.schema(df.schema).json(f"{folder}/json").withColumn("form", F.lit("json"))
    return one.unionByName(spark.read.schema(df.schema).option("header", True).csv(f"{folder}/csv").withColumn("form", F.lit("csv")))


def catalog_verified(spark, sf):
    """Every file of a catalog hashed again, and one changed file found."""
    root = stored(spark, sf)
    known = C.read_catalog(spark, root)
    C.verify_files(spark, root, known)
    files = {k: v for k, v in known["files"].items()}
    first = next(k for k in files if k.startswith("features/member=ERROR"))
    wrong = C.changed_files(spark, root, known | {"files": files | {first: [files[first][0], "0"]}})
    member = F.regexp_extract("path", r"member=([A-Z]+)", 1)
    found = wrong.groupBy(member.alias("symbol")).agg(F.count("*").alias("changed"))
    every = spark.createDataFrame([(m["symbol"],) for m in known["members"]], "symbol string")
    return every.join(found, "symbol", "left").select("symbol", F.coalesce("changed", F.lit(0)).alias("changed"))


# --- engine ----------------------------------------------------------------------


def engine_sql(spark, sf):
    """SQL over the views: features joined with current ages of a selection's members, with parameters."""
    e = Engine(spark, stored(spark, sf), CHOSEN)
    text = """SELECT f.symbol, f.interval_end_ns, f.session, f.share_rate_per_second_hl4s, a.trade_age_seconds FROM features f JOIN current_ages a USING (session_date, symbol, interval_end_ns)
              WHERE f.share_rate_per_second_hl4s > :rate AND a.trade_age_seconds <= :age"""
    got = e.sql(text, {"rate": 0.55, "age": 2}).frame
    return got.select("symbol", F.call_function("div", F.col("interval_end_ns") - F.lit(START), F.lit(NS)).alias("second"), "session", F.round("share_rate_per_second_hl4s", 6).alias("share_rate"), F.round("trade_age_seconds", 9).alias("trade_age"))


def engine_projected(spark, sf):
    """Two fields of different tables with their masks, and the rules of those fields."""
    e = Engine(spark, stored(spark, sf), CHOSEN, verify=False)
    names = ["midpoint_rms_5s_to_spread_hl16s", "midpoint_change_age_seconds"]
    df = e.projected(names)
    V.require(df, V.projected_rules(e.fields, names), "projected fields")
    return _shown(df.withColumn(names[0], F.round(names[0], 6)), names[0], f"{names[0]}_reason_mask", names[1], "midpoint_change_age_reason_mask")


def _query(spark, sf):
    return Engine(spark, stored(spark, sf), CHOSEN, verify=False).query(PREDICATES, DISPLAY)


def engine_observations(spark, sf):
    df = _query(spark, sf).observations()
    return _shown(df, "trade_rate_per_second_hl4s", "trade_rate_per_second_hl4s_reason_mask", "quote_age_seconds", "quote_age_reason_mask", "quoted_spread_bps_hl4s", "quoted_spread_bps_hl4s_reason_mask", places=6)


def engine_runs(spark, sf):
    at = lambda c, n: F.call_function("div", F.col(c) - F.lit(START), F.lit(NS)).alias(n)
    return _query(spark, sf).runs().select("symbol", at("first_endpoint", "first_second"), at("last_endpoint", "last_second"), "match_count", "run_ordinal", "preceding_reason", "closure_reason")


def engine_accounting(spark, sf):
    return _query(spark, sf).accounting().select("symbol", "selected", "eligible", "matching", "nonmatching", "unavailable")


def engine_export(spark, sf):
    """A query's four tables exported with a receipt, and what the receipt counts."""
    folder = _folder(spark)
    receipt = _query(spark, sf).export(f"{folder}/out")
    return spark.createDataFrame(sorted(receipt["rows"].items()), T.StructType([T.StructField("table", T.StringType()), T.StructField("rows", T.LongType())]))


def engine_results(spark, sf):
    """A result by Arrow batches, as a bounded pandas frame, as a preview and as an export."""
    e = Engine(spark, stored(spark, sf), CHOSEN, verify=False)
    ages = e.sql("SELECT symbol, trade_age_seconds FROM current_ages")
    reader = ages.arrow_batches(500)
    rows = known = 0
    for batch in reader:
        rows, known = rows + batch.num_rows, known + batch.num_rows - batch.column("trade_age_seconds").null_count
    shown = ages.preview(60)
    frame = e.sql("SELECT symbol, count(trade_age_seconds) AS n FROM current_ages GROUP BY symbol").df()
    done = ages.export_parquet(f"{_folder(spark)}/export")
    none = e.sql("SELECT symbol, trade_age_seconds FROM current_ages WHERE false").arrow_batches()
    out = [
        ("arrow", rows, known), ("frame", len(frame), int(frame.n.sum())), ("preview", len(shown.rows), int(shown.truncated)), ("export", done["rows"], 0), ("empty", sum(b.num_rows for b in none), len(none.schema)),
        ("columns", len(shown.columns), len(reader.schema)),
    ]
    return spark.createDataFrame(out, "way string, rows bigint, more bigint")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        events_scanned, records_read, pair_report, pair_inventory, study_pair_written, catalog_verified, engine_sql, engine_projected, engine_observations, engine_runs, engine_accounting, engine_export, engine_results,
    )
    return {f.__name__: f for f in own}
