"""Command line: catalogs, queries, calculation of members, base checks, storage, acquisition, reports and the screen."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from tidegrid.config import ContractError, FeatureConfig
from tidegrid.operators.features import feature_catalog
from tidegrid.operators.selection import SESSIONS, Selection


def _scoped(sub, name: str, text: str) -> argparse.ArgumentParser:
    c = sub.add_parser(name, help=text)
    c.add_argument("catalog")
    c.add_argument("--session", action="append", choices=list(SESSIONS))
    c.add_argument("--dates", nargs=2, metavar=("FIRST", "LAST"))
    c.add_argument("--out")
    return c


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidegrid")
    sub = p.add_subparsers(dest="command", required=True)
    _scoped(sub, "sql", "run SQL over the views").add_argument("text")
    _scoped(sub, "query", "run a typed query").add_argument("predicates", help="a JSON list of predicates")
    _scoped(sub, "verify", "hash all files of a catalog again")
    _scoped(sub, "inspect", "show the scope")
    sub.add_parser("fields", help="list the queryable fields")
    s = sub.add_parser("screen", help="two-bar screen over minute bars")
    for name in ("bars", "reference", "out"):
        s.add_argument(name)

    def group(name: str, text: str, **commands: str) -> None:
        g = sub.add_parser(name, help=text).add_subparsers(dest="action", required=True)
        for action, arguments in commands.items():
            c = g.add_parser(action)
            for a in arguments.split():
                c.add_argument(a) if not a.startswith("--") else c.add_argument(a, default=None)

    group("calculate", "members to base, features and support", plan="contexts root out --config", preflight="plan contexts", run="plan contexts quotes trades")
    group("base", "contexts and base tables", admit="contexts out", build="contexts quotes trades out", verify="base")
    group("features", "feature tables", build="base out --config", verify="features --config")
    group("storage", "stored pairs and catalogs", pairs="quotes trades out", inventory="planned quotes trades out", catalog="root members --config")
    group("acquire", "saved vendor pages to tables", trades="pages out symbol date", quotes="pages out symbol date", pair="trades quotes out symbol date")
    group("report", "tables of a study", members="catalog out", ages="catalog out")
    return p


def _config(path: str | None) -> FeatureConfig:
    if path is None:
        return FeatureConfig()
    with open(path, encoding="utf-8") as f:
        return FeatureConfig.from_dict(json.load(f))


def _calculate(spark, a) -> dict:
    from tidegrid.plans import calculate as C

    contexts = spark.read.parquet(a.contexts)
    if a.action == "plan":
        members = [(r.session_date, r.symbol) for r in contexts.select("session_date", "symbol").distinct().collect()]
        plan = C.create_plan(members, _config(a.config), a.root)
        with open(a.out, "x", encoding="utf-8") as f:
            json.dump(plan, f)
        return {"identity": plan["identity"], "members": len(members)}
    with open(a.plan, encoding="utf-8") as f:
        plan = json.load(f)
    if a.action == "preflight":
        return {"blockers": C.preflight(plan, contexts)}
    return {"dates": C.calculate(spark, plan, spark.read.parquet(a.quotes), spark.read.parquet(a.trades), contexts)}


def _rules_kept(df, rules) -> dict:
    from tidegrid.operators import validation as V

    broken = {r["rule"]: r["rows"] for r in V.breaches(df, rules).where("rows > 0").collect()}
    if broken:
        raise ContractError(json.dumps(broken))
    return {"rules": len(rules), "broken": 0}


def _base(spark, a) -> dict:
    from tidegrid import schema as S
    from tidegrid.operators import validation as V
    from tidegrid.operators.admission import admit
    from tidegrid.operators.replay import replay

    if a.action == "verify":
        return _rules_kept(spark.read.schema(S.BASE).parquet(a.base), V.base_rules())
    contexts = spark.read.parquet(a.contexts)
    if a.action == "admit":
        states = admit(contexts)
        states.write.parquet(a.out)
        return {r.state: r["count"] for r in spark.read.parquet(a.out).groupBy("state").count().collect()}
    S.named(replay(spark.read.parquet(a.quotes), spark.read.parquet(a.trades), contexts), S.BASE).write.option("compression", "zstd").parquet(a.out)
    return {"rows": spark.read.parquet(a.out).count()}


def _features(spark, a) -> dict:
    from tidegrid import schema as S
    from tidegrid.grid import Grid
    from tidegrid.operators import validation as V
    from tidegrid.operators.features import features

    config = _config(a.config)
    if a.action == "verify":
        return _rules_kept(spark.read.schema(S.features_schema(config)).parquet(a.features), V.feature_rules(config))
    full = features(spark.read.schema(S.BASE).parquet(a.base), Grid(), config)
    S.named(full, S.features_schema(config)).write.option("compression", "zstd").parquet(a.out)
    return {"rows": spark.read.parquet(a.out).count()}


def _storage(spark, a) -> dict:
    from tidegrid.sources import catalog as C

    if a.action == "catalog":
        with open(a.members, encoding="utf-8") as f:
            return {"identity": C.build_catalog(spark, a.root, json.load(f), _config(a.config))["identity"]}
    report = C.pair_report(spark.read.parquet(a.quotes), spark.read.parquet(a.trades))
    out = report if a.action == "pairs" else C.inventory(spark.read.parquet(a.planned), report)
    out.write.parquet(a.out)
    return {"rows": spark.read.parquet(a.out).count()}


def _acquire(spark, a) -> dict:
    from tidegrid import schema as S
    from tidegrid.sources import vendor

    schema = {"trades": S.VENDOR_TRADES, "quotes": S.VENDOR_QUOTES}
    if a.action == "pair":
        return vendor.acquire_pair(spark, {k: spark.read.schema(schema[k]).json(getattr(a, k)) for k in schema}, a.out, a.symbol, a.date)
    df = vendor.normalize_stream(spark.read.schema(schema[a.action]).json(a.pages), schema[a.action], a.symbol, a.date)
    df.write.option("compression", "zstd").parquet(a.out)
    return {"rows": spark.read.parquet(a.out).count()}


def _report(spark, a) -> dict:
    from tidegrid.engine import Engine
    from tidegrid.sources import sinks

    e = Engine(spark, a.catalog, verify=False)
    text = "SELECT session_date, symbol, session, count(*) AS seconds FROM features GROUP BY 1, 2, 3" if a.action == "members" else (
        "SELECT session_date, symbol, count(trade_age_seconds) AS trades_seen, max(trade_age_seconds) AS longest_trade_age, count(quote_age_seconds) AS quotes_seen, max(quote_age_seconds) AS longest_quote_age FROM current_ages GROUP BY 1, 2"
    )
    sinks.write_pair(e.sql(text).frame, a.out)
    return {"rows": spark.read.json(f"{a.out}/json").count()}


GROUPS: dict[str, Callable] = {"calculate": _calculate, "base": _base, "features": _features, "storage": _storage, "acquire": _acquire, "report": _report}


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "fields":
        for f in feature_catalog():
            print(json.dumps(f))
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("tidegrid").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command in GROUPS:
        print(json.dumps(GROUPS[a.command](spark, a)))
        return 0
    if a.command == "screen":
        from tidegrid.operators.screen import first_hits, screened_bars

        first_hits(screened_bars(spark.read.parquet(a.bars), spark.read.parquet(a.reference))).write.parquet(a.out)
        return 0
    from tidegrid.engine import Engine

    selection = Selection(sessions=tuple(a.session or SESSIONS), dates=tuple(a.dates) if a.dates else None)
    engine = Engine(spark, a.catalog, selection, verify=a.command == "verify")
    if a.command in ("inspect", "verify"):
        print(json.dumps(engine.scope))
    elif a.command == "sql":
        r = engine.sql(a.text)
        print(json.dumps(r.export_parquet(a.out)["rows"]) if a.out else r.df().to_string())
    else:
        q = engine.query(json.loads(a.predicates))
        print(json.dumps(q.export(a.out)["rows"]) if a.out else q.accounting().toPandas().to_string())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
