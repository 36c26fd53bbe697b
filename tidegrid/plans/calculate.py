"""Raw pairs to base, features and support tables for many members: one plan, restartable by date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import schema as S
from tidegrid.config import ContractError, FeatureConfig, digest
from tidegrid.grid import Grid
from tidegrid.operators import validation as V
from tidegrid.operators.features import features
from tidegrid.operators.replay import replay
from tidegrid.sources.sinks import exists, publish, write_text


def create_plan(members: Sequence[tuple[str, str]], config: FeatureConfig, root: str) -> dict:
    """Members, configuration and output root with the plan's identity."""
    if len(set(members)) != len(members) or not members:
        raise ContractError("a plan needs distinct members")
    body = {"members": sorted(map(list, members)), "config": config.to_dict(), "root": root}
    return body | {"identity": digest(body)}


def preflight(plan: dict, context: DataFrame) -> list[str]:
    """Reasons not to run: a changed plan, or members without context."""
    found = []
    if digest({k: v for k, v in plan.items() if k != "identity"}) != plan["identity"]:
        found.append("the plan was changed")
    have = {(r["session_date"], r["symbol"]) for r in context.select("session_date", "symbol").distinct().collect()}
    found += [f"no context for {d}/{s}" for d, s in plan["members"] if (d, s) not in have]
    return found


def calculate(spark: SparkSession, plan: dict, quotes: DataFrame, trades: DataFrame, context: DataFrame, *, validate: bool = True, grid: Grid = Grid()) -> list[str]:
    """Write base, features and support of each date that is not there yet; returns the dates written.

    All members of a date are one job, shuffled by member; a date's folder
    appears whole or not at all, so a stopped run continues where it was.
    """
    blockers = preflight(plan, context)
    if blockers:
        raise ContractError("; ".join(blockers))
    config = FeatureConfig.from_dict(plan["config"])
    done = []
    for day in sorted({d for d, _ in plan["members"]}):
        target = f"{plan['root'].rstrip('/')}/session_date={day}"
        if exists(spark, target):
            continue
        symbols = [s for d, s in plan["members"] if d == day]
        mine = lambda df, day=day, symbols=symbols: df.where((F.col("session_date") == day) & F.col("symbol").isin(symbols))
        attempt = f"{target}.attempt-{plan['identity'][:12]}"
        base = replay(mine(quotes), mine(trades), mine(context), config, grid)
        base.write.mode("overwrite").option("compression", "zstd").parquet(f"{attempt}/work")
        stored = spark.read.parquet(f"{attempt}/work")
        full = features(stored, grid, config)
        tables = {"base": S.named(stored, S.BASE), "features": S.named(full, S.features_schema(config)), "support": S.named(full, S.support_schema(config))}
        rules = {"base": V.base_rules(), "features": V.feature_rules(config), "support": V.support_rules(config)}
        for name, df in tables.items():
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{attempt}/{name}")
            if validate:
                V.require(spark.read.schema(df.schema).parquet(f"{attempt}/{name}"), rules[name], f"{name} of {day}")
        write_text(spark, f"{attempt}/receipt-{plan['identity'][:12]}.json", plan["identity"])
        publish(spark, attempt, target)
        done.append(day)
    return done
