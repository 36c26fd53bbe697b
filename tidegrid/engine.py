"""The query engine: a scoped catalog as SQL views, and typed queries over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import schema as S
from tidegrid.config import ContractError, FeatureConfig, View, digest
from tidegrid.grid import Grid, endpoint_time, local_seconds, session_name
from tidegrid.operators import accounting as A
from tidegrid.operators.features import AGES, feature_catalog
from tidegrid.operators.predicates import Field, Predicates, compile_predicates
from tidegrid.operators.runs import strict_runs
from tidegrid.operators.selection import Selection, annotate
from tidegrid.sources import sinks
from tidegrid.sources.catalog import contained, read_catalog, verify_files
from tidegrid.sources.events import read_members

VIEWS = ("features", "current_ages", "members", "feature_catalog")


def fields_of(catalog: Sequence[Mapping]) -> list[Field]:
    return [Field(f["name"], f["reason_mask"], (f["source"],)) for f in catalog]


class Result:
    """A lazy SQL result; its DataFrame is ``frame``."""

    def __init__(self, frame: DataFrame, text: str, scope: Mapping):
        self.frame, self.text, self.scope = frame, text, scope

    def arrow_batches(self, rows: int = 25_000) -> pa.RecordBatchReader:
        """Batches of 1 to 25,000 rows, read as a stream."""
        if isinstance(rows, bool) or not isinstance(rows, int) or not 1 <= rows <= 25_000:
            raise ContractError("a batch has 1 to 25,000 rows")
        return sinks.arrow_batches(self.frame, rows)

    def df(self, max_rows: int = 10_000):
        return sinks.bounded(self.frame, max_rows)

    def preview(self, rows: int = 100) -> sinks.Preview:
        return sinks.preview(self.frame, rows)

    def export_parquet(self, target: str) -> dict:
        return sinks.export_parquet(self.frame, target, query=self.text, scope=self.scope)


class Engine:
    """Opened on a catalog with a selection: only its members' files are registered.

    ``features`` and ``current_ages`` are separate views, because an unused
    keyed join stays in a plan: a query on features alone never scans the base.
    """

    def __init__(self, spark: SparkSession, root: str, selection: Selection = Selection(), *, verify: bool = True, grid: Grid = Grid()):
        self.spark, self.root, self.selection, self.grid = spark, root, selection, grid
        # Tables dealt by member keys may be joined on member and time without being dealt again.
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self.catalog = read_catalog(spark, root)
        if verify and self.catalog["files"]:
            verify_files(spark, root, self.catalog)
        c = self.catalog["config"]
        self.config = FeatureConfig(**(c | {"views": tuple(View(*v) for v in c["views"]), "age_windows": tuple(c["age_windows"])}))
        self.members = selection.scope(self.catalog["members"])
        self.fields = feature_catalog(self.config)
        self._register()

    def _paths(self, table: str) -> list[str]:
        return [contained(self.root, m[table]) for m in self.members]

    def table(self, name: str) -> DataFrame:
        """The scoped ``features`` or ``base`` relation."""
        return read_members(self.spark, self._paths(name), S.BASE if name == "base" else S.features_schema(self.config))

    def _labelled(self, df: DataFrame) -> DataFrame:
        end = F.col(self.grid.time)
        return df.withColumns({"endpoint_time": endpoint_time(end), "session": session_name(local_seconds(end))})

    def _register(self) -> None:
        names = sorted({k for m in self.members for k in m if k not in ("base", "features")})
        members = self.spark.createDataFrame([tuple(str(m[k]) if m.get(k) is not None else None for k in names) for m in self.members], ", ".join(f"{k} string" for k in names))
        ages = [c for a in AGES for c in (f"{a}_age_seconds", f"{a}_age_reason_mask")]
        views = {
            "features": self._labelled(self.table("features")), "current_ages": self._labelled(self.table("base").select(*self.grid.columns, *ages)), "members": members,
            "feature_catalog": self.spark.createDataFrame([tuple(f.values()) for f in self.fields], ", ".join(f"`{k}` string" for k in self.fields[0])),
        }
        for name, df in views.items():
            df.createOrReplaceTempView(name)

    @property
    def scope(self) -> dict:
        return {"catalog": self.catalog["identity"], "members": [f"{m['session_date']}/{m['symbol']}" for m in self.members]}

    def sql(self, text: str, args: Mapping[str, Any] | Sequence[Any] | None = None) -> Result:
        """Any Spark SQL over the four views; ``args`` fill ``:name`` or ``?`` markers."""
        return Result(self.spark.sql(text, args=list(args) if isinstance(args, (list, tuple)) else args), text, self.scope)

    def projected(self, names: Sequence[str], *, ages: bool = True) -> DataFrame:
        """Chosen fields with their masks, joined only if fields of both tables are asked for."""
        by = {f["name"]: f for f in self.fields}
        cols = lambda t: [c for n in names if by[n]["table"] == t for c in (n, by[n]["reason_mask"])]
        parts = [self.spark.table(t).select(*self.grid.columns, *cols(t)) for t in ("features", "current_ages") if cols(t)]
        out = parts[0]
        for p in parts[1:]:
            out = out.join(p, self.grid.columns)
        return out

    def query(self, predicates: Sequence[Mapping[str, Any]], display: Sequence[str] = ()) -> Query:
        compiled = compile_predicates(predicates, fields_of(self.fields))
        return Query(self, compiled, tuple(display))


class Query:
    """A typed query: observations, strict runs, accounting and contributions over one evaluated relation."""

    def __init__(self, engine: Engine, predicates: Predicates, display: tuple[str, ...]):
        self.engine, self.predicates, self.display = engine, predicates, display

    @property
    def descriptor(self) -> dict:
        s = self.engine.selection
        return {
            "catalog": self.engine.catalog["identity"], "config": self.engine.config.identity, "predicates": self.predicates.to_dict(), "display": list(self.display),
            "selection": {"sessions": list(s.sessions), "members": self.engine.scope["members"], "dates": s.dates, "bounds": s.bounds, "timing": s.timing}, "sources": self.predicates.sources,
        }

    @property
    def identity(self) -> str:
        return digest(self.descriptor)

    def evaluated(self) -> DataFrame:
        e = self.engine
        names = list(dict.fromkeys([*self.predicates.fields, *self.display]))
        by = {f["name"]: f for f in e.fields}
        pick = lambda t: [c for n in names if by[n]["table"] == t for c in (n, by[n]["reason_mask"])]
        context = ["halt_active", *[c for s in self.predicates.sources for c in (f"{s}_continuity_id", f"{s}_continuity_break_in_second")]]
        # Ages and context are of the same table, so it is read once; both sides are dealt by member, which the
        # join on member and time and the windows of runs both accept, so each row is shuffled once.
        rows = e.table("base").select(*e.grid.columns, *pick("current_ages"), *context).repartition(*e.grid.keys)
        if pick("features"):
            rows = e.table("features").select(*e.grid.columns, *pick("features")).repartition(*e.grid.keys).join(rows, e.grid.columns)
        return self.predicates.evaluate(annotate(rows, e.selection.ranges(e.members), e.grid))

    def observations(self) -> DataFrame:
        by = {f["name"]: f["reason_mask"] for f in self.engine.fields}
        cols = [c for n in dict.fromkeys([*self.predicates.fields, *self.display]) for c in (n, by[n])]
        return self.evaluated().where(F.col("status") == "matching").select(*self.engine.grid.columns, *cols)

    def runs(self) -> DataFrame:
        return strict_runs(self.evaluated(), self.engine.grid, self.identity, sources=self.predicates.sources)

    def accounting(self) -> DataFrame:
        planned = self.engine.spark.createDataFrame([(m["session_date"], m["symbol"]) for m in self.engine.members], "session_date string, symbol string")
        return A.member_accounting(self.evaluated(), ["session_date", "symbol"], planned)

    def export(self, target: str) -> dict:
        """Four tables and a receipt; counts that do not reconcile are an error."""
        accounting = self.accounting()
        if A.unreconciled(accounting).limit(1).count():
            raise AssertionError("accounting does not reconcile")
        tables = {"observations": self.observations(), "runs": self.runs(), "accounting": accounting, "contributions": A.contributions(accounting, ["session_date", "symbol"])}
        receipt = sinks.export_tables(tables, target, {"identity": self.identity, "descriptor": self.descriptor})
        matching = accounting.agg(F.coalesce(F.sum("matching"), F.lit(0))).first()[0]
        if receipt["rows"]["observations"] != matching:
            raise AssertionError("observations and accounting differ")
        return receipt


def status_column(predicates: Sequence[Mapping[str, Any]], fields: Sequence[Field]) -> Column:
    return compile_predicates(predicates, fields).status
