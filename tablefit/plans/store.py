"""Run log and registry tables under one root in the shared folder.

``runs`` and ``trials`` have a sub-folder for each run, which a retried task
writes again: a run counts once, and tasks that log different runs at the same
time never share a folder. ``model_versions`` and ``model_aliases`` are
append-only logs written by one promotion job at a time; readers take the latest
row by ``seq``. A table that cannot be read is an error; only one that was never
written is empty.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.operators import registry, search
from tablefit.operators.models import Model, model_from_json
from tablefit.sources.commits import CommitLog


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str, schema, by_run: bool = False) -> DataFrame:
        path = self.path(table) + ("/*" if by_run else "")
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _log(self) -> CommitLog:
        return CommitLog(self.spark, self.path("registry_log"))

    def _committed(self, rows: str, schema, upto: list[int] | None) -> DataFrame:
        """Rows of the commits (of the given numbers, or all made by now), one per registration."""
        log = self._log()
        files = [log.file(n) for n in (log.numbers() if upto is None else upto)]
        if not files:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([T.StructField(rows, T.ArrayType(schema))])
        return self.spark.read.schema(whole).option("mode", "FAILFAST").json(files).select(F.inline(rows))

    # M11
    def log_search(self, results: list) -> None:
        for res in results:
            name = quote(res.run_id, safe="")
            search.trials_frame(self.spark, [res]).write.mode("overwrite").parquet(f"{self.path('trials')}/{name}")
            search.runs_frame(self.spark, [res]).write.mode("overwrite").parquet(f"{self.path('runs')}/{name}")

    def runs(self) -> DataFrame:
        return self._read("runs", search.RUNS_SCHEMA, by_run=True)

    def trials(self) -> DataFrame:
        return self._read("trials", search.TRIALS_SCHEMA, by_run=True)

    # V1-V3
    def versions(self, upto: list[int] | None = None) -> DataFrame:
        return (self._read("model_versions", registry.VERSIONS_SCHEMA)
                .unionByName(self._committed("versions", registry.VERSIONS_SCHEMA, upto)))

    def aliases(self, upto: list[int] | None = None) -> DataFrame:
        return (self._read("model_aliases", registry.ALIASES_SCHEMA)
                .unionByName(self._committed("aliases", registry.ALIASES_SCHEMA, upto)))

    def register(self, model_name: str, assignments: list[tuple[str, str]]) -> int:
        """Register ``(alias, run_id)`` pairs in order, as one commit: each gets a new
        version. Returns the commit's number."""
        def make(seen):
            versions, aliases = self.versions(seen), self.aliases(seen)
            last = aliases.agg(F.max("seq")).first()[0]
            first = 0 if last is None else last + 1
            req = self.spark.createDataFrame(
                [(model_name, run_id, alias, first + i) for i, (alias, run_id) in enumerate(assignments)],
                "model_name string, run_id string, alias string, seq long")
            new_v, new_a = registry.register(versions, aliases, req)
            # One row per registration.
            return {"versions": [r.asDict() for r in new_v.collect()], "aliases": [r.asDict() for r in new_a.collect()]}

        return self._log().commit(make)[0]

    def signature(self, run_id: str) -> dict:
        import json

        row = self.runs().filter(F.col("run_id") == run_id).select("signature").limit(1).collect()
        if not row:
            raise ValueError(f"Run {run_id!r} is not in the run log")
        return json.loads(row[0]["signature"])

    def resolve(self, model_name: str, alias: str) -> tuple[int, str, Model]:
        res = (registry.resolve(self.versions(), self.aliases())
               .filter((F.col("model_name") == model_name) & (F.col("alias") == alias)).collect())
        if not res:
            raise ValueError(f"No alias {alias!r} for model {model_name!r}")
        version, run_id = res[0]["version"], res[0]["run_id"]
        run = self.runs().filter(F.col("run_id") == run_id).select("model").limit(1).collect()
        if not run:
            raise ValueError(f"Run {run_id!r} behind {model_name}@{alias} is not in the run log")
        return version, run_id, model_from_json(run[0]["model"])
