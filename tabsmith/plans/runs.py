"""Run log with one commit record per run.

``params(run_id, k, v)`` and ``metrics(run_id, name, value)`` are Parquet folders with one
subfolder per run, so that runs logged at the same time never write to the same folder.
The record in ``runs`` (run_id, run_name, model_key, version, started_at) is written last:
aside first, then renamed into place. Readers take the runs that have their record; what a
broken run left behind is never seen. Parameters are stringified and ``None`` values
dropped, like the reference's tracking calls. Each run is a handful of rows.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNS = "run_id string, run_name string, model_key string, version string, started_at timestamp"
_PARAMS = "k string, v string"
_METRICS = "name string, value double"


class RunLog:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.base, name))

    def _system(self):
        return self._path("runs").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _write(self, table: str, run_id: str, rows: list, schema: str) -> None:
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(self.base, table, f"run_id={run_id}"))

    def _commit(self, run_id: str, record: dict) -> None:
        fs, aside, final = self._system(), self._path(f"_aside/{run_id}.json"), self._path(f"runs/{run_id}.json")
        out = fs.create(aside, True)
        try:
            out.write(bytearray(json.dumps(record), "utf-8"))
        finally:
            out.close()
        fs.mkdirs(final.getParent())
        if not fs.rename(aside, final):
            raise OSError(f"run {run_id} could not be committed")

    def log_run(self, run_name: str, model_key: str, version: str, params: dict, metrics: dict,
                artifacts: dict | None = None) -> str:
        run_id = uuid.uuid4().hex
        now = dt.datetime.now(dt.timezone.utc)
        prm = [(str(k), str(v)) for k, v in params.items() if v is not None]
        prm += [(f"artifact.{k}", str(v)) for k, v in (artifacts or {}).items()]
        self._write("params", run_id, prm, _PARAMS)
        self._write("metrics", run_id, [(str(k), float(v)) for k, v in metrics.items() if v is not None], _METRICS)
        self._commit(run_id, {"run_id": run_id, "run_name": run_name, "model_key": model_key, "version": version,
                              "started_at": now.isoformat()})
        return run_id

    def _read(self, table: str, schema: str) -> DataFrame:
        if not self._system().exists(self._path(table)):
            return self.spark.createDataFrame([], f"run_id string, {schema}")
        rows = self.spark.read.schema(f"{schema}, run_id string").parquet(os.path.join(self.base, table))
        return rows.join(self.runs().select("run_id"), "run_id", "left_semi").select("run_id", *[c for c in rows.columns if c != "run_id"])

    def runs(self) -> DataFrame:
        if not self._system().exists(self._path("runs")):
            return self.spark.createDataFrame([], _RUNS)
        return self.spark.read.schema(_RUNS).json(os.path.join(self.base, "runs"))

    def params(self) -> DataFrame:
        return self._read("params", _PARAMS)

    def metrics(self) -> DataFrame:
        return self._read("metrics", _METRICS)
