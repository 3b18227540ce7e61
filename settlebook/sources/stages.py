"""Stages of a close, written as versions and published in one step.

A stage is written to a fresh place; only when that write has ended does a
small manifest (a file that replaces its predecessor by a rename, or the view
that later stages read) point to it. A run that dies while it writes leaves the
former version as it was, and a reader sees the former or the new one, never a
mixture.

The manifest holds what the version was made from: a fingerprint of the period
and of the inputs, and the versions of the stages before it. ``resume`` goes on
from a stage only if all of that is the same now; another period, a changed
input file or an earlier stage made anew makes it computed again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, fields, is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_current.json"
# Stages with a row per (event, currency, ...) that later steps join on these keys.
JOINED_ON = ("event_id", "currency")
BUCKETED = ("itemized", "history", "merged", "parented", "net_sales", "payout_sums", "payout_level", "charge_sums", "event_level")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def input_fingerprint(df: DataFrame) -> str:
    """What ``df`` is read from: names, lengths and times of its files, and its
    plan's output columns. A frame that is not read from files (a literal list)
    is told by its rows, in one aggregate.

    Only file names and one status per file come to the driver (a table of 100 TB
    in files of 256 MB has 400,000), one listing per folder.
    """
    spark, said = df.sparkSession, hashlib.sha256(df.schema.json().encode())
    files = sorted(df.inputFiles())
    if not files:
        row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns)), F.sum(F.xxhash64(F.lit(1), *df.columns).cast("decimal(38,0)"))).first()
        said.update(repr(tuple(row)).encode())
    folders: dict[str, set[str]] = {}
    for f in files:
        head, _, name = f.rpartition("/")
        folders.setdefault(head, set()).add(name)
    for head, names in sorted(folders.items()):
        fs, p = _hadoop(spark, head)
        for s in fs.listStatus(p):
            if (name := s.getPath().toUri().getRawPath().rpartition("/")[2]) in names or s.getPath().getName() in names:
                said.update(f"{head}/{name} {s.getLen()} {s.getModificationTime()}\n".encode())
    return said.hexdigest()


def run_fingerprint(inputs, period, **more) -> str:
    """One digest of a run's inputs (a dataclass or mapping of DataFrames), its period and other settings."""
    tables: Mapping[str, DataFrame] = {f.name: getattr(inputs, f.name) for f in fields(inputs)} if is_dataclass(inputs) else inputs
    said = {"inputs": {name: input_fingerprint(df) for name, df in sorted(tables.items())},
            "period": asdict(period) if is_dataclass(period) else period, "more": more}
    return hashlib.sha256(json.dumps(said, sort_keys=True, default=str).encode()).hexdigest()


class StageStore:
    """Writes stages below the folder ``where`` or, with ``fmt="table"``, in the
    catalog database ``where``, and returns them as read back.

    ``stages`` names those to keep (None: all); others stay lazy. With
    ``resume``, leading stages that a former run has published from the same
    ``run`` (see :func:`run_fingerprint`) and the same earlier stages are read
    instead of computed; from the first other one on everything is made anew.

    Folders: ``{where}/{stage}/{version}/`` and ``{where}/{stage}/_current.json``.
    Tables: ``{stage}__{version}`` and the view ``{stage}`` over it, whose
    properties hold the manifest; ``buckets`` lays the stages that are joined on
    (event, currency) out by those keys, so that joining them moves no rows.
    ``keep`` former versions stay for readers that have begun; older ones go.
    """

    def __init__(self, spark: SparkSession, where: str, fmt: str = "parquet", stages=None, resume: bool = False, run: str = "",
                 buckets: int = 0, keep: int = 1):
        if buckets and fmt != "table":
            raise ValueError("buckets need catalog tables (fmt='table')")
        if resume and not run:
            raise ValueError("resume needs the run's fingerprint: stages of another period or other inputs must not be taken over")
        self.spark, self.where, self.fmt, self.stages, self.resume = spark, where.rstrip("/"), fmt, stages, resume
        self.run, self.buckets, self.keep = run, buckets, keep
        self.made: dict[str, str] = {}  # versions of the stages so far

    def _name(self, stage: str) -> str:
        if self.fmt == "table":
            return f"{self.where}.{stage}" if self.where else stage
        return f"{self.where}/{stage}"

    def manifest(self, stage: str) -> dict | None:
        """What the stage's current version is and was made from; None if there is none."""
        if self.fmt == "table":
            if not self.spark.catalog.tableExists(self._name(stage)):
                return None
            said = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self._name(stage)}").collect()}
            return json.loads(said["settlebook.manifest"]) if "settlebook.manifest" in said else None
        fs, p = _hadoop(self.spark, f"{self._name(stage)}/{MANIFEST}")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, stage: str) -> DataFrame:
        """The stage's current version."""
        now = self.manifest(stage)
        if now is None:
            raise FileNotFoundError(f"no stage {stage} has been published in {self.where}")
        if self.fmt == "table":
            return self.spark.table(f"{self._name(stage)}__{now['version']}")
        return self.spark.read.format(self.fmt).load(f"{self._name(stage)}/{now['version']}")

    def _publish(self, stage: str, now: dict, columns: list[str]) -> None:
        text = json.dumps(now, sort_keys=True)
        if self.fmt == "table":
            quoted = text.replace("\\", "\\\\").replace("'", "\\'")
            cols = ", ".join(f"`{c}`" for c in columns)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self._name(stage)} TBLPROPERTIES ('settlebook.manifest' = '{quoted}') "
                           f"AS SELECT {cols} FROM {self._name(stage)}__{now['version']}")
            return
        fs, fresh = _hadoop(self.spark, f"{self._name(stage)}/.{MANIFEST}.{now['version']}")
        _, final = _hadoop(self.spark, f"{self._name(stage)}/{MANIFEST}")
        out = fs.create(fresh, True)
        out.write(text.encode())
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fresh, final, options)

    def _drop(self, stage: str, version: str) -> None:
        if self.fmt == "table":
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(stage)}__{version}")
        else:
            fs, p = _hadoop(self.spark, f"{self._name(stage)}/{version}")
            fs.delete(p, True)

    def _write(self, stage: str, df: DataFrame, version: str) -> None:
        if self.fmt != "table":
            df.write.format(self.fmt).save(f"{self._name(stage)}/{version}")
            return
        w = df.write
        if self.buckets and stage in BUCKETED:
            # Dealt by the same hash as the buckets: one file per bucket, sorted for the merge join.
            w = df.repartition(self.buckets, *JOINED_ON).write.bucketBy(self.buckets, *JOINED_ON).sortBy(*JOINED_ON)
        w.saveAsTable(f"{self._name(stage)}__{version}")

    def __call__(self, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
        if self.stages is not None and stage not in self.stages:
            return make()
        former = self.manifest(stage)
        made_from = {"run": self.run, "after": dict(self.made)}
        self.resume = self.resume and former is not None and {k: former.get(k) for k in made_from} == made_from
        if self.resume:
            self.made[stage] = former["version"]
            return self.read(stage)
        version, df = uuid.uuid4().hex[:12], make()
        self._write(stage, df, version)
        before = ([former["version"], *former.get("before", [])] if former else [])
        self._publish(stage, {**made_from, "version": version, "before": before[:self.keep]}, df.columns)
        for old in before[self.keep:]:
            self._drop(stage, old)
        self.made[stage] = version
        return self.read(stage)
