"""Intermediate tables in the shared folder that the session names.

``spark.checkpoint.dir`` is the one folder every executor and the driver can
reach. Intermediate results are written there as Parquet and read again, which
cuts lineage (a lost executor re-reads files, it does not recompute the job),
freezes generated row ids, and gives column pruning to later readers.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="settlebook-llm-")


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a local session without the
    setting (tests, a laptop) gets a folder of its own, a cluster session
    without it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = _own_dir()
    return path.rstrip("/")


def bounded_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """From now on the session's Arrow batches hold at most about ``most`` bytes
    (one row at least), unless it has a bound of its own: by default only rows
    are counted, and 10,000 long texts are hundreds of megabytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, str(2**31 - 1)).rstrip("b")) >= 2**31 - 1:
        spark.conf.set(name, str(most))


class Scratch:
    """A fresh folder below the shared one; ``save`` writes a table and reads it back."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        schema = df.schema
        self.names.add(name)
        df.write.option("compression", codec).parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def keep_only(self, *names: str) -> None:
        """Remove all tables but ``names``: what is left when an operator has
        worked through its eager part and its result reads only those."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in self.names - set(names):
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)
        self.names &= set(names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
