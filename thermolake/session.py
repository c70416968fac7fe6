"""Session settings that the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A local session; on a cluster the same SETTINGS are given to spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, with its scheme: spark.checkpoint.dir, or on one machine a temporary one where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        found = _own_dirs.setdefault(app, "") or tempfile.mkdtemp(prefix="thermolake-")
        _own_dirs[app] = found
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    whole = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return re.sub(r"^file:/+", "file:///", whole).rstrip("/")


def from_files(df: DataFrame) -> bool:
    """Whether rows come straight from files, so that _metadata tells where each one lies."""
    found = df._jdf.queryExecution().analyzed().metadataOutput()
    return any(found.apply(i).name() == "_metadata" for i in range(found.size()))


class Scratch:
    """Tables written once to the shared folder, so that a lost executor costs a re-read and not a re-computation."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, level: int = 3) -> DataFrame:
        df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(self.path(name))
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Deletes all tables but these: what is still to be read."""
        for name in self.names - set(names):
            self.drop(name)


#: Bytes of rows that go to a Python worker at once: texts differ in length by orders of magnitude, so rows are no measure.
ARROW_BATCH_BYTES = "4m"


def ship_path(spark: SparkSession) -> None:
    """Lets Python workers import this package where the driver found it outside its own PYTHONPATH, and bounds their batches by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
