"""Tables that an operator writes for itself, to read them more than once or to end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where it is unset, a temporary one on a single machine
    (tests); on a cluster, where executors do not share such a folder, an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Spark's setting by which the shuffle files of a query go when it ends; else they stay until the driver's garbage is collected.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save(df: DataFrame, name: str, spark: SparkSession | None = None, clean: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again: lineage ends there.

    Reads after a lost executor come from the written table, never from executor memory. ``spark``: the session that
    reads it; a stream's batch has a session without adaptive plans, which its further work need not share. ``clean``:
    what the write shuffled leaves the disks once the table is written.
    """
    spark = spark or df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    own = df.sparkSession.conf
    before = own.get(CLEAN, None)
    if clean:
        own.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if clean:
            own.unset(CLEAN) if before is None else own.set(CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``save`` that nothing will read again. Those that a result still reads are left to the
    owner of the shared folder."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.work_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
