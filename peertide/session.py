"""Session settings, table access and durable cut points of the lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: What the engine expects of any session. Sizes of partitions are the cluster's business and are not set here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("peertide")
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    return (
        b.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per context: their Python workers then find it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_peertide_shipped", False):
        return
    here = Path(__file__).resolve().parent
    name = f"{tempfile.mkdtemp(prefix='peertide-')}/peertide-{uuid.uuid4().hex}.zip"  # only where the driver hands it out from
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    sc.addPyFile(name)
    sc._peertide_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). A local session without one gets a temporary folder; a
    cluster without one is an error, since a machine-local folder would be lost with its executor."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        set_to = sc.getConf().get("spark.checkpoint.dir")
        if not set_to:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            set_to = tempfile.mkdtemp(prefix="peertide-")
        sc.setCheckpointDir(set_to)
    return sc.getCheckpointDir()


def spread(df: DataFrame, per_core: int = 3) -> DataFrame:
    """df in at least `per_core` partitions for each core, for operators that spend seconds on each megabyte. Only an input of
    fewer partitions is moved, which is a small one; a large input stays where it was read."""
    wanted = per_core * df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.rdd().getNumPartitions() >= wanted else df.repartition(wanted)


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared folder, deleted when the session's JVM ends: results are read until then."""
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Written once as a table in the shared folder and read back: what follows no longer depends on the executors that
    computed it, and its plan knows the table's true size."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
