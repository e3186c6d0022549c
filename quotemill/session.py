"""Session settings shared by jobs, tests and the benchmark."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Decoding is bound by CPU, not bytes: keep small shuffles spread over the cores. Large ones
    # are still cut by the advisory size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Capture sources check header filters where they read.
    "spark.sql.python.filterPushdown.enabled": "true",
    # Frame rows are large (up to 16 MB each): bound Arrow batches by bytes too. A batch becomes
    # about thirty times its size in token arrays.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def staged(df: DataFrame, label: str, partition_by=()) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Python sources and decoders are recomputed by every branch of a plan that uses them; a written
    table is read with column pruning, and its shuffles are shared between branches.
    """
    folder = scratch_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(scan: DataFrame) -> DataFrame:
    """Repartition a table scan that has fewer partitions than the cluster has cores."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


_shipped = set()


def configure(spark: SparkSession) -> SparkSession:
    """Pin runtime settings and ship this package to the Python workers (once per session)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        spark.sparkContext.addPyFile(_package_zip())
        _shipped.add(app)
    return spark


def _package_zip() -> str:
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quotemill-"), "quotemill.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


_own: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    A session on one machine that names none gets a temporary folder of its own; a cluster must
    name one, as executors can't read each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="quotemill-")
    return _own[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for this application's intermediate tables; see ``clear_scratch``."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/quotemill-{app}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove this application's intermediate tables, once no result that reads them is needed."""
    drop_tables(spark)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/quotemill-{spark.sparkContext.applicationId}")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_tables(spark: SparkSession) -> None:
    """Take intermediate tables that were written by name out of the catalog; their names begin with quotemill_."""
    for found in spark.catalog.listTables(pattern="quotemill_*"):
        spark.sql(f"DROP TABLE IF EXISTS {found.name}")
