"""Session defaults and the one place that decides where intermediate tables live."""

from __future__ import annotations

import contextlib
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on; all may be changed after the session exists.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join input even where the split costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # sizes are judged from compressed files; without this a fact table looks small enough to broadcast
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a query goes on from its last batch: the state of older ones need not be kept
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def local_session(cores: str = "8", name: str = "tidemill", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``. A scratch one is chosen for a local master only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidemill-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str = "settled", **options: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives lost executors because the files are shared. ``options`` are those of the writer."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def forget(*frames: DataFrame) -> None:
    """Remove the files of :func:`settled` frames that nothing reads any more; other frames have none."""
    for df in frames:
        if hasattr(df, "settled_at"):
            remove(df.sparkSession, df.settled_at)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside only."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_removed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """What is executed inside removes its shuffle files when it ends, not when the driver happens to collect garbage. For writes: a frame that
    is executed again would have to shuffle again."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver was started. Once per application."""
    context = spark.sparkContext
    if getattr(context, "_tidemill_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="tidemill-package-")) / "tidemill_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    context._tidemill_shipped = True
