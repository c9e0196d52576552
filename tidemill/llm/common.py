"""Small pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


BATCH = 500  # rows per Arrow batch: whole texts travel, so many rows at once would fill a worker's memory


def ready(spark: SparkSession) -> SparkSession:
    """Before Python runs on the workers: they can import this package, and batches are small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Only A-Z change: ``lower`` would also fold other letters."""
    return F.translate(c, UPPER, LOWER)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names close to the wanted ones that ``df`` does not have, whatever its extra columns are called."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def q(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")
