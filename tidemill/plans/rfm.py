"""Customer value: recency, frequency and monetary scores, segments and their profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import mean
from tidemill.functions.rules import rfm_segment
from tidemill.operators.quantiles import quintile_scores
from tidemill.session import settled


def rfm(t, d=None) -> DataFrame:
    """Days since the last purchase (counted from the day after the newest one), purchases, amount per customer."""
    rows = t["transactions"]
    newest = rows.agg(F.max(F.to_date("transaction_date")).alias("m")).select("m").scalar()
    return rows.groupBy("customer_id").agg(
        F.max(F.to_date("transaction_date")).alias("_last"), F.count("transaction_id").alias("frequency"),
        F.sum("transaction_amount").alias("monetary")).withColumn(
        "recency", F.datediff(F.date_add(newest, 1), F.col("_last"))).drop("_last")


def rfm_scores(t, d=None) -> DataFrame:
    """Quintile scores (5 is best), their sum and the segment.

    The per-customer table is written once: three quantile searches and the scoring read it instead of the sales.
    """
    table = settled(rfm(t, d), "rfm")
    scored = quintile_scores(table, {"r_score": ("recency", True), "f_score": ("frequency", False),
                                     "m_score": ("monetary", False)})
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumn("rfm_total_score", r + f + m).withColumn("segment", rfm_segment(r, f, m))


def segment_profile(t, d=None) -> DataFrame:
    """Customers and mean scores per segment."""
    scored = t["rfm_scores"]
    n = F.count(F.lit(1))
    return scored.groupBy("segment").agg(
        n.alias("customers"), *[mean(F.sum(f"{x}_score"), n).alias(f"avg_{x}_score") for x in "rfm"])
