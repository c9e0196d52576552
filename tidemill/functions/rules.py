"""Rule texts and codes of promotions, and the customer segments of the RFM report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Promotion type codes and the wording of their benefit texts.
SPEND_AND_SAVE, BUY_AND_SAVE, PLAIN_DISCOUNT = "3101", "3102", "3103"
SPEND_COUPON, BUY_COUPON, CASH_COUPON = "3201", "3202", "3203"


def _spend(c) -> Column:
    return F.concat(F.lit("满"), c("condition_amount"), F.lit("元减"), c("benefit_amount"), F.lit("元"))


def _buy(c) -> Column:
    return F.concat(F.lit("满"), c("condition_num"), F.lit("件打"), c("benefit_discount"), F.lit(" 折"))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def activity_benefit(code: Column) -> Column:
    """Benefit wording of an activity rule; unknown codes give null."""
    return (F.when(code == SPEND_AND_SAVE, _spend(_text))
            .when(code == BUY_AND_SAVE, _buy(_text))
            .when(code == PLAIN_DISCOUNT, F.concat(F.lit("打"), _text("benefit_discount"), F.lit("折"))))


def coupon_benefit(code: Column) -> Column:
    """Benefit wording of a coupon; unknown codes give null."""
    return (F.when(code == SPEND_COUPON, _spend(_text))
            .when(code == BUY_COUPON, _buy(_text))
            .when(code == CASH_COUPON, F.concat(F.lit("减"), _text("benefit_amount"), F.lit("元"))))


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Customer segment of a score triple; the first matching rule wins. Names are fixed values."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "高价值客户")
            .when((r >= 3) & (f >= 4) & (m >= 3), "忠诚客户")
            .when((r >= 4) & (f <= 3) & (m >= 4), "潜力客户")
            .when((r <= 2) & (f >= 3) & (m >= 3), "流失预警客户")
            .when(r.between(3, 4) & f.between(2, 3) & m.between(2, 3), "一般维持客户")
            .otherwise("低价值客户"))
