"""Staging shapes shared by several registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def money(c) -> "F.Column":
    return F.col(c).cast(MONEY)


def customer_daily(orders: DataFrame) -> DataFrame:
    """Daily liquidity per customer: exact DECIMAL sum of order totals and the
    order count -- pre-aggregated so later windows see one row per day."""
    return (orders
            .groupBy("o_custkey", F.to_date("o_orderdate").alias("trade_date"))
            .agg(F.sum(money("o_totalprice")).cast(MONEY_SUM).alias("value_total"),
                 F.count(F.lit(1)).alias("num_trades")))
