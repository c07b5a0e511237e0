"""Business questions over the star schema (all partial+final aggregates).

Money is summed as ``decimal(38,6)`` and returned as double: totals do not
depend on the order partial sums are combined in and no amount is rounded to
cents first.  An amount beyond that type is left out of the sums and counted
by :func:`rejected_amounts`; it never aborts a report.

Reports that join a fact to a dimension pre-aggregate the fact by the join
key first (sums and counts are decomposable), so the dimension join sees
one row per key instead of every fact row, and a hot key is collapsed
map-side before any shuffle.  A dimension row repeated for a key repeats
the key's partial sums exactly as it would have repeated each fact row, so
results are unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(col: str) -> Column:
    return F.col(col).try_cast("decimal(38,6)")


def money_sum(col: str) -> Column:
    return F.sum(money(col)).cast("double")


def rejected_amounts(fact: DataFrame, amount: str) -> DataFrame:
    """Amounts that are there but beyond the money type, and all that are there."""
    return fact.agg(F.count_if(F.col(amount).isNotNull() & money(amount).isNull()).alias("qtd_rejeitados"),
                    F.count(amount).alias("qtd_valores"))


def ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """num * scale / den in double; null when den is 0."""
    return F.try_divide(num.cast("double") * F.lit(scale), den.cast("double"))


def kpis(fact_orders: DataFrame) -> DataFrame:
    """Net revenue, order count, average ticket, cancellation %."""
    return fact_orders.agg(
        money_sum("net_amount").alias("receita_liquida"),
        F.count(F.lit(1)).alias("qtd_pedidos"),
        ratio(F.sum(money("net_amount")), F.count(money("net_amount"))).alias("ticket_medio"),
        ratio(F.sum(F.col("is_cancelado").cast("int")), F.count(F.lit(1)), 100.0).alias("pct_cancelado"),
    )


def cancellation_rate(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.agg(
        F.count_if(F.col("is_cancelado")).alias("qtd_cancelados"),
        F.count(F.lit(1)).alias("qtd_pedidos"),
        ratio(F.count_if(F.col("is_cancelado")), F.count(F.lit(1)), 100.0).alias("pct_cancelado"),
    )


def late_rate(fact_orders: DataFrame) -> DataFrame:
    """Late share among orders whose lateness is known."""
    return fact_orders.agg(
        F.count("is_atrasado").alias("qtd_rastreados"),
        F.count_if(F.col("is_atrasado")).alias("qtd_atrasados"),
        ratio(F.count_if(F.col("is_atrasado")), F.count("is_atrasado"), 100.0).alias("pct_atrasado"),
    )


def revenue_by(fact: DataFrame, dim: DataFrame, on: str, group_cols: Sequence[str],
               amount: str = "net_amount", count_name: str = "qtd_pedidos") -> DataFrame:
    """fact LEFT JOIN dim on ``on``, grouped sum; a null group (no dimension
    match) is kept."""
    pre = fact.groupBy(on).agg(F.sum(money(amount)).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return (pre.join(dim, on, "left").groupBy(*group_cols)
               .agg(F.sum("_s").cast("double").alias("receita"), F.sum("_n").alias(count_name)))


def monthly_revenue(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    pre = fact_orders.groupBy("order_date_key").agg(F.sum(money("net_amount")).alias("_s"),
                                                    F.count(F.lit(1)).alias("_n"))
    joined = pre.join(dim_date, pre["order_date_key"] == dim_date["date_key"], "left")
    return joined.groupBy("year", "month").agg(F.sum("_s").cast("double").alias("receita"),
                                               F.sum("_n").alias("qtd_pedidos"))


def lead_time_by_carrier(fact_deliveries: DataFrame) -> DataFrame:
    return (fact_deliveries.where(F.col("lead_time_dias").isNotNull())
            .groupBy("carrier_name", "carrier_mode")
            .agg(F.avg("lead_time_dias").alias("lead_time_medio"),
                 F.count(F.lit(1)).alias("qtd_entregas")))


def item_customer_product(fact_items: DataFrame, dim_customer: DataFrame,
                          dim_product: DataFrame) -> DataFrame:
    # Few items share a customer and a product, so a pre-aggregate by both would move nearly every row and the joins
    # move it again.  Categories are few: products join first, the items' own columns being the narrowest rows, and
    # sums by customer and category, pre-counted in each task, meet the customers.
    # customer_id stays a grouping key, so the distinct customer count over these sums equals the one over items;
    # they lie by customer then, and the count needs no further shuffle of them.
    by_category = (fact_items.select("customer_id", "product_id", "total_item").join(dim_product, "product_id", "left")
                   .groupBy("customer_id", "category").agg(F.sum(money("total_item")).alias("_s"), F.count(F.lit(1)).alias("_n")))
    return (by_category.join(dim_customer, "customer_id", "left")
            .groupBy("segmento", "category")
            .agg(F.sum("_s").cast("double").alias("receita"),
                 F.sum("_n").alias("qtd_itens"),
                 F.countDistinct("customer_id").alias("qtd_clientes")))


def segment_kpis(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    pre = fact_orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(money("net_amount")).alias("_s"),
        F.count_if(F.col("is_atrasado")).alias("_late"), F.count("is_atrasado").alias("_tracked"),
        F.count_if(F.col("is_cancelado")).alias("_cancel"))
    return (pre.join(dim_customer, "customer_id", "left").groupBy("segmento")
            .agg(F.sum("_n").alias("qtd_pedidos"),
                 F.sum("_s").cast("double").alias("receita"),
                 ratio(F.sum("_late"), F.sum("_tracked"), 100.0).alias("pct_atrasado"),
                 ratio(F.sum("_cancel"), F.sum("_n"), 100.0).alias("pct_cancelado")))
