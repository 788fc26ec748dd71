"""Business marts behind the reports and dashboards.

All are single-pass hash aggregations with map-side partial aggregation, so a
hot group key (one region holding a third of the rows) is pre-combined in every
task before the shuffle. Windows used here run over the already-aggregated,
bounded result (categories, years), never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import money_sum, round_half_even
from tessera.operators.stats import dense
from tessera.session import materialize


def _share(col: str, digits: int = 2):
    # share of the (bounded, aggregated) total
    return round_half_even(F.try_divide(F.col(col), F.sum(col).over(Window.partitionBy())) * 100, digits)


def kpis(sales: DataFrame) -> DataFrame:
    """Headline KPIs in one global aggregate."""
    distinct = F.countDistinct("customer_name")
    return sales.agg(
        money_sum(F.col("total_sales")).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        round_half_even(F.avg("total_sales"), 2).alias("avg_order_value"),
        round_half_even(F.avg("customer_rating"), 2).alias("avg_rating"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        distinct.alias("unique_customers"),
    )


#: log2 of the buckets of a customer sketch: 16 KB for each, standard error 0.8 %.
SKETCH_BITS = 14


def customer_sketches(sales: DataFrame, date: str = "order_date", group: str = "region", customer: str = "customer_id") -> DataFrame:
    """A15 as mergeable state: one HLL sketch of the customers of each month and group (month, group, sketch).

    Stored once, it gives the distinct customers of any roll-up by a union of
    sketches, and a new month only adds rows; a customer never is counted twice.
    """
    base = sales.where(F.col(date).isNotNull() & F.col(group).isNotNull() & F.col(customer).isNotNull())
    return base.groupBy(F.trunc(date, "month").alias("month"), F.col(group).alias("group")).agg(
        F.hll_sketch_agg(customer, SKETCH_BITS).alias("sketch"))


def estimate_customers(sketches: DataFrame, by=()) -> DataFrame:
    """Distinct customers of each combination of ``by`` (of month and group), from the united sketches."""
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by).agg(united.alias("customers")) if by else sketches.agg(united.alias("customers")).where("customers IS NOT NULL")


def sketch_error(bits: int = SKETCH_BITS, deviations: float = 4.0) -> float:
    """Relative error of a united sketch at so many standard errors (1.04 over the root of its buckets)."""
    return deviations * 1.04 / 2 ** (bits / 2)


def distinct_customers(sales: DataFrame, date: str = "order_date", group: str = "region", customer: str = "customer_id") -> DataFrame:
    """Distinct customers by month, by group and in all: the exact number, and whether the sketches' is within its bound.

    (level, month, group, customers, within). The exact number takes one
    shuffle of the distinct (month, group, customer); the sketches' roll-ups read
    the stored sketches alone.
    """
    stored = materialize(customer_sketches(sales, date, group, customer))
    base = materialize(sales.where(F.col(date).isNotNull() & F.col(group).isNotNull() & F.col(customer).isNotNull()).select(
        F.trunc(date, "month").alias("month"), F.col(group).alias("group"), F.col(customer).alias("customer")).distinct())
    out = None
    for level, by in (("month_group", ["month", "group"]), ("month", ["month"]), ("group", ["group"]), ("all", [])):
        exact = base.select(*by, "customer").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.lit(level))
        about = estimate_customers(stored, by).withColumn("level", F.lit(level)).withColumnRenamed("customers", "e")
        both = exact.join(about, ["level", *by])
        bound = F.greatest(F.lit(1.0), F.col("n") * sketch_error())
        part = both.select("level", *[F.col(c) if c in by else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in ("month", "group")],
                           F.col("n").alias("customers"), (F.abs(F.col("e") - F.col("n")) <= bound).alias("within"))
        out = part if out is None else out.unionByName(part)
    return out


def revenue_by(sales: DataFrame, key: str) -> DataFrame:
    """Revenue per key; pandas group-by drops null keys, so we do too."""
    return (sales.where(F.col(key).isNotNull())
                 .groupBy(key).agg(money_sum(F.col("total_sales")).alias("revenue")))


def top_entities(sales: DataFrame, dims=("region", "product_category", "product_name")) -> DataFrame:
    """Argmax of revenue per dimension, ties to the smallest key.

    One scan: GROUPING SETS expands each row once per dimension, then a second
    small aggregate picks the maximum per dimension.
    """
    cols = [F.col(d).cast("string") for d in dims]
    gs = (sales.groupingSets([[d] for d in dims], *dims)
                .agg(money_sum(F.col("total_sales")).alias("revenue"),
                     F.grouping_id().alias("gid")))
    n = len(dims)
    dim_name = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))  # only column i is grouped
        dim_name = F.when(F.col("gid") == gid, F.lit(d)).otherwise(dim_name)
        key = F.when(F.col("gid") == gid, cols[i]).otherwise(key)
    keyed = gs.select(dim_name.alias("dimension"), key.alias("top_value"), "revenue").where(
        F.col("top_value").isNotNull())
    order = F.struct(-F.col("revenue"), F.col("top_value"))
    return keyed.groupBy("dimension").agg(
        F.min_by("top_value", order).alias("top_value"),
        F.max("revenue").alias("revenue"))


def yearly_growth(sales: DataFrame) -> DataFrame:
    """Revenue per year and growth of each year against the first one."""
    y = revenue_by(sales, "year")
    w = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.first("revenue").over(w), F.last("revenue").over(w)
    return y.select(
        "year", "revenue",
        round_half_even(F.try_divide(F.col("revenue") - first, first) * 100, 2).alias("pct_vs_first"),
        round_half_even(F.try_divide(last - first, first) * 100, 1).alias("growth_last_vs_first"))


def regional(sales: DataFrame) -> DataFrame:
    """Revenue, orders, average rating per region."""
    return (sales.where(F.col("region").isNotNull()).groupBy("region")
                 .agg(money_sum(F.col("total_sales")).alias("revenue"),
                      F.count("order_id").alias("orders"),
                      round_half_even(F.avg("customer_rating"), 2).alias("avg_rating"))
                 .orderBy(F.desc("revenue"), "region"))


def loyalty(sales: DataFrame) -> DataFrame:
    """Orders and revenue per loyalty tier."""
    return (sales.where(F.col("loyalty_tier").isNotNull()).groupBy("loyalty_tier")
                 .agg(F.count("order_id").alias("orders"),
                      money_sum(F.col("total_sales")).alias("revenue"))
                 .orderBy(F.desc("revenue"), "loyalty_tier"))


def category_share(sales: DataFrame) -> DataFrame:
    """Revenue, share of total and average order value per category."""
    agg = (sales.where(F.col("product_category").isNotNull()).groupBy("product_category")
                .agg(money_sum(F.col("total_sales")).alias("revenue"),
                     round_half_even(F.avg("total_sales"), 2).alias("avg_order_value")))
    return agg.select("product_category", "revenue", _share("revenue").alias("share_pct"),
                      "avg_order_value")


def monthly(sales: DataFrame) -> DataFrame:
    """Revenue by year and month, calendar order."""
    return (sales.where(F.col("year").isNotNull() & F.col("month").isNotNull())
                 .groupBy("year", "month", "month_name")
                 .agg(money_sum(F.col("total_sales")).alias("revenue"))
                 .orderBy("year", "month"))


def split(sales: DataFrame, key: str, with_aov: bool = False) -> DataFrame:
    """Value counts with percent share (and mean sale)."""
    aggs = [F.count(F.lit(1)).alias("orders")]
    if with_aov:
        aggs.append(round_half_even(F.avg("total_sales"), 2).alias("avg_order_value"))
    agg = sales.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    return agg.select(key, "orders", _share("orders").alias("share_pct"),
                      *(["avg_order_value"] if with_aov else []))


def quarter_yoy(sales: DataFrame) -> DataFrame:
    """Revenue by (year, quarter 1-4), missing quarters as 0, percent vs
    the first year's same quarter."""
    yq = (sales.where(F.col("year").isNotNull()).groupBy("year", "quarter")
               .agg(money_sum(F.col("total_sales")).alias("rev")))
    spine = (yq.select("year").distinct()
               .select("year", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("quarter")))
    full = (spine.join(yq, ["year", "quarter"], "left")
                 .select("year", "quarter", F.coalesce("rev", F.lit(0.0)).alias("revenue")))
    w = Window.partitionBy("quarter").orderBy("year")
    first = F.first("revenue").over(w)
    return full.select(
        "year", "quarter", "revenue",
        F.when(first > 0, round_half_even((F.col("revenue") - first) / first * 100, 1))
         .alias("pct_vs_first_year"))


def region_category(sales: DataFrame) -> DataFrame:
    """Region x category revenue, dense (missing pairs are 0), long format."""
    base = sales.where(F.col("region").isNotNull() & F.col("product_category").isNotNull())
    cells = base.groupBy("region", "product_category").agg(money_sum(F.col("total_sales")).alias("revenue"))
    return dense(base, cells, "region", "product_category", "revenue", 0.0)


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    """Top-n products by revenue (TakeOrderedAndProject, no full sort)."""
    rev = revenue_by(sales, "product_name")
    top = rev.orderBy(F.desc("revenue"), F.asc("product_name")).limit(n)
    w = Window.orderBy(F.desc("revenue"), F.asc("product_name"))
    return top.select(F.row_number().over(w).alias("rank"), "product_name", "revenue")
