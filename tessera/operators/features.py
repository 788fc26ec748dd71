"""Daily time-series features.

The daily frame has one row per (series, calendar day): its size is bounded
by the date range times the number of series, not by the number of sales
rows. Lag and rolling windows are partitioned by series and ordered by day.
``series`` is an optional list of key columns (the reference has one series).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import money_sum
from tessera.functions.windows import running_sum

# The model inputs, in order.
FEATURE_COLS = (
    "month", "quarter", "year", "day_of_week", "day_of_month", "is_weekend", "is_festive_month",
    "lag_1", "lag_2", "lag_3", "lag_7", "rolling_7_mean", "rolling_7_std", "rolling_30_mean",
    "price_mean", "discount_mean", "quantity_mean", "region_enc", "category_enc",
)
STRICT_FEATURE_COLS = FEATURE_COLS[:14]
CALENDAR_COLS = FEATURE_COLS[:7]
DAILY_MEASURES = ("total_sales", "n_orders", "price_mean", "discount_mean", "quantity_mean")


def daily(sales: DataFrame, date: str = "order_date", series: Sequence[str] = ()) -> DataFrame:
    """M1 + J2: per-day totals and means, calendar gaps filled with 0."""
    s = list(series)
    base = sales.where(F.col(date).isNotNull())
    agg = base.groupBy(*s, date).agg(
        money_sum(F.col("total_sales")).alias("total_sales"),
        F.count("order_id").alias("n_orders"),
        F.avg("unit_price").alias("price_mean"),
        # 2-dp rates: exact DECIMAL sum / count, independent of summation order
        (F.try_divide(F.sum(F.col("discount").cast("decimal(18,2)")).cast("double"), F.count("discount"))).alias("discount_mean"),
        F.avg("quantity").alias("quantity_mean"))
    # one row per series with its date range, exploded into the day spine
    rng = agg.groupBy(*s).agg(F.min(date).alias("d0"), F.max(date).alias("d1"))
    spine = rng.select(*s, F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias(date))
    out = spine.join(agg, [*s, date], "left").fillna(0, subset=list(DAILY_MEASURES))
    return out.withColumn("n_orders", F.col("n_orders").cast("long"))


def calendar(df: DataFrame, date: str = "order_date") -> DataFrame:
    """M2: month, quarter, year, day_of_week (Mon=0), day_of_month, flags."""
    d = F.col(date)
    return df.withColumns({
        "month": F.month(d), "quarter": F.quarter(d), "year": F.year(d),
        "day_of_week": F.weekday(d), "day_of_month": F.dayofmonth(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_festive_month": F.month(d).isin(10, 11, 12).cast("int"),
    })


def lags(df: DataFrame, value: str = "total_sales", ks=(1, 2, 3, 7), date: str = "order_date",
         series: Sequence[str] = ()) -> DataFrame:
    """M3: lag_k of the value (previous days in the same series)."""
    w = Window.partitionBy(*series).orderBy(date)
    return df.withColumns({f"lag_{k}": F.lag(value, k).over(w) for k in ks})


def rolling(df: DataFrame, value: str = "total_sales", date: str = "order_date",
            series: Sequence[str] = ()) -> DataFrame:
    """M4: mean / sample std over the previous 7 days, mean over the previous 30
    (the current day excluded); empty or single-value frames give 0."""
    w = Window.partitionBy(*series).orderBy(date)
    w7, w30 = w.rowsBetween(-7, -1), w.rowsBetween(-30, -1)
    return df.withColumns({
        "rolling_7_mean": F.avg(value).over(w7),
        "rolling_7_std": F.coalesce(F.stddev_samp(value).over(w7), F.lit(0.0)),
        "rolling_30_mean": F.avg(value).over(w30),
    })


def dominant(sales: DataFrame, key: str, out: str, date: str = "order_date",
             series: Sequence[str] = ()) -> DataFrame:
    """M5/T5: per day the key value with the largest revenue (ties: smallest
    value), encoded as its alphabetical rank among the dominating values."""
    s = list(series)
    rev = (sales.where(F.col(date).isNotNull() & F.col(key).isNotNull())
                .groupBy(*s, date, key).agg(money_sum(F.col("total_sales")).alias("rev")))
    top = rev.groupBy(*s, date).agg(F.min_by(key, F.struct(-F.col("rev"), F.col(key))).alias(key))
    # distinct dominating values: bounded by the key's domain
    codes = top.select(key).distinct().withColumn(
        out, (F.dense_rank().over(Window.orderBy(key)) - 1).cast("int"))
    return top.join(codes, key).select(*s, date, key, out)


def features(sales: DataFrame, date: str = "order_date", series: Sequence[str] = ()) -> DataFrame:
    """M6: daily + calendar + lags + rolling + encoders, nulls -> 0.

    A column that tells the series apart is constant within each: it gets no encoder.
    """
    d = daily(sales, date, series)
    d = rolling(lags(calendar(d, date), date=date, series=series), date=date, series=series)
    keys = [*series, date]
    for key, out in (("product_category", "category_enc"), ("region", "region_enc")):
        if key not in series:
            d = d.join(dominant(sales, key, out, date, series).drop(key), keys, "left")
    num = [c for c in d.columns if c not in keys]
    return d.fillna(0, subset=num)


def chrono_split(feat: DataFrame, train_frac: float = 0.8, date: str = "order_date",
                 series: Sequence[str] = ()) -> DataFrame:
    """M7: first floor(frac * n) days of each series are training rows.

    The spine is contiguous, so row i is day d0 + i: the cut is a date and no
    row numbering window is needed.
    """
    s = list(series)
    rng = feat.groupBy(*s).agg(F.min(date).alias("_d0"),
                               (F.datediff(F.max(date), F.min(date)) + 1).alias("_n"))
    cut = F.date_add(F.col("_d0"), F.floor(F.col("_n") * train_frac).cast("int"))
    if s:
        j = feat.join(rng, s)
    else:
        one = rng.select(F.struct("_d0", "_n").alias("r")).scalar()
        j = feat.withColumns({"_d0": one["_d0"], "_n": one["_n"]})
    return j.withColumn("is_train", F.col(date) < cut).drop("_d0", "_n")


def recent_history(feat: DataFrame, days: int = 90, date: str = "order_date",
                   series: Sequence[str] = ()) -> DataFrame:
    """The last ``days`` days of the historical daily series."""
    s = list(series)
    if s:
        last = feat.groupBy(*s).agg(F.max(date).alias("_last"))
        j = feat.join(last, s)
    else:
        j = feat.withColumn("_last", feat.agg(F.max(date)).scalar())
    return (j.where(F.col(date) > F.date_sub(F.col("_last"), days))
             .select(*s, date, "total_sales"))


# The reference's spend thresholds for loyalty tiers.
GOLD_SPEND = 50_000
SILVER_SPEND = 15_000


def loyalty_tier(sales: DataFrame, customer: str = "customer_id", order: str = "order_id",
                 date: str = "order_date") -> DataFrame:
    """Tier from each customer's cumulative spend up to and including an
    order (Gold >= 50,000, Silver >= 15,000, else Bronze).

    Orders are summed first (one row per order), then the running total uses
    ``running_sum`` so a customer holding a third of all orders is spread over
    many tasks.
    """
    per = (sales.where(F.col(customer).isNotNull())
                .groupBy(customer, order, date)
                .agg(F.sum(F.col("total_sales").cast("decimal(18,2)")).alias("spend")))
    cum = running_sum(per, "spend", [F.col(date), F.col(order)], "cum_spend", partition_by=[customer])
    tier = (F.when(F.col("cum_spend") >= GOLD_SPEND, "Gold")
             .when(F.col("cum_spend") >= SILVER_SPEND, "Silver").otherwise("Bronze"))
    return cum.select(customer, order, date, F.col("spend").cast("double").alias("order_spend"),
                      F.col("cum_spend").cast("double").alias("cum_spend"), tier.alias("loyalty_tier"))
