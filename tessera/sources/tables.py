"""Scans of the star-schema tables and the two sales views built on them.

The reference works on one flat retail fact table. Over the test tables the
same roles are played by real columns of lineitem / orders / customer / part /
nation / region (SURVEY section 7.2):

    order_id o_orderkey          customer_id o_custkey      customer_name c_name
    age p_size                   gender o_orderstatus       city, state n_name
    region r_name                loyalty_tier c_mktsegment  product_category p_type
    product_name p_name          quantity l_quantity        unit_price extendedprice/quantity
    discount l_discount          order_date o_orderdate     payment_method o_orderpriority
    customer_rating 1+tax*50     return_flag returnflag='R' shipping_days ship - order days

``sales`` is the clean 24-column frame; ``sales_raw`` is the 20-column raw
frame with deterministic defects (nulls, bad dates, respelled categories,
padding, negative quantities, out-of-range ratings) so that every cleaning
step has work to do, and about 3 % of its rows twice. No row is dropped: the
dimensions are left-joined.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import round_money

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Session setting with a number of partitions for the fact scan: for tables whose files
#: are fewer than the cores (a table of one row group is read by one task). Unset, the
#: scan keeps the splits that spark.sql.files.* give it.
SCAN_PARTITIONS = "spark.tessera.scanPartitions"


def spread(df: DataFrame) -> DataFrame:
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


#: Bytes of the lineitem files for a partition of the raw view: about 250,000 rows, whatever the table's size.
RAW_PARTITION_BYTES = 4 << 20


def _file_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Size of a table's files, by the file system's own listing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


#: Bytes of the lineitem files from which the raw view is made in a further share, and the most shares: each of them
#: scans the tables, so that their number does not grow with the table's size.
SHARE_BYTES, SHARES = 64 << 20, 4


def _even(df: DataFrame, key: str, spark: SparkSession, sf_dir: str, shares: int = 1) -> DataFrame:
    """``df`` dealt by ``key`` to a number of partitions that grows with lineitem.

    Rows get wide behind the last join, and are grouped whole when copies are
    removed. The planner's own partitions are as large as the narrow rows
    before the join allow, so a task would hold a million wide rows. A table of
    a few partitions' worth is left to the planner.
    """
    n = -(-_file_bytes(spark, sf_dir, "lineitem") // (RAW_PARTITION_BYTES * shares))
    if n <= 8:
        return df
    return df.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def _joined(spark: SparkSession, sf_dir: str, even: bool = False, share: int = 0, shares: int = 1) -> DataFrame:
    """lineitem x part, with orders x customer x nation x region.

    The dimensions are joined to the side that holds their key, so a line is
    shuffled by its part and by its order only, never by its customer. Big and
    mid-size tables are left to the planner: sort-merge joins on their keys, or
    AQE broadcast when the runtime size is under the threshold. nation and
    region are fixed-size reference tables (25 and 5 rows in TPC-H at every
    scale), so broadcasting them is bounded. ``even`` bounds the rows of a
    partition behind the last join. Of several ``shares``, which deal the lines by
    order, the one numbered ``share`` is joined; the planner infers that of the orders.
    """
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate"))
    li = li.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(shares)) == share) if shares > 1 else li
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    re = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(na.join(F.broadcast(re), na.n_regionkey == re.r_regionkey))
    # left joins: an order line without its order, customer, part or nation stays, with nulls
    lines = li.join(pa, li.l_partkey == pa.p_partkey, "left")
    lines = _even(lines, "l_orderkey", spark, sf_dir, shares) if even else lines
    orders = od.join(cu, od.o_custkey == cu.c_custkey, "left").join(geo, cu.c_nationkey == geo.n_nationkey, "left")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")


def _rating() -> Column:
    # 1.0 .. 5.0 in half steps from l_tax 0.00 .. 0.08
    return F.lit(1.0) + F.rint(F.col("l_tax") * 100) / 2


def _ship_days() -> Column:
    return F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean 24-column sales frame (the shape the cleaning step produces)."""
    j = _joined(spark, sf_dir)
    unit_price = F.col("l_extendedprice") / F.col("l_quantity")
    qty = F.col("l_quantity").cast("int")
    d = F.to_date("o_orderdate")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("p_size").alias("age"),
        F.col("o_orderstatus").alias("gender"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("loyalty_tier"),
        F.col("p_type").alias("product_category"),
        F.col("p_name").alias("product_name"),
        qty.alias("quantity"),
        unit_price.alias("unit_price"),
        F.col("l_discount").alias("discount"),
        round_money(unit_price * qty * (1 - F.col("l_discount"))).alias("total_sales"),
        d.alias("order_date"),
        F.col("o_orderpriority").alias("payment_method"),
        _rating().alias("customer_rating"),
        (F.col("l_returnflag") == "R").alias("return_flag"),
        _ship_days().alias("shipping_days"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
    )


#: Of a row of ``raw_shares``: its order_id, and the line's own key where there is no such order.
LINE_ORDER = "_line_order"

#: The spellings that the cleaning step maps, one defect each.
SPELLINGS = ("male", "m", "MALE", "M", "female", "f", "FEMALE", "F", "N/A")


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw 20-column frame with deterministic defects, one row per lineitem and
    a second copy of every 33rd."""
    return _raw_rows(_joined(spark, sf_dir, even=True))


def raw_shares(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The rows of ``sales_raw`` in a few frames, with the order key of the line in ``LINE_ORDER``.

    Rows of one order are in one frame and there in one partition, as the join left them."""
    n = max(1, min(SHARES, -(-_file_bytes(spark, sf_dir, "lineitem") // SHARE_BYTES)))
    return [_raw_rows(_joined(spark, sf_dir, True, i, n), F.col("l_orderkey").alias(LINE_ORDER)) for i in range(n)]


def _raw_rows(j: DataFrame, *more: Column) -> DataFrame:
    k, ck = F.col("l_orderkey"), F.col("o_custkey")
    kl = F.col("l_orderkey") + F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    gender = F.when(F.col("o_orderstatus") == "F", "Female").otherwise("Male")
    spelled = F.when(ck % 25 == 1, None)
    for i, x in enumerate(SPELLINGS):
        spelled = spelled.when(kl % 9001 == i + 1, x)
    rows = j.select(
        F.col("o_orderkey").alias("order_id"),
        ck.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(ck % 20 == 3, None).when(kl % 3001 == 5, F.lit(400.0))
         .otherwise(F.col("p_size").cast("double")).alias("age"),
        spelled.when(ck % 10 == 5, F.concat(F.lit(" "), gender)).otherwise(gender).alias("gender"),
        F.when(k % 50 == 7, None).otherwise(F.col("n_name")).alias("city"),
        F.col("n_name").alias("state"),
        F.when(k % 33 == 5, None).otherwise(F.col("r_name")).alias("region"),
        F.when(ck % 3 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("loyalty_tier"),
        F.when(kl % 40 == 0, F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
         .otherwise(F.col("p_type")).alias("product_category"),
        F.col("p_name").alias("product_name"),
        F.when(kl % 9973 == 1, -qty).otherwise(qty).alias("quantity"),
        F.when(kl % 50 == 3, None).when(kl % 5003 == 7, F.lit(0.0)).when(kl % 5003 == 8, F.lit(-5.0))
         .when(kl % 4001 == 12, price * 50).otherwise(price).alias("unit_price"),
        F.when(kl % 33 == 4, None).when(kl % 5003 == 9, F.lit(1.5)).otherwise(F.col("l_discount")).alias("discount"),
        F.col("l_extendedprice").alias("total_sales"),
        F.when(k % 15013 == 11, F.lit("99/99/9999"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.when(k % 25 == 6, None).otherwise(F.col("o_orderpriority")).alias("payment_method"),
        F.when(kl % 14 == 2, None)
         .when(kl % 9967 == 9, F.lit(6.0))
         .when(kl % 9967 == 10, F.lit(0.0))
         .when(kl % 9967 == 11, F.lit(-1.0))
         .otherwise(_rating()).alias("customer_rating"),
        (F.col("l_returnflag") == "R").alias("return_flag"),
        F.when(kl % 50 == 8, None).otherwise(_ship_days().cast("double")).alias("shipping_days"),
        (kl % 33 == 0).alias("_twice"),
        *more,
    )
    # the copies are exploded behind the one join
    copies = F.explode(F.when(F.col("_twice"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    return rows.select("*", copies).drop("_twice", "_copy")
