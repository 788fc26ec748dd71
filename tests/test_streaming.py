import os
import tempfile

from pyspark.sql import functions as F

from test_clean import ROWS, SCHEMA
from tessera.streaming.clean_stream import clean_rows


def test_stateless_steps_on_a_stream(spark):
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    batch = spark.createDataFrame(ROWS, SCHEMA).withColumn("return_flag", F.lit(False))
    batch.write.mode("overwrite").parquet(os.path.join(src, "part1"))
    stream = spark.readStream.schema(batch.schema).parquet(os.path.join(src, "part1"))
    fills = {"age": 37.5, "unit_price": 17.5, "customer_rating": 4.0, "shipping_days": 2.5,
             "gender": "Female", "payment_method": "UPI", "region": "East", "city": "Bengaluru",
             "order_date": None}
    out = clean_rows(stream, {k: v for k, v in fills.items() if v is not None}, {"unit_price": (0.0, 50.0)})
    q = (out.writeStream.format("memory").queryName("clean_stream_test").outputMode("append")
            .option("checkpointLocation", tempfile.mkdtemp(prefix="tessera-stream-ckpt-")).start())
    q.processAllAvailable()
    q.stop()
    rows = spark.sql("SELECT * FROM clean_stream_test").collect()
    assert len(rows) == 6
    assert all(r["quantity"] >= 0 for r in rows)
    assert {r["gender"] for r in rows} == {"Male", "Female", "InvalidGender"}
    assert max(r["unit_price"] for r in rows) == 50.0
    assert all(r["customer_rating"] is None or 1 <= r["customer_rating"] <= 5 for r in rows)
