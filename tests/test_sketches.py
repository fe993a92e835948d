"""Distinct orders over longer spans, from the sketches of windows."""

from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators import stats

DAY = 86_400_000


def test_a_days_orders_from_windows(spark, tmp_path):
    """Orders come in several windows and under several skus; a third have one sku."""
    tags = list(schemas.PRODUCT_ORDER_COUNTS.values())
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("bigint").alias("sku_id"),
        (F.col("id") * 6151 % (2 * DAY)).alias("ts"),
        (F.col("id") * 7919 % 20_011).alias("order_id"),
        F.element_at(F.array(*map(F.lit, tags)), (F.col("id") % len(tags) + 1).cast("int")).alias("tag"),
    )
    nothing = rows.limit(3).select("sku_id", "ts", F.lit(None).cast("bigint").alias("order_id"), "tag")
    measures = rows.unionByName(nothing)
    stats.order_sketches(measures, "1 hour").write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    day = F.substring("stt", 1, 10).alias("day")
    for keys, own in (((day,), ["day"]), ((day, "sku_id"), ["day", "sku_id"])):
        found = {tuple(r[k] for k in own): r for r in stats.distinct_orders(stored, *keys).collect()}
        dated = measures.withColumn("day", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd"))
        exact = dated.groupBy(*own).agg(
            *[F.count_distinct(F.when(F.col("tag") == t, F.col("order_id"))).alias(n)
              for n, t in schemas.PRODUCT_ORDER_COUNTS.items()]
        ).collect()
        assert len(exact) == len(found) and len(exact) >= 2
        for r in exact:
            got = found[tuple(r[k] for k in own)]
            for name in schemas.PRODUCT_ORDER_COUNTS:
                assert abs(got[name] - r[name]) <= 0.02 * r[name], (name, got[name], r[name])


def test_no_orders(spark):
    empty = spark.createDataFrame([], "sku_id long, ts long, order_id long, tag string")
    assert stats.distinct_orders(stats.order_sketches(empty), "sku_id").count() == 0
