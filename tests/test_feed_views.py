"""Feeds made of the test tables are dealt over tasks before their rows become long texts."""

import gzip
import json

from pyspark.sql import functions as F

from riskspark.plans import queries, views


def _orders(spark, path):
    orders = spark.range(1200).select(
        F.when(F.col("id") != 7, F.col("id")).alias("o_orderkey"),
        (F.col("id") % 50).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit("1-URGENT").alias("o_orderpriority"),
        F.lit("1995-01-01").cast("date").alias("o_orderdate"),
    )
    orders.coalesce(1).write.parquet(f"{path}/orders.parquet")


def test_orders_are_joined_before_they_are_text(spark, tmp_path, capsys):
    _orders(spark, tmp_path)
    files = views.order_feed_files(spark, str(tmp_path))
    files.explain()
    plan = capsys.readouterr().out
    # one shuffle, of the orders
    assert plan.count("Exchange") == 1 and "get_json_object" not in plan
    texts = [json.loads(row.value)["vulnerabilities"] for row in files.collect()]
    assert sorted(map(len, texts)) == [1, 200, 499, 500]
    single = views.order_feed_lines(spark, str(tmp_path)).collect()
    alone = [json.dumps(json.loads(row.value)["vulnerabilities"][0], sort_keys=True) for row in single]
    assert sorted(alone) == sorted(json.dumps(record, sort_keys=True) for text in texts for record in text)


def test_wide_records_are_made_by_many_tasks(spark, tmp_path):
    spark.range(300).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    tasks = views.wide_feed_lines(spark, str(tmp_path)).select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1


def test_wide_feed_takes_little_disk_in_files_of_few_records(spark, tmp_path, monkeypatch):
    keys = [290 * k + k % 3 for k in range(450)]
    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: f"{tmp_path}/feed")
    monkeypatch.setattr(queries, "WIDE_RECORDS_PER_FILE", 60)
    found = {tuple(row) for row in queries.cpe_fields_wide(spark, str(tmp_path)).collect()}
    sizes = {k: k % 290 + 11 for k in keys}
    assert found == {(f"CVE-{k}", 60, n, 60 * n, 59000 + n - 1) for k, n in sizes.items()}
    files = list((tmp_path / "feed").glob("*.gz"))
    assert files and not list((tmp_path / "feed").glob("*.txt"))
    texts = [gzip.decompress(file.read_bytes()) for file in files]
    assert sum(text.count(b"\n") for text in texts) == 450 and max(text.count(b"\n") for text in texts) <= 60
    assert 5 * sum(file.stat().st_size for file in files) < sum(map(len, texts))
