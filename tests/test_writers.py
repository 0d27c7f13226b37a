"""CTAS, INSERT SELECT, INSERT VALUES and bucketing."""

import tempfile

import pytest
from pyspark.sql import functions as F

from rillet.sources import fixtures as fx
from rillet.sources import writers as WR

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def place(spark):
    d = tempfile.mkdtemp(prefix="rillet-tables-", dir="/tmp")
    yield d
    for t in ("w_copy", "w_small", "w_buckets"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_create_and_insert(spark, place):
    t = fx.transactions(spark, SF).select("txn_id", "account_number", F.col("amount").cast("double").alias("amount"))
    copy = WR.create_table_as(t.where("amount > 100"), "w_copy", path=f"{place}/copy")
    assert copy.schema.names == t.columns and copy.count() == t.where("amount > 100").count()
    WR.insert_select(t.where("amount <= 100").select("amount", "txn_id", "account_number"), "w_copy")
    spark.catalog.refreshTable("w_copy")
    assert spark.table("w_copy").exceptAll(t).count() == 0 and spark.table("w_copy").count() == t.count()
    with pytest.raises(ValueError):
        WR.insert_select(t.drop("amount"), "w_copy")
    with pytest.raises(ValueError):
        WR.insert_select(t.withColumn("more", F.lit(1)), "w_copy")


def test_insert_values(spark, place):
    WR.create_table_as(spark.createDataFrame([(1, "a")], "id int, name string"), "w_small", path=f"{place}/small")
    WR.insert_values(spark, "w_small", [(2, "b"), (3, None)])
    spark.catalog.refreshTable("w_small")
    assert sorted(tuple(r) for r in spark.table("w_small").collect()) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError):
        WR.insert_values(spark, "w_small", [(4,)])
    with pytest.raises(Exception):
        WR.insert_values(spark, "w_small", [("x", "y")])


def test_buckets_spare_the_shuffle(spark, place):
    t = fx.transactions(spark, SF).select("txn_id", "account_number")
    b = WR.create_table_as(t, "w_buckets", path=f"{place}/buckets", buckets=6, bucket_cols=["account_number"])
    plan = b.groupBy("account_number").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert b.groupBy("account_number").count().count() == t.select("account_number").distinct().count()
