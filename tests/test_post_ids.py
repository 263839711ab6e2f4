"""Posts whose ids need more than 32 bits."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyloom.sources.tables import posts
from tests.conftest import rows_of

# A multiple of 28, so that the days stay as they are.
SHIFT = 28 * 10**9


def shifted(spark, sf_dir, path):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents.withColumn("doc_id", F.col("doc_id") + SHIFT).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_rejects_of_large_ids(spark, sf_dir, tmp_path):
    query = contract.queries()["place_rejects_stream"]
    want = rows_of(query(spark, sf_dir))
    assert rows_of(query(spark, shifted(spark, sf_dir, tmp_path))) == want and len(want) > 0


def test_days_of_large_ids(spark, sf_dir, tmp_path):
    large = posts(spark, shifted(spark, sf_dir, tmp_path))
    want = rows_of(posts(spark, sf_dir).select("doc_id", "created_at"))
    assert rows_of(large.select(F.col("doc_id") - SHIFT, "created_at")) == want
