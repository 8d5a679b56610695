"""Personal data: trees and threshold come from all documents, which are scanned once."""

import math

import pytest
from pyspark.sql import functions as F

from terraloom.llm import pii


def test_fit_counts_every_document(spark):
    """One candidate a text, one in 300 a validated phone number, over 40,000 texts."""
    text = F.when(F.col("doc_id") % 300 == 7, "call +12 345 678 90 now").otherwise("order 12345678 now")
    df = spark.range(41_000).withColumnRenamed("id", "doc_id").withColumn("text", text)
    teach = df.where(pii.fold(F.col("doc_id")) == 0)
    n, p = teach.count(), teach.where("doc_id % 300 = 7").count()
    trees, threshold = pii.fit(df)
    assert trees[0][2] == pytest.approx((math.log((p + 0.5) / (n - p + 0.5)),) * 4, rel=1e-12)
    assert threshold is not None


def test_table_of_one_scan(spark):
    texts = ["call +1 (632) 555-4827 now", "call (555) 123-4567 now", "order 12345678", "mail a.b@c.org", "mail: a.b [at] c [dot] org", "", None]
    df = spark.createDataFrame([(i if i % 50 else None, texts[i % 7]) for i in range(700)], "doc_id long, text string").repartition(4)
    rows = lambda d: sorted(map(tuple, d.collect()), key=repr)
    got = rows(pii.pii_table(df))
    assert got == rows(pii.pii_digests(df, *pii.fit(df))) and len(got) == 700
    assert any("number" in r[-1] or "contact" in r[-1] for r in got)
    assert pii.pii_table(df.where("false")).count() == 0
