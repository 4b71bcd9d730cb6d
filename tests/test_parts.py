"""Sorted files in parts: no task sorts or writes the whole, and what is read file by file is whole in its file."""

import os

import pytest
from pyspark.sql import functions as F

from genoloom.plans import file_queries as fq
from genoloom.sinks import writers as wr
from genoloom.sources import scans as sc


@pytest.fixture(autouse=True)
def small_ranges_stay_apart(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_transcripts_stay_in_one_part(spark, tmp_path):
    tx = F.expr("CASE WHEN id < 900 THEN 'long' ELSE concat('t', id % 7) END")
    rows = spark.range(1000).select(F.lit("g").alias("gene_id"), tx.alias("tx_id"), F.lit("c").alias("seqid"), F.lit("+").alias("strand"), F.lit("exon").alias("type"), (F.col("id") * 10 + 1).alias("start"), (F.col("id") * 10 + 5).alias("end"), F.lit(None).cast("string").alias("phase"))
    path = str(tmp_path / "parts")
    wr.write_gtf(rows, path, parts=True)
    assert sum(f.startswith("part-") for f in os.listdir(path)) > 1
    got = {r["tx_id"]: r["n"] for r in sc.gtf_transcripts(spark, path).select("tx_id", F.size("exons").alias("n")).collect()}
    assert got["long"] == 900 and sum(got.values()) == 1000 and len(got) == 8


def test_queries_write_parts(spark, monkeypatch):
    seen = []
    for name in ("write_gtf", "write_bedgraph"):
        real = getattr(wr, name)
        monkeypatch.setattr(wr, name, lambda df, path, *a, real=real, **k: (real(df, path, *a, **k), seen.append(sum(f.startswith("part-") for f in os.listdir(path.removeprefix("file://"))))))
    fq.scan_gtf_transcripts(spark, "/root/testdata/sf0.001")
    fq.scan_bedgraph(spark, "/root/testdata/sf0.001")
    assert len(seen) == 2 and min(seen) > 1
