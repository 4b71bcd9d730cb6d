"""The driver's contract."""

import os

import pytest


def test_entry(spark):
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    if os.path.isdir("/root/testdata/sf0.001"):
        assert e.entry(spark).count() > 0


def test_streams(spark, tmp_path):
    from genoloom.streaming.streams import hint_stream

    spark.createDataFrame([("c", 1, 2, 3), ("c", 1, 2, 4)], "contig string, start bigint, end bigint, mult bigint").write.parquet(str(tmp_path / "in"))
    q = hint_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("hints_out").outputMode("complete").start()
    try:
        q.processAllAvailable()
        assert [r["mult"] for r in spark.table("hints_out").collect()] == [7]
    finally:
        q.stop()


def test_engine_does_not_need_the_training_data_package():
    import ast
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "genoloom"
    for f in root.rglob("*.py"):
        if "llm" in f.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(f.read_text())):
            names = [a.name for a in node.names] + [getattr(node, "module", None) or ""] if isinstance(node, (ast.Import, ast.ImportFrom)) else []
            assert not any("llm" in n.split(".") for n in names), f


if __name__ == "__main__":
    pytest.main([__file__])
