"""The corpus pipeline: five stages over documents, each written as Parquet and read again before the next.

Stage 1, quality: a document that the quality classifier rejects (score below its threshold) goes.
Stage 2, lines: repeated lines go (exact and within the edit distance); a document that loses all its lines goes with them.
Stage 3, near copies: of each group of near copies (shingles of five words, similarity of 0.8 or more) the document with the
smallest doc_id stays, once.
Stage 4, benchmark: a document that holds a benchmark passage goes.
Stage 5, mix: the documents that the mix takes, with size, source_size, target, copies and taken; copies says how many times.

A document is a row. Decisions are about rows, told apart by doc_id and text together: rows that share a doc_id but not a text
are judged each, rows with a null doc_id like others (except that their lines are kept). Equal rows share a decision; near
copies keeps one of them, the least by all columns that have an order. Ties of doc_id in a group go to the smaller hash of the text. Null and
empty texts: the classifier scores them by its prior, the line and near-copy stages keep them, the mix takes none of them as
they have no words. Texts of any length are read whole. An empty table passes through empty; without labels every score is
0.5 and all documents stay, without benchmark items none goes. All stages but the last return the columns of documents, in
their order, whatever further columns there are; the last one adds its own and replaces columns of those names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoloom.llm.common import cut, free_name, key_of, small_side, table
from genoloom.llm.decontaminate import contaminated
from genoloom.llm.jaccard import jaccard_groups
from genoloom.llm.lines import dedup_lines
from genoloom.llm.mixing import mix_sources
from genoloom.llm.quality import learn, score_quality

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learn(docs, table(spark, sf_dir, "labels"))
    return _without(docs, cut(score_quality(docs, model).filter("predicted = 0").select("row").distinct(), "rejected"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.filter("text IS NULL OR text <> '' OR n_removed = 0").select(*[c for c in docs.columns if c in out.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = cut(jaccard_groups(docs, SHINGLE_WORDS, SIMILAR_PERCENT).filter("component IS NOT NULL").select("component", "doc_id", "row"), "groups")
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    per = cut(groups.groupBy("component").agg(F.min(own).alias("kept"), F.count("*").alias("n")).filter("n > 1").select("component", F.col("kept.row").alias("kept"), "n"), "kept")
    own = groups.join(small_side(per, 32), "component")
    kept = _without(docs, cut(own.filter("row <> kept").select("row").distinct(), "copies"))
    # The row that stays may be there more than once.
    twice = cut(own.filter("row = kept").groupBy("row").agg(F.count("*").alias("m")).filter("m > 1").select("row"), "twice")
    if twice.isEmpty():
        return kept
    key = free_name(docs, "key")
    again = kept.join(small_side(twice.withColumnRenamed("row", key), 16), key_of(kept) == F.col(key), "left_semi")
    number = free_name(docs, "number")
    again = cut(again.withColumn(number, F.monotonically_increasing_id()), "again")
    # The least by the columns that have an order, then by number; maps have none.
    order = F.struct(*[f.name for f in docs.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))], number)
    least = cut(again.groupBy(key_of(again).alias(key)).agg(F.min_by(number, order).alias(number)).select(number), "least")
    once = again.join(small_side(least, 16), number, "left_semi").drop(number)
    return _without(kept, twice).unionByName(once)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, cut(contaminated(docs, table(spark, sf_dir, "benchmark")).select("row").distinct(), "leaks"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    number = free_name(docs, "number")
    docs = cut(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    taken = cut(mix_sources(docs, carry=number).filter("copies > 0 AND size > 0").drop("source", "doc_id"), "taken")
    own = docs.select(*[c for c in docs.columns if c == number or c not in taken.columns])
    return own.join(small_side(taken, 64), number).drop(number)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows of these keys (row)."""
    key = free_name(docs, "key")
    gone = gone.withColumnRenamed("row", key)
    return docs.join(small_side(gone, 16), key_of(docs) == gone[key], "left_anti")


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
