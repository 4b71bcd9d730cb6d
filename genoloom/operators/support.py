"""Support of a gene set by hints, statistics, accuracy, assembly numbers, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent, upper_median
from .intervals import gaps, interval_join


def intron_classes(introns: DataFrame, hints: DataFrame) -> DataFrame:
    """introns (tx, seqid, strand, start, end) with classes, the sorted set of classes of hints (seqid, strand, start, end, class) at the same place; '.' of either side fits any strand."""
    h = hints.withColumn("strand", F.explode(F.when(F.col("strand") == ".", F.array(F.lit("+"), F.lit("-"), F.lit("."))).otherwise(F.array("strand", F.lit(".")))))
    h = h.groupBy("seqid", "strand", "start", "end").agg(F.array_sort(F.collect_set("class")).alias("classes"))
    return introns.join(h, ["seqid", "strand", "start", "end"], "left").withColumn("classes", F.coalesce("classes", F.array().cast("array<string>")))


def exon_classes(exons: DataFrame, hints: DataFrame, bin_size: int | None = None) -> DataFrame:
    """exons (tx, seqid, strand, start, end) with rna and protein: whether a hint of that class overlaps."""
    h = hints.withColumn("strand", F.explode(F.when(F.col("strand") == ".", F.array(F.lit("+"), F.lit("-"))).otherwise(F.array("strand"))))
    place = ["seqid", "strand", "start", "end"]
    out = exons
    for c in ("rna", "protein"):  # a combined hint stands for both
        got = interval_join(exons.select(*place).distinct(), h.filter(F.col("class").isin(c, "combined")), ["seqid", "strand"], "left_semi", bin_size)
        out = out.join(got.withColumn(c, F.lit(True)), place, "left").withColumn(c, F.coalesce(c, F.lit(False)))
    return out


def support_table(introns: DataFrame, exons: DataFrame) -> DataFrame:
    """Per transcript: introns and exons with rna, protein and any support, with percentages (NA without introns)."""
    has = lambda c: F.array_contains("classes", c) | F.array_contains("classes", "combined")
    n = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    i = introns.groupBy("tx").agg(F.count("*").alias("introns"), n(has("rna"), "introns_rna"), n(has("protein"), "introns_protein"), n(has("rna") | has("protein"), "introns_any"), n(has("rna") & has("protein"), "introns_both"))
    x = exons.groupBy("tx").agg(F.count("*").alias("exons"), n(F.col("rna"), "exons_rna"), n(F.col("protein"), "exons_protein"), n(F.col("rna") | F.col("protein"), "exons_any"), n(F.col("rna") & F.col("protein"), "exons_both"))
    out = x.join(i, "tx", "left").fillna(0, ["introns", "introns_rna", "introns_protein", "introns_any", "introns_both"])
    return out.withColumn("introns_pct", percent(F.col("introns_any"), F.col("introns"))).withColumn("exons_pct", percent(F.col("exons_any"), F.col("exons")))


SUPPORT_TOTALS = ["transcripts", "single_exon", "fully", "some", "none", "introns", "introns_rna", "introns_protein", "introns_both", "introns_any", "exons", "exons_rna", "exons_protein", "exons_both", "exons_any"]


def support_totals(introns: DataFrame, exons: DataFrame) -> DataFrame:
    """One row (SUPPORT_TOTALS) over all transcripts of exons: how many have no introns, all, some or none of them supported, and the introns and exons with support of each kind."""
    rows = support_table(introns, exons)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUPPORT_TOTALS[5:]]
    count = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    n, any_ = F.col("introns"), F.col("introns_any")
    return rows.agg(F.count("*").alias("transcripts"), count(n == 0, "single_exon"), count((n > 0) & (n == any_), "fully"), count((any_ > 0) & (any_ < n), "some"), count((n > 0) & (any_ == 0), "none"), *sums)


def gene_set_statistics(cds: DataFrame) -> DataFrame:
    """One row of numbers of a gene set: cds (gene, tx, start, end)."""
    t = cds.groupBy("gene", "tx").agg(F.count("*").alias("exons"), F.sum(F.col("end") - F.col("start") + 1).alias("length"), F.min("start").alias("s"), F.max("end").alias("e"))
    g = t.groupBy("gene").agg(F.count("*").alias("tx"), F.floor(F.sum(F.col("exons") - 1) / F.count("*")).cast("bigint").alias("introns"), (F.max("e") - F.min("s") + 1).alias("span"))
    one = t.agg(F.count("*").alias("transcripts"), F.sum("exons").cast("bigint").alias("exons"), F.count(F.when(F.col("exons") == 1, 1)).alias("single_exon"), F.sum("length").cast("bigint").alias("cds_bases"), upper_median("length").alias("median_cds"), F.max("exons").alias("most_exons"))
    two = g.agg(F.count("*").alias("genes"), F.max("tx").alias("most_tx"), upper_median("span").alias("median_span"), F.sum("introns").cast("bigint").alias("introns_per_gene"))
    return one.crossJoin(two)


def assembly_stats(sequences: DataFrame) -> DataFrame:
    """n_seqs, length, n50, l50. Lengths are counted by value first, so the running sum is over different lengths."""
    by = sequences.groupBy(F.length("seq").cast("bigint").alias("len")).agg(F.count("*").alias("k")).withColumn("total", F.col("len") * F.col("k"))
    w = Window.orderBy(F.col("len").desc())
    every = Window.partitionBy()
    run = by.withColumn("upto", F.sum("total").over(w)).withColumn("rank", F.sum("k").over(w)).withColumn("all_", F.sum("total").over(every)).withColumn("n", F.sum("k").over(every))
    # The smallest i with twice the running sum at or over the total lies in the first length that gets there.
    need = F.greatest(F.coalesce(F.ceil(F.try_divide(F.col("all_") / 2.0 - (F.col("upto") - F.col("total")), F.col("len"))), F.lit(1)), F.lit(1))
    hit = run.filter("2 * upto >= all_").withColumn("i", F.col("rank") - F.col("k") + need)
    return hit.agg(F.max("n").alias("n_seqs"), F.max("all_").alias("length"), F.max("len").alias("n50"), F.min_by("i", -F.col("len")).cast("bigint").alias("l50"))


def accuracy_levels(query: DataFrame, reference: DataFrame) -> DataFrame:
    """level, n_query, n_reference, n_both: exons, introns and chains (tx, seqid, strand, start, end of exons) that agree exactly, each counted once. Both sets go through the levels together, told apart by a flag; a level is one grouping by place."""
    both = query.withColumn("_q", F.lit(1)).unionByName(reference.withColumn("_q", F.lit(0)))
    place = ["seqid", "strand", "start", "end"]
    exons = both.select("_q", *place).withColumn("level", F.lit("exon"))
    introns = gaps(both, ["_q", "tx", "seqid", "strand"]).select("_q", *place).withColumn("level", F.lit("intron"))
    flat = exons.unionByName(introns).select("_q", "level", F.struct(*place).alias("at"))
    chain = both.groupBy("_q", "tx", "seqid", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("chain"))
    tally = lambda df: df.groupBy("level", "at").agg(F.max("_q").alias("q"), F.max(1 - F.col("_q")).alias("r")).select("level", "q", "r")
    seen = tally(flat).unionByName(tally(chain.select("_q", F.lit("chain").alias("level"), F.struct("seqid", "strand", "chain").alias("at"))))
    levels = seen.sparkSession.createDataFrame([("exon",), ("intron",), ("chain",)], "level string")
    n = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    return levels.join(F.broadcast(seen.groupBy("level").agg(n(F.col("q") == 1, "n_query"), n(F.col("r") == 1, "n_reference"), n((F.col("q") == 1) & (F.col("r") == 1), "n_both"))), "level", "left").fillna(0)


def positive_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n (not null), positive (> 0) of each column."""
    long = df.select(F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("double"))])).alias("column", "v"))
    return long.groupBy("column").agg(F.count("v").alias("n"), F.count(F.when(F.col("v") > 0, 1)).alias("positive"))
