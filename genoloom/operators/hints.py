"""Hints: evidence for introns, exons and codons, derived and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as sq
from .intervals import gaps


def merge_hints(hints: DataFrame) -> DataFrame:
    """Hints of many files (file_ord, line_no, seqid, source, type, start, end, strand, mult) with one row per place and strand: summed mult, the rest of the first one seen, and seq_ord, the first place of the contig in the input."""
    at = F.struct("file_ord", "line_no")
    out = hints.groupBy("seqid", "start", "end", "strand").agg(F.sum("mult").alias("mult"), F.min_by(F.struct("source", "type"), at).alias("_first"))
    seen = hints.groupBy("seqid").agg(F.min(at).alias("seq_ord"))
    return out.select("seqid", "start", "end", "strand", "mult", "_first.source", "_first.type").join(seen, "seqid")


def assembly_introns(exons: DataFrame, by: str = "cov") -> DataFrame:
    """seqid, start, end, strand ('.' where transcripts disagree or have none), n, mult: introns of assembled transcripts (tx, seqid, strand, cov, start, end), their coverage summed and rounded to at least 1, or counted."""
    i = gaps(exons, ["tx", "seqid", "strand", "cov"])
    s = F.array_remove(F.collect_set("strand"), ".")
    out = i.groupBy("seqid", "start", "end").agg(F.when(F.size(s) == 1, F.get(s, F.lit(0))).otherwise(".").alias("strand"), F.count("*").alias("n"), F.sum("cov").alias("cov"))
    mult = F.greatest(F.lit(1), F.bround("cov", 0).cast("bigint")) if by == "cov" else F.col("n")
    return out.withColumn("mult", mult.cast("bigint"))


# Sources of hints by class.
RNA_SOURCES = ["E", "W", "b2h"]
PROTEIN_SOURCES = ["P", "PH"]
COMBINED_SOURCES = ["C"]


def source_class(src: Column) -> Column:
    """rna, protein, combined (stands for both), or other."""
    src = F.trim(src)
    return F.when(src.isin(COMBINED_SOURCES), "combined").when(src.isin(RNA_SOURCES), "rna").when(src.isin(PROTEIN_SOURCES), "protein").otherwise("other")


def shrink(start: Column, end: Column, by: int = 15) -> tuple[Column, Column]:
    """Both ends moved inwards; where they would cross, the middle."""
    mid = F.floor((start + end) / 2).cast("bigint")
    crossed = start + by > end - by
    return F.when(crossed, mid).otherwise(start + by), F.when(crossed, mid).otherwise(end - by)


def alignment_introns(parts: DataFrame, program: str = "miniprot", least: int = 41, most: int = 350_000, least_score: float | None = None) -> DataFrame:
    """parent, seqid, strand, start, end, score: gaps between neighbouring parts of an alignment (parent, seqid, strand, line_no, start, end) in file order, whichever way the parts run. miniprot: every gap, with score 0. gth (parts also have score, qstart, qend): gaps of allowed length whose score, the mean of both parts', is above least_score, and where the query goes on without a gap."""
    w = Window.partitionBy("parent", "seqid", "strand").orderBy("line_no")
    p = parts.withColumn("_s", F.lag("start").over(w)).withColumn("_e", F.lag("end").over(w))
    up = F.col("start") > F.col("_e")
    p = p.withColumn("a", F.when(up, F.col("_e") + 1).otherwise(F.col("end") + 1)).withColumn("b", F.when(up, F.col("start") - 1).otherwise(F.col("_s") - 1))
    if program == "gth":
        p = p.withColumn("score", (F.lag("score").over(w) + F.col("score")) / 2.0).withColumn("_q", F.lag("qend").over(w) + 1)
        p = p.filter(F.expr(f"b - a + 1 BETWEEN {least} AND {most} AND _q = qstart"))
        p = p if least_score is None else p.filter(F.col("score") > least_score)
    else:
        p = p.withColumn("score", F.lit(0.0))
    return p.filter("_s IS NOT NULL").select("parent", "seqid", "strand", F.least("a", "b").alias("start"), F.greatest("a", "b").alias("end"), "score")


# Triplets that may start and that end a coding region.
STARTS = ["ATG", "TTG", "GTG", "CTG"]
STOPS = ["TAA", "TGA", "TAG"]


def codon_hints(genes: DataFrame, sequences: DataFrame) -> DataFrame:
    """seqid, pos, kind, strand: start codons in the first three bases of genes (tx, seqid, strand, start, end), and stop codons in the last three where the three bases behind the gene are one, as coding parts of these alignments go without it."""
    plus = F.col("strand") != "-"
    a, b = F.col("start"), F.col("end")
    ends = genes.withColumn("_ends", F.array(F.struct(F.lit("start").alias("kind"), F.when(plus, a).otherwise(b - 2).alias("at")), F.struct(F.lit("stop").alias("kind"), F.when(plus, b + 1).otherwise(a - 3).alias("at"))))
    s = sq.bases_at(ends.select("seqid", "strand", "start", "end", F.inline("_ends")), sequences, "at", 3)
    codon = F.upper(F.when(plus, F.col("bases")).otherwise(sq.reverse_complement(F.col("bases"))))
    fine = F.when(F.col("kind") == "start", codon.isin(STARTS)).otherwise(codon.isin(STOPS))
    pos = F.when(F.col("kind") == "start", F.col("at")).otherwise(F.when(plus, b - 2).otherwise(a))
    return s.filter(fine).select("seqid", pos.alias("pos"), "kind", "strand").distinct()


def find_strands(introns: DataFrame, sequences: DataFrame, pairs: tuple[str, ...] = ("gtag", "gcag", "atac")) -> DataFrame:
    """introns (seqid, start, end, strand, mult) with their strand by splice sites: both where both fit, none dropped; stranded ones stay. The score is mult."""
    known = introns.filter("strand IN ('+', '-')")
    open_ = introns.filter("strand NOT IN ('+', '-')")
    s = sq.bases_at(sq.bases_at(open_, sequences, "start", 2).withColumnRenamed("bases", "_l").withColumn("_at", F.col("end") - 1), sequences, "_at", 2)
    ends = F.lower(F.concat("_l", "bases"))
    back = F.lower(sq.reverse_complement(ends))
    both = F.filter(F.array(F.when(ends.isin(*pairs), "+"), F.when(back.isin(*pairs), "-")), lambda x: x.isNotNull())
    s = s.withColumn("strand", F.explode(both))
    return known.unionByName(s.select(*known.columns)).withColumn("score", F.col("mult"))
