"""Interval queries: unions, loci, overlaps, depth, components, neighbours."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators.components import exon_components
from . import adapter as ad
from .registry import query

BIN = 64


@query("merge_intervals", f"WITH {ad.EXONS} SELECT tx, seqid, strand, s AS start_, e AS end_, n FROM exons")
def merge_intervals(spark, d):
    return iv.merge_intervals(ad.raw_exons(spark, d), ad.TX).select(*ad.TX, F.col("start").alias("start_"), F.col("end").alias("end_"), "n")


@query("merge_intervals_strict", f"WITH {ad.RAW}, {ad.merged_sql('raw', 'm', 'seqid, strand', 0, 'RANGE')} SELECT seqid, strand, s AS start_, e AS end_, n FROM m")
def merge_strict(spark, d):
    return iv.merge_intervals(ad.raw_exons(spark, d), ["seqid", "strand"], touching=False).select("seqid", "strand", F.col("start").alias("start_"), F.col("end").alias("end_"), "n")


@query("transcript_spans", f"WITH {ad.EXONS} SELECT tx, MIN(s) AS start_, MAX(e) AS end_, COUNT(*) AS n_exons, CAST(SUM(e - s + 1) AS BIGINT) AS bases FROM exons GROUP BY tx")
def spans(spark, d):
    return ad.exons(spark, d).groupBy("tx").agg(F.min("start").alias("start_"), F.max("end").alias("end_"), F.count("*").alias("n_exons"), F.sum(F.expr("end - start + 1")).alias("bases"))


@query("introns", f"WITH {ad.INTRONS} SELECT tx, seqid, strand, s AS start_, e AS end_, ROW_NUMBER() OVER (PARTITION BY tx ORDER BY s) AS ix FROM introns")
def introns(spark, d):
    return iv.gaps(ad.exons(spark, d), ad.TX).select(*ad.TX, F.col("start").alias("start_"), F.col("end").alias("end_"), "ix")


@query("coverage_overlap", f"""WITH {ad.EXONS}, cov0 AS (SELECT seqid, s, e FROM exons WHERE tx % 3 = 0), {ad.merged_sql('cov0', 'cov', 'seqid')},
per AS (SELECT x.tx, SUM(LEAST(x.e, c.e) - GREATEST(x.s, c.s) + 1) AS n FROM exons x JOIN cov c ON x.seqid = c.seqid AND x.s <= c.e AND c.s <= x.e GROUP BY x.tx)
SELECT t.tx, CAST(COALESCE(per.n, 0) AS BIGINT) AS covered FROM (SELECT DISTINCT tx FROM exons) t LEFT JOIN per USING (tx)""")
def coverage_overlap(spark, d):
    return iv.covered_bases(ad.exons(spark, d).withColumnRenamed("seqid", "contig"), ["contig"], ad.coverage(spark, d), ["tx"], BIN)


@query("interval_pairs", f"WITH {ad.EXONS} SELECT a.tx, b.tx AS other, a.s AS start_, b.s AS other_start, LEAST(a.e, b.e) - GREATEST(a.s, b.s) + 1 AS shared FROM exons a JOIN exons b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e WHERE a.tx < b.tx")
def interval_pairs(spark, d):
    """All exons with all exons of later transcripts."""
    x = ad.exons(spark, d)
    p = iv.interval_join(x, x, ["seqid", "strand"], "inner", BIN).filter("tx < r_tx")
    return p.select("tx", F.col("r_tx").alias("other"), F.col("start").alias("start_"), F.col("r_start").alias("other_start"), (F.least("end", "r_end") - F.greatest("start", "r_start") + 1).alias("shared"))


_SEMI = f"WITH {ad.EXONS} SELECT tx, seqid, s AS start_, e AS end_ FROM exons a WHERE tx // 20 % 4 <> 0 AND {{}} EXISTS (SELECT 1 FROM exons b WHERE b.tx // 20 % 4 = 0 AND a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e)"


def _semi(spark, d, how):
    x = ad.exons(spark, d)
    return iv.interval_join(x.filter("(tx div 20) % 4 <> 0"), x.filter("(tx div 20) % 4 = 0"), ["seqid", "strand"], how, BIN).select("tx", "seqid", F.col("start").alias("start_"), F.col("end").alias("end_"))


@query("interval_semi", _SEMI.format(""))
def interval_semi(spark, d):
    return _semi(spark, d, "left_semi")


@query("interval_anti", _SEMI.format("NOT"))
def interval_anti(spark, d):
    return _semi(spark, d, "left_anti")


@query("interval_left", f"""WITH {ad.EXONS} SELECT a.tx, a.s AS start_, COUNT(b.tx) AS hits FROM exons a LEFT JOIN exons b ON b.tx // 20 % 4 = 0 AND a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e WHERE a.tx // 20 % 4 <> 0 GROUP BY ALL""")
def interval_left(spark, d):
    """Every exon is on one of the two sides."""
    x = ad.exons(spark, d)
    p = iv.interval_join(x.filter("(tx div 20) % 4 <> 0"), x.filter("(tx div 20) % 4 = 0"), ["seqid", "strand"], "left", BIN)
    return p.groupBy("tx", F.col("start").alias("start_")).agg(F.count("r_tx").alias("hits"))


def _depth(agg):
    return f"""WITH {ad.EXONS}, src AS (SELECT seqid, s, e, 1 + tx % 7 AS depth FROM exons WHERE tx % 3 = 0),
edges AS (SELECT seqid, s AS p FROM src UNION SELECT seqid, e + 1 FROM src),
el AS (SELECT seqid, p AS s, LEAD(p) OVER (PARTITION BY seqid ORDER BY p) - 1 AS e FROM edges),
dep AS (SELECT el.seqid, el.s, el.e, {agg}(src.depth) AS depth FROM el JOIN src ON el.seqid = src.seqid AND src.s <= el.s AND el.e <= src.e GROUP BY ALL),
mark AS (SELECT *, CASE WHEN LAG(e) OVER w + 1 = s AND LAG(depth) OVER w = depth THEN 0 ELSE 1 END AS o FROM dep WINDOW w AS (PARTITION BY seqid ORDER BY s)),
grp AS (SELECT *, SUM(o) OVER (PARTITION BY seqid ORDER BY s) AS g FROM mark)
SELECT seqid AS contig, MIN(s) AS start_, MAX(e) AS end_, CAST(depth AS BIGINT) AS depth FROM grp GROUP BY seqid, g, depth"""


@query("depth_segments", _depth("MAX"))
def depth_segments(spark, d):
    return iv.depth_segments(ad.coverage(spark, d), ["contig"], "depth", "max", BIN).select("contig", F.col("start").alias("start_"), F.col("end").alias("end_"), "depth")


@query("depth_sum_segments", _depth("SUM"))
def depth_sum(spark, d):
    return iv.depth_segments(ad.coverage(spark, d), ["contig"], "depth", "sum", BIN).select("contig", F.col("start").alias("start_"), F.col("end").alias("end_"), "depth")


@query("exon_components", f"""WITH RECURSIVE {ad.EXONS}, {ad.merged_sql('exons', 'isl0', 'seqid, strand', 0, 'RANGE')},
lnk AS (SELECT DISTINCT tx, seqid, strand, g FROM isl0_g),
reach AS (SELECT DISTINCT tx, tx AS root FROM lnk UNION SELECT b.tx, r.root FROM reach r JOIN lnk a ON a.tx = r.tx JOIN lnk b ON a.seqid = b.seqid AND a.strand = b.strand AND a.g = b.g)
SELECT tx, MIN(root) AS component FROM reach GROUP BY tx""")
def components(spark, d):
    return exon_components(ad.exons(spark, d), ["seqid", "strand"], "tx").select("tx", "component")


@query("nearest_neighbour", f"""WITH {ad.CHAINS}, j AS (SELECT seqid, strand, tx // 40 AS gene, s, e, tx FROM chains)
SELECT a.tx, (SELECT MAX(b.e) FROM j b WHERE b.seqid = a.seqid AND b.gene <> a.gene AND b.e < a.s) AS left_end, (SELECT MIN(b.s) FROM j b WHERE b.seqid = a.seqid AND b.gene <> a.gene AND b.s > a.e) AS right_start FROM j a""")
def nearest_neighbour(spark, d):
    x = ad.chains(spark, d).select("tx", "contig", F.expr("tx div 40").alias("gene"), F.get("segs", F.lit(0))["start"].alias("start"), F.element_at("segs", -1)["end"].alias("end"))
    return iv.nearest(x, x.select("contig", "gene", "start", "end"), ["contig"], "gene").select("tx", "left_end", "right_start")


@query("relational_division", f"""WITH {ad.INTRONS}, own AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tx ORDER BY s) AS i FROM introns), st AS (SELECT tx * 2 AS st, seqid, strand, s, e FROM own UNION ALL SELECT tx * 2 + 1, seqid, strand, s, e FROM own WHERE i > 1),
need AS (SELECT tx, COUNT(*) AS n FROM introns GROUP BY tx),
got AS (SELECT c.tx, s.st, COUNT(DISTINCT c.s) AS n FROM introns c JOIN st s ON c.seqid = s.seqid AND c.strand = s.strand AND c.s = s.s AND c.e = s.e GROUP BY ALL)
SELECT got.tx, got.st AS transcript, got.n AS n_introns FROM got JOIN need ON got.tx = need.tx AND got.n = need.n""")
def relational_division(spark, d):
    """Each transcript against all, and against all without their first intron."""
    from ..operators.annotate import holds_all

    i = ad.tx_introns(spark, d)
    number = F.row_number().over(Window.partitionBy("tx").orderBy("start"))
    own = i.withColumn("i", number)
    place = ["contig", "strand", "start", "end"]
    st = own.select(F.expr("tx * 2").alias("transcript"), *place).unionByName(own.filter("i > 1").select(F.expr("tx * 2 + 1").alias("transcript"), *place))
    return holds_all(i, st, place, "tx", "transcript").select("tx", "transcript", F.col("n").alias("n_introns"))


@query("overlap_lag", f"WITH {ad.RAW} SELECT tx, COUNT(*) AS overlapping FROM (SELECT tx, s, LAG(e) OVER (PARTITION BY tx ORDER BY s, e) AS pe FROM raw) WHERE pe >= s GROUP BY tx")
def overlap_lag(spark, d):
    w = Window.partitionBy("tx").orderBy("start", "end")
    return ad.raw_exons(spark, d).withColumn("pe", F.lag("end").over(w)).filter("pe >= start").groupBy("tx").agg(F.count("*").alias("overlapping"))
