"""Gene-model, evidence and report queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..functions.numbers import fixed, upper_median
from ..operators import annotate as an
from ..operators import consensus as co
from ..operators import genemodel as gm
from ..operators import hints as hi
from ..operators import intervals as iv
from ..operators import support as su
from ..operators.components import cut
from ..sinks import writers as wr
from . import adapter as ad
from .registry import query

BIN = 64


@query("cds_phases", f"WITH {ad.EXONS} SELECT tx, s AS start_, (3 - COALESCE(SUM(e - s + 1) OVER (PARTITION BY tx ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT % 3) % 3 AS phase FROM exons")
def cds_phases(spark, d):
    return gm.cds_phases(ad.exons(spark, d), ["tx"]).select("tx", F.col("start").alias("start_"), "phase")


def _by_gene(spark, d):
    c = ad.chains(spark, d).select("tx", F.expr("aggregate(segs, 0L, (a, x) -> a + x.end - x.start + 1)").alias("len"))
    return c.join(ad.table(spark, d, "orders").select(F.col("o_orderkey").alias("tx"), F.col("o_custkey").alias("gene")), "tx")


_GENE = f"WITH {ad.CHAINS}, t AS (SELECT tx, len, o_custkey AS gene FROM chains JOIN orders ON o_orderkey = tx)"


@query("longest_isoform", _GENE + " SELECT gene, tx, len FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY gene ORDER BY len DESC, tx) AS r FROM t) WHERE r = 1")
def longest_isoform(spark, d):
    return gm.longest_isoform(_by_gene(spark, d), "gene", "len", "tx").select("gene", "tx", "len")


@query("cap_isoforms", _GENE + " SELECT gene, tx, len FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY gene ORDER BY len DESC, tx) AS r FROM t) WHERE r <= 3")
def cap_isoforms(spark, d):
    return gm.cap_isoforms(_by_gene(spark, d), "gene", "len", "tx", 3).select("gene", "tx", "len")


@query("isoform_lists", _GENE + " SELECT gene, string_agg(tx, ';' ORDER BY tx) AS isoforms, COUNT(*) AS n FROM t GROUP BY gene")
def isoform_lists(spark, d):
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("tx")), lambda x: x.cast("string")), ";")
    return _by_gene(spark, d).groupBy("gene").agg(ids.alias("isoforms"), F.count("*").alias("n"))


@query("malformed_transcripts", f"WITH {ad.RAW} SELECT DISTINCT tx FROM (SELECT tx, s, LAG(e) OVER (PARTITION BY tx ORDER BY s, e) AS pe FROM raw) WHERE pe >= s")
def malformed(spark, d):
    return gm.malformed(ad.raw_exons(spark, d), "tx")


@query("transcript_filter", """SELECT l_orderkey AS tx, CAST(SUM(l_quantity) AS BIGINT) AS length, CASE WHEN SUM(l_quantity) < 60 THEN 'length' WHEN COALESCE(MAX(CASE WHEN l_linenumber > 1 THEN l_linenumber END), 0) < 3 THEN 'cov' WHEN SUM(l_quantity) >= 150 AND COALESCE(NULLIF(COUNT(*), 5), 0) < 2 THEN 'tpm_long' WHEN SUM(l_quantity) < 150 AND COALESCE(NULLIF(COUNT(*), 5), 0) < 4 THEN 'tpm' WHEN l_orderkey % 5 = 0 THEN 'unstranded' WHEN SUM(l_quantity) >= 150 THEN 'pass_long_relaxed' ELSE 'pass' END AS reason FROM lineitem GROUP BY l_orderkey""")
def transcript_filter(spark, d):
    t = ad.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tx")).agg(F.sum("l_quantity").cast("bigint").alias("length"), F.max(F.expr("CASE WHEN l_linenumber > 1 THEN l_linenumber END")).alias("cov"), F.expr("nullif(count(*), 5)").alias("tpm"))
    t = t.withColumn("strand", F.expr("CASE WHEN tx % 5 = 0 THEN '.' ELSE '+' END"))
    return gm.transcript_filter(t, 60, 3, 4, 150, 2, drop_unstranded=True).select("tx", "length", "reason")


@query("merge_annotations", f"""WITH RECURSIVE {ad.CHAINS}, pick AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY seqid, strand, chain ORDER BY len DESC, tx) AS r FROM chains), kept AS (SELECT * FROM pick WHERE r = 1),
ex AS (SELECT x.tx, x.seqid, x.strand, x.s, x.e FROM exons x JOIN kept USING (tx)), {ad.merged_sql('ex', 'isl', 'seqid, strand', 0, 'RANGE')},
lnk AS (SELECT DISTINCT tx, seqid, strand, g FROM isl_g),
reach AS (SELECT DISTINCT tx, tx AS root FROM lnk UNION SELECT b.tx, r.root FROM reach r JOIN lnk a ON a.tx = r.tx JOIN lnk b ON a.seqid = b.seqid AND a.strand = b.strand AND a.g = b.g),
comp AS (SELECT tx, MIN(root) AS c FROM reach GROUP BY tx),
spans AS (SELECT c, seqid, strand, MIN(s) AS gs, MAX(e) AS ge FROM kept JOIN comp USING (tx) GROUP BY c, seqid, strand),
nums AS (SELECT c, ROW_NUMBER() OVER (ORDER BY seqid, gs, strand, ge, c) AS gene FROM spans)
SELECT tx, gene, ROW_NUMBER() OVER (PARTITION BY c ORDER BY s, tx) AS isoform FROM kept JOIN comp USING (tx) JOIN nums USING (c)""")
def merge_annotations(spark, d):
    t = ad.chains(spark, d).withColumnRenamed("contig", "seqid").withColumn("exons", F.col("segs")).withColumn("cds", F.col("segs")).withColumn("utr_bp", F.lit(0)).drop("segs")
    return gm.merge_annotations(t).select("tx", "gene", "isoform")


@query("priority_merge", f"WITH {ad.CHAINS}, p AS (SELECT * FROM chains WHERE tx % 6 = 0) SELECT tx FROM p UNION ALL SELECT tx FROM chains c WHERE tx % 6 <> 0 AND NOT EXISTS (SELECT 1 FROM p WHERE p.seqid = c.seqid AND p.strand = c.strand AND p.s <= c.e AND c.s <= p.e)")
def priority_merge(spark, d):
    c = ad.chains(spark, d).select("tx", F.col("contig").alias("seqid"), "strand", F.get("segs", F.lit(0))["start"].alias("start"), F.element_at("segs", -1)["end"].alias("end"))
    return gm.priority_merge(c.filter("tx % 6 <> 0"), c.filter("tx % 6 = 0"), 1024).select("tx")


@query("stop_codon_cut", f"WITH {ad.EXONS}, o AS (SELECT *, COALESCE(SUM(e - s + 1) OVER (PARTITION BY tx ORDER BY CASE WHEN strand = '-' THEN s ELSE -e END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS behind FROM exons), c AS (SELECT *, LEAST(e - s + 1, GREATEST(3 - behind, 0)) AS cut FROM o) SELECT tx, string_agg(CASE WHEN strand = '-' THEN s + cut ELSE s END || '-' || CASE WHEN strand = '-' THEN e ELSE e - cut END, ',' ORDER BY s) AS chain FROM (SELECT tx, strand, s, e, CAST(cut AS BIGINT) AS cut FROM c WHERE cut < e - s + 1) GROUP BY tx")
def stop_codon_cut(spark, d):
    c = ad.chains(spark, d)
    return c.select("tx", co.chain_text(gm.without_stop(F.col("segs"), F.col("strand"))).alias("chain")).filter("chain <> ''")


@query("combined_features", f"""WITH {ad.EXONS}, {ad.merged_sql('exons', 'mx', 'tx')}, o AS (SELECT *, e - s + 1 AS size, COALESCE(SUM(e - s + 1) OVER (PARTITION BY tx ORDER BY CASE WHEN strand = '-' THEN s ELSE -e END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS behind,
  SUM(e - s + 1) OVER (PARTITION BY tx) AS total FROM exons), c AS (SELECT *, LEAST(size, GREATEST(3 - behind, 0)) AS cut FROM o), t AS (SELECT tx, ANY_VALUE(strand) AS strand, MIN(s) AS s, MAX(e) AS e FROM exons GROUP BY tx)
SELECT tx, type, CAST(s AS BIGINT) AS start_, CAST(e AS BIGINT) AS end_, CAST(phase AS BIGINT) AS phase FROM (
SELECT tx, 'transcript' AS type, s, e, NULL AS phase FROM t UNION ALL SELECT tx, 'exon', s, e, NULL FROM mx
UNION ALL SELECT tx, 'CDS', CASE WHEN strand = '-' THEN s + cut ELSE s END, CASE WHEN strand = '-' THEN e ELSE e - cut END, (3 - (total - behind - size) % 3) % 3 FROM c WHERE cut < size
UNION ALL SELECT tx, 'start_codon', CASE WHEN strand = '-' THEN e - 2 ELSE s END, CASE WHEN strand = '-' THEN e ELSE s + 2 END, 0 FROM t
UNION ALL SELECT tx, 'stop_codon', CASE WHEN strand = '-' THEN s ELSE e - 2 END, CASE WHEN strand = '-' THEN s + 2 ELSE e END, 0 FROM t)""")
def combined_features(spark, d):
    c = ad.chains(spark, d).withColumns({"gene_id": F.lit("g"), "tx_id": F.col("tx").cast("string"), "exons": F.lit(None)})
    return wr.combined_features(c).select("tx", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), "phase")


@query("utr_report", f"""WITH {ad.EXONS}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tx ORDER BY s) AS i, COUNT(*) OVER (PARTITION BY tx) AS k FROM exons)
SELECT tx, CASE tx % 4 WHEN 0 THEN 'has_utr' WHEN 1 THEN 'short' WHEN 2 THEN 'long' ELSE 'none' END AS matched_by, CAST(SUM(CASE WHEN i = 1 AND tx % 4 <> 3 THEN e - s + 1 ELSE 0 END) AS BIGINT) AS five, CAST(SUM(CASE WHEN i = k AND i > 1 AND tx % 4 <> 3 THEN e - s + 1 ELSE 0 END) AS BIGINT) AS three FROM n GROUP BY tx""")
def utr_report(spark, d):
    """First and last exons stand for untranslated regions."""
    c = ad.chains(spark, d)
    u = c.filter("tx % 4 <> 3").select(F.col("tx").alias("tx_id"), F.posexplode("segs").alias("i", "x"), F.size("segs").alias("k"))
    u = u.select("tx_id", F.expr("CASE WHEN i = 0 THEN 'five_prime_UTR' WHEN i = k - 1 THEN '3UTR' ELSE 'exon' END").alias("type"), "x.start", "x.end")
    t = c.select(F.col("tx").alias("tx_id"), F.expr("element_at(array('has_utr', 'short', 'long', 'none'), cast(tx % 4 as int) + 1)").alias("matched_by"))
    return an.utr_report(t, u).select(F.col("tx_id").alias("tx"), "matched_by", F.col("five_prime_utr_bp").alias("five"), F.col("three_prime_utr_bp").alias("three"))


@query("utr_tally", f"WITH {ad.CHAINS} SELECT COUNT(*) AS coding, COUNT(*) FILTER (tx % 4 = 0) AS has_utr, COUNT(*) FILTER (tx % 4 = 1) AS short, COUNT(*) FILTER (tx % 4 = 2) AS long, COUNT(*) FILTER (tx % 4 = 3) AS none, COUNT(*) FILTER (tx % 4 IN (1, 2) AND tx % 5 > 0) AS utr_added, COUNT(*) FILTER (tx % 10 = 1) AS stopped FROM chains")
def utr_tally(spark, d):
    by = F.expr("element_at(array('has_utr', 'short', 'long', 'none'), cast(tx % 4 as int) + 1)")
    return an.utr_tally(ad.chains(spark, d).select(F.col("tx").alias("tx_id"), by.alias("matched_by"), F.expr("tx % 4 IN (1, 2) AND tx % 5 > 0").alias("utr_added"), F.expr("tx % 10 = 1").alias("stopped")))


@query("structure_checks", f"WITH {ad.CHAINS} SELECT tx, CASE WHEN len % 3 <> 0 THEN 'cds_length_mod3' END AS reason FROM chains")
def structure_checks(spark, d):
    c = ad.chains(spark, d).withColumn("cds", F.col("segs")).withColumn("exons", F.col("segs")).withColumn("first_phase", F.lit(0))
    return c.select("tx", gm.structure_reason().alias("reason"))


@query("support_table", f"""WITH {ad.INTRONS}, ih AS (SELECT DISTINCT seqid, strand, s, e, CASE WHEN tx % 2 = 0 THEN 'rna' ELSE 'protein' END AS c FROM introns WHERE tx % 3 = 0),
xh AS (SELECT seqid, strand, s, e, CASE WHEN tx % 2 = 0 THEN 'rna' ELSE 'protein' END AS c FROM exons WHERE tx % 5 = 0),
i AS (SELECT a.tx, COUNT(*) AS introns, COUNT(*) FILTER (EXISTS (SELECT 1 FROM ih WHERE ih.seqid = a.seqid AND ih.strand = a.strand AND ih.s = a.s AND ih.e = a.e AND c = 'rna')) AS introns_rna FROM introns a GROUP BY a.tx),
x AS (SELECT a.tx, COUNT(*) AS exons, COUNT(*) FILTER (EXISTS (SELECT 1 FROM xh WHERE xh.seqid = a.seqid AND xh.strand = a.strand AND xh.s <= a.e AND a.s <= xh.e AND c = 'protein')) AS exons_protein FROM exons a GROUP BY a.tx)
SELECT x.tx, exons, exons_protein, COALESCE(introns, 0) AS introns, COALESCE(introns_rna, 0) AS introns_rna FROM x LEFT JOIN i ON i.tx = x.tx""")
def support_table(spark, d):
    kind = F.expr("CASE WHEN tx % 2 = 0 THEN 'rna' ELSE 'protein' END").alias("class")
    i = ad.tx_introns(spark, d).withColumnRenamed("contig", "seqid")
    x = ad.exons(spark, d)
    ic = su.intron_classes(i, i.filter("tx % 3 = 0").select("seqid", "strand", "start", "end", kind))
    xc = su.exon_classes(x, x.filter("tx % 5 = 0").select("seqid", "strand", "start", "end", kind), BIN)
    return su.support_table(ic, xc).select("tx", "exons", "exons_protein", "introns", "introns_rna")


@query("gene_set_stats", f"""WITH {ad.EXONS}, t AS (SELECT o_custkey AS gene, tx, COUNT(*) AS exons, CAST(SUM(e - s + 1) AS BIGINT) AS length, MIN(s) AS s, MAX(e) AS e FROM exons JOIN orders ON o_orderkey = tx GROUP BY ALL),
g AS (SELECT gene, COUNT(*) AS tx, SUM(exons - 1) // COUNT(*) AS introns, MAX(e) - MIN(s) + 1 AS span FROM t GROUP BY gene)
SELECT COUNT(*) AS transcripts, CAST(SUM(exons) AS BIGINT) AS exons, COUNT(*) FILTER (exons = 1) AS single_exon, CAST(SUM(length) AS BIGINT) AS cds_bases, list_sort(list(length))[COUNT(*) // 2 + 1] AS median_cds, MAX(exons) AS most_exons,
 (SELECT COUNT(*) FROM g) AS genes, (SELECT MAX(tx) FROM g) AS most_tx, (SELECT list_sort(list(span))[COUNT(*) // 2 + 1] FROM g) AS median_span, (SELECT CAST(SUM(introns) AS BIGINT) FROM g) AS introns_per_gene FROM t""")
def gene_set_stats(spark, d):
    x = ad.exons(spark, d).join(ad.table(spark, d, "orders").select(F.col("o_orderkey").alias("tx"), F.col("o_custkey").alias("gene")), "tx")
    return su.gene_set_statistics(x)


@query("accuracy_levels", f"""WITH {ad.INTRONS}, chains AS (SELECT tx, seqid, strand, string_agg(s || '-' || e, ',' ORDER BY s) AS chain FROM exons GROUP BY ALL),
q AS (SELECT DISTINCT 'exon' AS level, seqid || strand || s || '-' || e AS k FROM exons WHERE tx % 3 <> 0 UNION SELECT 'intron', seqid || strand || s || '-' || e FROM introns WHERE tx % 3 <> 0 UNION SELECT 'chain', seqid || strand || chain FROM chains WHERE tx % 3 <> 0),
r AS (SELECT DISTINCT 'exon' AS level, seqid || strand || s || '-' || e AS k FROM exons WHERE tx % 2 = 0 UNION SELECT 'intron', seqid || strand || s || '-' || e FROM introns WHERE tx % 2 = 0 UNION SELECT 'chain', seqid || strand || chain FROM chains WHERE tx % 2 = 0)
SELECT level, (SELECT COUNT(*) FROM q WHERE q.level = l.level) AS n_query, (SELECT COUNT(*) FROM r WHERE r.level = l.level) AS n_reference, (SELECT COUNT(*) FROM q JOIN r USING (level, k) WHERE level = l.level) AS n_both FROM (VALUES ('exon'), ('intron'), ('chain')) l(level)""")
def accuracy_levels(spark, d):
    x = ad.exons(spark, d)
    return su.accuracy_levels(x.filter("tx % 3 <> 0"), x.filter("tx % 2 = 0")).select("level", "n_query", "n_reference", "n_both")


@query("assembly_introns", f"WITH {ad.INTRONS} SELECT seqid, s AS start_, e AS end_, CASE WHEN COUNT(DISTINCT strand) = 1 THEN MIN(strand) ELSE '.' END AS strand_, COUNT(*) AS n, GREATEST(1, SUM(1 + tx % 9)::BIGINT) AS mult FROM introns GROUP BY ALL".replace("GROUP BY ALL", "GROUP BY seqid, s, e"))
def assembly_introns(spark, d):
    x = ad.exons(spark, d).withColumn("cov", F.expr("cast(1 + tx % 9 as double)"))
    return hi.assembly_introns(x).select("seqid", F.col("start").alias("start_"), F.col("end").alias("end_"), F.col("strand").alias("strand_"), "n", "mult")


@query("hint_merge", f"WITH {ad.INTRONS}, h AS (SELECT *, tx % 3 AS f FROM introns) SELECT seqid, s AS start_, e AS end_, strand, CAST(SUM(1 + tx % 5) AS BIGINT) AS mult, arg_min('s' || tx % 7, f * 100000000 + tx * 10 + 1) AS source FROM h GROUP BY ALL")
def hint_merge(spark, d):
    i = ad.tx_introns(spark, d).select(F.expr("cast(tx % 3 as int)").alias("file_ord"), F.col("tx").alias("line_no"), F.col("contig").alias("seqid"), F.expr("concat('s', tx % 7)").alias("source"), F.lit("intron").alias("type"), "start", "end", "strand", F.expr("1 + tx % 5").alias("mult"))
    return hi.merge_hints(i).select("seqid", F.col("start").alias("start_"), F.col("end").alias("end_"), "strand", "mult", "source")


@query("hint_shrink", f"WITH {ad.EXONS} SELECT tx, s AS start_, CASE WHEN s + 15 > e - 15 THEN (s + e) // 2 ELSE s + 15 END AS a, CASE WHEN s + 15 > e - 15 THEN (s + e) // 2 ELSE e - 15 END AS b FROM exons")
def hint_shrink(spark, d):
    a, b = hi.shrink(F.col("start"), F.col("end"))
    return ad.exons(spark, d).select("tx", F.col("start").alias("start_"), a.alias("a"), b.alias("b"))


@query("alignment_introns", f"WITH {ad.EXONS}, p AS (SELECT *, LAG(e) OVER (PARTITION BY tx ORDER BY s) AS pe FROM exons) SELECT tx, pe + 1 AS start_, s - 1 AS end_, 0 AS half FROM p WHERE pe IS NOT NULL")
def alignment_introns(spark, d):
    x = ad.exons(spark, d).withColumn("line_no", F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))).withColumnRenamed("tx", "parent")
    return hi.alignment_introns(x).select(F.col("parent").alias("tx"), F.col("start").alias("start_"), F.col("end").alias("end_"), F.col("score").cast("int").alias("half"))


@query("alignment_introns_scored", f"""WITH {ad.EXONS}, q AS (SELECT *, 10 * ROW_NUMBER() OVER (PARTITION BY tx ORDER BY s) + CASE WHEN s % 4 = 0 THEN 1 ELSE 0 END AS qs, s % 50 AS score FROM exons),
p AS (SELECT *, LAG(e) OVER w AS pe, LAG(score) OVER w AS pscore, LAG(qs) OVER w AS pq FROM q WINDOW w AS (PARTITION BY tx ORDER BY s))
SELECT tx, pe + 1 AS start_, s - 1 AS end_, CAST(score + pscore AS INT) AS half FROM p WHERE s - pe - 1 BETWEEN 41 AND 2000 AND pq + 10 = qs AND score + pscore > 20""")
def alignment_introns_scored(spark, d):
    """The rules of the program whose alignments have scores and query places."""
    w = Window.partitionBy("tx").orderBy("start")
    x = ad.exons(spark, d).withColumn("qstart", 10 * F.row_number().over(w) + F.expr("CASE WHEN start % 4 = 0 THEN 1 ELSE 0 END")).withColumn("qend", F.col("qstart") + 9).withColumn("score", F.expr("start % 50"))
    x = x.withColumn("line_no", F.col("start")).withColumnRenamed("tx", "parent")
    return hi.alignment_introns(x, "gth", 41, 2000, 10.0).select(F.col("parent").alias("tx"), F.col("start").alias("start_"), F.col("end").alias("end_"), (F.col("score") * 2).cast("int").alias("half"))


@query("utr_matches", f"""WITH {ad.INTRONS}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tx ORDER BY s) AS i, COUNT(*) OVER (PARTITION BY tx) AS k FROM exons), sx AS (SELECT tx * 2 AS st, seqid, strand, s, e FROM n UNION ALL SELECT tx * 2 + 1, seqid, strand, s, CASE WHEN i = k THEN e + 40 ELSE e END FROM n WHERE i > 1),
si AS (SELECT * FROM (SELECT st, seqid, strand, e + 1 AS s, LEAD(s) OVER (PARTITION BY st ORDER BY s) - 1 AS e FROM sx) WHERE e >= s), len AS (SELECT st, CAST(SUM(e - s + 1) AS BIGINT) AS len FROM sx GROUP BY st), c AS (SELECT tx, COUNT(*) AS n FROM introns GROUP BY tx),
p AS (SELECT a.tx, b.st, COUNT(*) AS k FROM introns a JOIN si b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s = b.s AND a.e = b.e GROUP BY ALL),
one AS (SELECT tx, ANY_VALUE(seqid) AS seqid, ANY_VALUE(strand) AS strand, MIN(s) AS s, MAX(e) AS e FROM exons GROUP BY tx HAVING COUNT(*) = 1),
q AS (SELECT DISTINCT o.tx, x.st FROM one o JOIN sx x ON o.seqid = x.seqid AND o.strand = x.strand AND x.s <= o.e AND o.s <= x.e WHERE NOT EXISTS (SELECT 1 FROM si WHERE si.st = x.st AND si.s <= o.e AND o.s <= si.e)),
m AS (SELECT p.tx, p.st FROM p JOIN c ON c.tx = p.tx AND c.n = p.k UNION ALL SELECT tx, st FROM q)
SELECT m.tx, arg_max(m.st, (CASE WHEN m.st % 5 = 0 THEN 1 ELSE 0 END) * 100000000000000 + len.len * 1000000000 - m.st) AS st FROM m JOIN len ON len.st = m.st GROUP BY m.tx""")
def utr_matches(spark, d):
    """Every transcript against two of each: itself, and itself without the first exon and with a longer last one."""
    c = cut(ad.chains(spark, d), "chains").withColumnRenamed("contig", "seqid")
    cand = c.select(F.col("tx").alias("tx_id"), "seqid", "strand", F.col("segs").alias("cds"), co.introns(F.col("segs")).alias("introns"))
    n = F.size("segs")
    later = F.transform(F.slice("segs", 2, n - 1), lambda x, i: F.struct(x["start"].alias("start"), F.when(i == n - 2, x["end"] + 40).otherwise(x["end"]).alias("end")))
    st = c.select(F.expr("tx * 2").alias("st_ord"), "seqid", "strand", "segs").unionByName(c.filter(n > 1).select(F.expr("tx * 2 + 1").alias("st_ord"), "seqid", "strand", later.alias("segs")))
    st = st.select("st_ord", "seqid", "strand", F.expr("st_ord % 5 = 0").alias("is_long"), F.expr("aggregate(segs, 0L, (a, x) -> a + x.end - x.start + 1)").alias("length"), F.col("segs").alias("exons"), co.introns(F.col("segs")).alias("introns"))
    return an.match_transcripts(cand, st, BIN).select(F.col("tx_id").alias("tx"), F.col("st.st_ord").alias("st"))


@query("ncrna_coverage_filter", f"""WITH {ad.EXONS}, cod0 AS (SELECT seqid, strand, s, e FROM exons WHERE tx % 3 = 0), {ad.merged_sql('cod0', 'cod', 'seqid, strand')},
b AS (SELECT tx, CAST(SUM(e - s + 1) AS BIGINT) AS n FROM exons WHERE tx % 3 = 1 GROUP BY tx),
v AS (SELECT x.tx, SUM(LEAST(x.e, c.e) - GREATEST(x.s, c.s) + 1) AS k FROM exons x JOIN cod c ON x.seqid = c.seqid AND x.strand = c.strand AND x.s <= c.e AND c.s <= x.e WHERE x.tx % 3 = 1 GROUP BY x.tx)
SELECT b.tx AS gene FROM b LEFT JOIN v ON v.tx = b.tx WHERE COALESCE(v.k, 0) * 10 <= b.n""")
def ncrna_coverage_filter(spark, d):
    x = ad.exons(spark, d)
    nc = x.filter("tx % 3 = 1").withColumnRenamed("tx", "gene")
    return an.drop_covered(nc.select("gene").distinct(), nc, x.filter("tx % 3 = 0"), 0.1, BIN).select("gene")


@query("greedy_overlap_filter", f"""WITH RECURSIVE {ad.CHAINS}, {ad.merged_sql('chains', 'isl', 'seqid, strand', 0)},
i AS (SELECT tx, seqid, strand, g, s, e, ROW_NUMBER() OVER (PARTITION BY seqid, strand, g ORDER BY tx % 3, tx) AS n FROM isl_g),
r AS (SELECT seqid, strand, g, 1::BIGINT AS n, [{{'tx': tx, 's': s, 'e': e}}] AS kept FROM i WHERE n = 1 UNION ALL
 SELECT r.seqid, r.strand, r.g, i.n, CASE WHEN 2 * len(list_distinct(flatten(list_transform(list_filter(r.kept, lambda k: k.s <= i.e AND i.s <= k.e), lambda k: range(CAST(greatest(k.s, i.s) AS BIGINT), CAST(least(k.e, i.e) + 1 AS BIGINT)))))) <= i.e - i.s + 1 THEN list_append(r.kept, {{'tx': i.tx, 's': i.s, 'e': i.e}}) ELSE r.kept END
 FROM r JOIN i ON i.seqid = r.seqid AND i.strand = r.strand AND i.g = r.g AND i.n = r.n + 1)
SELECT k.tx AS gene FROM (SELECT UNNEST(arg_max(kept, n)) AS k FROM r GROUP BY seqid, strand, g)""")
def greedy_overlap_filter(spark, d):
    c = ad.chains(spark, d).select(F.col("tx").alias("gene"), F.col("contig").alias("seqid"), "strand", F.get("segs", F.lit(0))["start"].alias("start"), F.element_at("segs", -1)["end"].alias("end"), F.expr("tx % 3").alias("file_ord"), F.col("tx").alias("ord"))
    return an.greedy_accept(c).select("gene")


@query("tree_score", f"""WITH {ad.CHAINS}, r AS (SELECT tx, -0.5 + CASE WHEN len <= 60 THEN -1.0 WHEN n <= 2 THEN 0.25 ELSE 1.5 END + CASE WHEN CASE WHEN tx % 4 = 0 THEN NULL ELSE tx % 11 END IS NULL THEN 0.5 WHEN tx % 11 <= 5 THEN -0.75 ELSE 0.125 END AS z FROM chains)
SELECT tx, CAST(ROUND(1000000 / (1 + EXP(-z))) AS BIGINT) AS p FROM r""")
def tree_score(spark, d):
    tree = lambda feat, thr, left, right, leaf, value, nan: {"feat": feat, "thr": thr, "left": left, "right": right, "leaf": leaf, "value": value, "nan_left": nan}
    model = {"features": ["len", "n", "x"], "baseline": -0.5, "trees": [
        tree([0, 0, 1, 0, 0], [60.0, 0, 2.0, 0, 0], [1, 0, 3, 0, 0], [2, 0, 4, 0, 0], [False, True, False, True, True], [0, -1.0, 0, 0.25, 1.5], [True] * 5),
        tree([2, 2, 0, 0, 0], [5.0, -1.0, 0, 0, 0], [1, 3, 0, 0, 0], [2, 4, 0, 0, 0], [False, False, True, True, True], [0, 0, 0.125, 0.5, -0.75], [True, True, True, True, True]),
    ]}
    c = ad.chains(spark, d).select("tx", F.expr("aggregate(segs, 0L, (a, x) -> a + x.end - x.start + 1)").alias("len"), F.size("segs").alias("n"), F.expr("CASE WHEN tx % 4 = 0 THEN NULL ELSE tx % 11 END").alias("x"))
    return an.tree_scores(c, model).select("tx", F.round(F.col("p") * 1000000).cast("bigint").alias("p"))


@query("log_odds_shift", "SELECT l_orderkey AS tx, l_linenumber AS line, l_quantity AS q, CAST(ROUND(1000000 * CASE l_linenumber % 3 WHEN 0 THEN p WHEN 1 THEN 1 / (1 + EXP(-(LN(c / (1 - c)) + 1.5))) ELSE 1 / (1 + EXP(-(LN(c / (1 - c)) + 0.5))) END) AS BIGINT) AS p6 FROM (SELECT *, (l_quantity - 1) / 49 AS p, LEAST(GREATEST((l_quantity - 1) / 49, 1e-6), 1 - 1e-6) AS c FROM lineitem)")
def log_odds_shift(spark, d):
    li = ad.table(spark, d, "lineitem").withColumn("p", F.expr("(l_quantity - 1) / 49")).withColumn("s", F.expr("CASE l_linenumber % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'full' ELSE 'partial' END"))
    return li.select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("q"), F.round(co.shift_log_odds(F.col("p"), F.col("s"), 1.5, 0.5) * 1000000).cast("bigint").alias("p6"))


@query("report_rounding", "SELECT l_orderkey AS tx, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS q, printf('%.3f', l_quantity / 7) AS text3, printf('%.1f', l_quantity / 13) AS text1 FROM lineitem")
def report_rounding(spark, d):
    return ad.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("bigint").alias("q"), fixed(F.expr("l_quantity / 7"), 3).alias("text3"), fixed(F.expr("l_quantity / 13"), 1).alias("text1"))


@query("upper_medians", "SELECT l_suppkey AS supp, list_sort(list(CAST(l_quantity AS BIGINT)))[COUNT(*) // 2 + 1] AS upper, MEDIAN(l_quantity) AS middle FROM lineitem GROUP BY l_suppkey")
def upper_medians(spark, d):
    return ad.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("supp")).agg(upper_median("cast(l_quantity as bigint)").alias("upper"), F.median("l_quantity").alias("middle"))


@query("assembly_stats", f"""WITH {ad.SEQS}, l AS (SELECT length(seq) AS n FROM seqs), r AS (SELECT n, SUM(n) OVER (ORDER BY n DESC ROWS UNBOUNDED PRECEDING) AS c, ROW_NUMBER() OVER (ORDER BY n DESC) AS i, SUM(n) OVER () AS t FROM l)
SELECT (SELECT COUNT(*) FROM l) AS n_seqs, (SELECT CAST(SUM(n) AS BIGINT) FROM l) AS length, CAST(arg_min(n, i) AS BIGINT) AS n50, MIN(i) AS l50 FROM r WHERE 2 * c >= t""")
def assembly_stats(spark, d):
    return su.assembly_stats(ad.sequences(spark, d))


_CODE = "(SELECT map_from_entries(list((c, a))) AS code FROM (SELECT substr('TCAG', (i // 16) + 1, 1) || substr('TCAG', (i // 4) % 4 + 1, 1) || substr('TCAG', i % 4 + 1, 1) AS c, substr('" + sq.AMINO + "', i + 1, 1) AS a FROM (SELECT CAST(UNNEST(range(64)) AS INTEGER) AS i)))"
_PROT = f"WITH {ad.SEQS}, code AS {_CODE}, p AS (SELECT id, list_aggregate(list_transform(range(length(seq) // 3), lambda i: COALESCE(element_at(code, substr(seq, CAST(i AS INTEGER) * 3 + 1, 3)), 'X')), 'string_agg', '') AS aa FROM seqs, code)"


@query("translate_orf", _PROT.replace("element_at(code, substr(seq, CAST(i AS INTEGER) * 3 + 1, 3))", "code[substr(seq, CAST(i AS INTEGER) * 3 + 1, 3)]") + " SELECT id, COALESCE(md5(aa), md5('')) AS aa_md5, COALESCE(length(aa), 0) AS n FROM p")
def translate_orf(spark, d):
    return ad.sequences(spark, d).withColumn("aa", sq.translate(F.col("seq"))).select("id", F.md5(F.col("aa").cast("binary")).alias("aa_md5"), F.length("aa").cast("bigint").alias("n"))


@query("internal_stops", _PROT.replace("element_at(code, substr(seq, CAST(i AS INTEGER) * 3 + 1, 3))", "code[substr(seq, CAST(i AS INTEGER) * 3 + 1, 3)]") + " SELECT COUNT(*) AS proteins, COUNT(*) FILTER (contains(rtrim(aa, '*'), '*')) AS with_stop FROM p")
def internal_stops(spark, d):
    p = ad.sequences(spark, d).select(sq.translate(F.col("seq")).alias("aa"))
    return p.agg(F.count("*").alias("proteins"), F.count(F.when(sq.has_internal_stop(F.col("aa")), 1)).alias("with_stop"))


@query("reverse_complement", f"WITH {ad.SEQS} SELECT id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS rc_md5 FROM seqs")
def reverse_complement(spark, d):
    return ad.sequences(spark, d).select("id", F.md5(sq.reverse_complement(F.col("seq")).cast("binary")).alias("rc_md5"))


@query("splice_strand", f"""WITH {ad.SEQS}, i AS (SELECT l_orderkey % (SELECT COUNT(*) FROM documents) AS id, 1 + l_partkey % 100 AS s, 1 + l_partkey % 100 + CAST(l_quantity AS BIGINT) + 10 AS e FROM lineitem),
j AS (SELECT DISTINCT i.id, s, e, lower(substr(seq, s, 2) || substr(seq, e - 1, 2)) AS d, lower(reverse(translate(substr(seq, s, 2) || substr(seq, e - 1, 2), 'ACGT', 'TGCA'))) AS r FROM i JOIN seqs USING (id) WHERE length(seq) >= e)
SELECT id, s AS start_, e AS end_, '+' AS strand FROM j WHERE d IN ('gtag', 'gcag', 'atac') UNION ALL SELECT id, s, e, '-' FROM j WHERE r IN ('gtag', 'gcag', 'atac')""")
def splice_strand(spark, d):
    n = ad.table(spark, d, "documents").agg(F.count("*").alias("n"))
    i = ad.table(spark, d, "lineitem").crossJoin(F.broadcast(n)).select(F.expr("l_orderkey % n").alias("id"), F.expr("1 + l_partkey % 100").alias("start"), F.expr("1 + l_partkey % 100 + cast(l_quantity as bigint) + 10").alias("end")).distinct()
    j = i.join(ad.sequences(spark, d), "id").filter("length(seq) >= end")
    return j.select("id", F.col("start").alias("start_"), F.col("end").alias("end_"), F.explode(sq.splice_strands(F.col("seq"), F.col("start"), F.col("end"))).alias("strand"))


@query("spliced_cds", f"WITH {ad.CHAINS}, {ad.SEQS}, x AS (SELECT c.tx, c.strand, string_agg(substr(seq, 1 + u.s % 300, u.e - u.s + 1), '' ORDER BY 1 + u.s % 300, 1 + u.s % 300 + u.e - u.s) AS t FROM (SELECT tx, strand, UNNEST(segs) AS u FROM chains) c JOIN seqs ON seqs.id = c.tx % 100 GROUP BY c.tx, c.strand) SELECT tx, md5(CASE WHEN strand = '-' THEN reverse(translate(t, 'ACGT', 'TGCA')) ELSE t END) AS cds_md5 FROM x")
def spliced_cds(spark, d):
    c = ad.chains(spark, d).withColumn("id", F.expr("tx % 100")).withColumn("segs", F.transform("segs", lambda x: F.struct((x["start"] % 300 + 1).alias("start"), (x["start"] % 300 + 1 + x["end"] - x["start"]).alias("end"))))
    j = c.join(ad.sequences(spark, d), "id")
    return j.select("tx", F.md5(sq.spliced(F.col("seq"), F.col("segs"), F.col("strand")).cast("binary")).alias("cds_md5"))
