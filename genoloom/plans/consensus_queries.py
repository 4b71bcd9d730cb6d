"""Consensus queries: merge of gene sets, loci, evidence, tiers, selection."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import consensus as co
from . import adapter as ad
from .registry import query

BIN = 64
TIER = """CASE WHEN a AND b AND tx_ THEN 10 WHEN a AND tx_ THEN 9 WHEN a AND b THEN 8 WHEN b AND c AND d_ THEN 7
  WHEN a AND (n >= 5 OR (n >= 3 AND len >= 600) OR len >= 1200) THEN 5 WHEN a THEN 3 WHEN b AND tx_ THEN 4 ELSE 0 END"""
TIERED = (
    ad.STRUCTURES
    + f""",
flags AS (SELECT *, contains(tools, 't0') AS a, contains(tools, 't1') AS b, contains(tools, 't2') AS c, contains(tools, 't3') AS d_, contains(tools, 't2') OR contains(tools, 't3') AS tx_ FROM structs),
tiered AS (SELECT *, {TIER} AS tier, c AND d_ AND NOT a AND NOT b AS dt FROM flags),
{ad.merged_sql("tiered", "loc", "seqid, strand", 0)},
numbered AS (SELECT *, DENSE_RANK() OVER (ORDER BY seqid, strand, g) - 1 AS cluster FROM loc_g)"""
)


@query("consensus_merge", f"WITH {ad.STRUCTURES} SELECT seqid AS contig, strand, chain, tools, members, rep_tx, len AS cds_len, n AS n_exons FROM structs")
def consensus_merge(spark, d):
    s = ad.structures(spark, d)
    return s.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), F.array_join("tools", ",").alias("tools"), F.size("members").cast("bigint").alias("members"), F.col("rep.tx_id").alias("rep_tx"), "cds_len", "n_exons")


@query("locus_cluster", f"WITH {TIERED} SELECT seqid AS contig, strand, chain, cluster FROM numbered")
def locus_cluster(spark, d):
    return co.add_loci(ad.structures(spark, d)).select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "cluster")


PLAIN = co.Rules(rna_rules=False, agree_rules=False, chain_rules=False, rna_penalty=0.0, chain_bonus=0.0, iso_chain_min_tier=None)


@query("consensus_primary", f"""WITH {TIERED}, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY 100 * (CASE WHEN dt THEN 5.5 ELSE tier END) + n_tools DESC, segs) AS r,
  MAX(CASE WHEN a OR b THEN tier ELSE 0 END) OVER (PARTITION BY cluster) AS best FROM numbered)
SELECT cluster, seqid AS contig, strand, chain, tools, CAST(tier AS BIGINT) AS tier FROM ranked WHERE r = 1 AND best >= 4""")
def consensus_primary(spark, d):
    s = co.select_rules(co.assign_tiers(co.add_loci(ad.structures(spark, d)), PLAIN), PLAIN)
    return s.filter("why = 'primary'").select("cluster", "contig", "strand", co.chain_text(F.col("segs")).alias("chain"), F.array_join("tools", ",").alias("tools"), F.col("tier").cast("bigint").alias("tier"))


DEMOTE = co.Rules(rna_rules=False, agree_rules=True, chain_rules=False, rna_penalty=2.0, chain_bonus=0.0, iso_chain_min_tier=None, drop_lone_single_exon=("t0", "t1"))


@query("consensus_decide", f"""WITH {TIERED}, {ad.INTRON_PART},
{ad.RNA},
si AS (SELECT chain, seqid, strand, tools, segs[i].e + 1 AS s, segs[i + 1].s - 1 AS e FROM structs, UNNEST(range(1, n)) AS u(i)),
it AS (SELECT seqid, strand, s, e, list_distinct(flatten(list(string_split(tools, ',')))) AS all_ FROM si GROUP BY ALL),
ev AS (SELECT si.seqid, si.strand, si.chain, COUNT(*) AS ni, COUNT(*) FILTER (len(list_filter(it.all_, lambda x: NOT list_contains(string_split(si.tools, ','), x))) > 0) AS agreed, COUNT(*) FILTER (COALESCE(rna.mult, 0) >= 2) AS rna_ok
  FROM si JOIN it USING (seqid, strand, s, e) LEFT JOIN rna USING (seqid, s, e) GROUP BY ALL),
a0 AS (SELECT m.*, COALESCE(ni, 0) AS ni, COALESCE(agreed, 0) AS agreed, COALESCE(rna_ok, 0) AS rna_ok FROM numbered m LEFT JOIN ev USING (seqid, strand, chain)),
a1 AS (SELECT *, CASE WHEN tools = 't0' AND ni > 0 AND agreed = ni AND tier < 6 THEN 6 ELSE tier END AS tier1 FROM a0),
a2 AS (SELECT *, (tools = 't0' OR tools = 't1') AND n = 1 AS down FROM a1),
a3 AS (SELECT *, CASE WHEN down THEN 2 ELSE tier1 END AS tier2, CASE WHEN down THEN tier1 END AS open_tier FROM a2),
a4 AS (SELECT *, 100 * (CASE WHEN dt THEN 5.5 ELSE tier2 END - CASE WHEN ni > 0 AND rna_ok < ni THEN 2 ELSE 0 END) + n_tools AS score FROM a3),
a5 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY score DESC, segs) AS r, MAX(CASE WHEN a OR b THEN COALESCE(open_tier, tier2) ELSE 0 END) OVER (PARTITION BY cluster) >= 4 AS op FROM a4),
a6 AS (SELECT *, MAX(CASE WHEN r = 1 THEN down END) OVER (PARTITION BY cluster) AS dem, MIN(CASE WHEN NOT down AND CASE WHEN dt THEN 5.5 ELSE tier2 END >= 4 THEN r END) OVER (PARTITION BY cluster) AS alt FROM a5),
a7 AS (SELECT *, CASE WHEN op AND dem AND alt IS NOT NULL AND r = alt THEN 1 WHEN op AND dem AND alt IS NOT NULL AND r < alt THEN r + 1 ELSE r END AS rk, op AND (NOT dem OR alt IS NOT NULL) AS op2, CASE WHEN strand = '+' THEN e ELSE s END AS stop FROM a6),
a8 AS (SELECT *, MAX(CASE WHEN rk = 1 THEN stop END) OVER (PARTITION BY cluster) AS stop1, MAX(CASE WHEN rk = 1 THEN len END) OVER (PARTITION BY cluster) AS len1 FROM a7)
SELECT cluster, seqid AS contig, strand, chain, CAST(rk AS BIGINT) AS rank, CASE WHEN NOT op2 THEN 'locus_below_min' WHEN rk = 1 THEN 'primary' WHEN tier2 >= 8 THEN 'isoform_tier' WHEN dt AND (stop = stop1 OR len >= 0.95 * len1) THEN 'isoform_orf_agreement' ELSE 'isoform_rejected' END AS why FROM a8""")
def consensus_decide(spark, d):
    s = co.add_agreement(co.add_rna(co.add_loci(ad.structures(spark, d)), ad.rna_hints(spark, d), None))
    s = co.select_rules(co.assign_tiers(s, DEMOTE), DEMOTE)
    return s.select("cluster", "contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "rank", "why")


@query("structure_introns_rna", f"""WITH {ad.STRUCTURES}, {ad.INTRON_PART}, {ad.RNA},
si AS (SELECT chain, seqid, strand, segs[i].e + 1 AS s, segs[i + 1].s - 1 AS e FROM structs, UNNEST(range(1, n)) AS u(i)),
ev AS (SELECT si.seqid, si.strand, si.chain, COUNT(*) FILTER (COALESCE(rna.mult, 0) >= 2) AS rna_introns, MIN(COALESCE(rna.mult, 0)) AS rna_min_mult FROM si LEFT JOIN rna USING (seqid, s, e) GROUP BY ALL)
SELECT seqid AS contig, strand, chain, COALESCE(rna_introns, 0) AS rna_introns, rna_min_mult FROM structs LEFT JOIN ev USING (seqid, strand, chain)""")
def intron_support_rna(spark, d):
    return co.add_rna(ad.structures(spark, d), ad.rna_hints(spark, d), None).select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "rna_introns", "rna_min_mult")


@query("structure_coverage", f"""WITH {ad.STRUCTURES}, cov0 AS (SELECT seqid, s, e FROM exons WHERE tx % 3 = 0), {ad.merged_sql('cov0', 'cov', 'seqid')},
sg AS (SELECT seqid, strand, chain, UNNEST(segs) AS x FROM structs),
per AS (SELECT sg.seqid, sg.strand, sg.chain, SUM(LEAST(x.e, cov.e) - GREATEST(x.s, cov.s) + 1) AS n FROM sg JOIN cov ON sg.seqid = cov.seqid AND x.s <= cov.e AND cov.s <= x.e GROUP BY ALL)
SELECT seqid AS contig, strand, chain, CAST(COALESCE(per.n, 0) AS BIGINT) AS rna_covered FROM structs LEFT JOIN per USING (seqid, strand, chain)""")
def structure_coverage(spark, d):
    s = co.add_rna(ad.structures(spark, d), None, ad.coverage(spark, d), bin_size=BIN)
    return s.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "rna_covered")


@query("intron_tool_agreement", f"""WITH {ad.STRUCTURES},
si AS (SELECT chain, seqid, strand, tools, segs[i].e + 1 AS s, segs[i + 1].s - 1 AS e FROM structs, UNNEST(range(1, n)) AS u(i)),
it AS (SELECT seqid, strand, s, e, list_distinct(flatten(list(string_split(tools, ',')))) AS all_ FROM si GROUP BY ALL),
ev AS (SELECT si.seqid, si.strand, si.chain, COUNT(*) FILTER (len(list_filter(it.all_, lambda x: NOT list_contains(string_split(si.tools, ','), x))) > 0) AS agreed FROM si JOIN it USING (seqid, strand, s, e) GROUP BY ALL)
SELECT seqid AS contig, strand, chain, tools, CAST(n - 1 AS BIGINT) AS n_introns, COALESCE(agreed, 0) AS agreed FROM structs LEFT JOIN ev USING (seqid, strand, chain)""")
def intron_tool_agreement(spark, d):
    return co.add_agreement(ad.structures(spark, d)).select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), F.array_join("tools", ",").alias("tools"), "n_introns", "agreed")


@query("chain_containment", f"""WITH {ad.STRUCTURES}, ft AS (SELECT tx, seqid, strand, segs FROM chains WHERE tx % 6 = 0),
multi AS (SELECT st.seqid, st.strand, st.chain, ft.tx FROM structs st JOIN ft ON st.seqid = ft.seqid AND st.strand = ft.strand WHERE st.n > 1 AND len(ft.segs) >= st.n AND EXISTS (
  SELECT 1 FROM UNNEST(range(1, len(ft.segs) - st.n + 2)) AS u(i) WHERE ft.segs[i].s <= st.segs[1].s AND ft.segs[i].e = st.segs[1].e AND ft.segs[i + st.n - 1].s = st.segs[st.n].s AND st.segs[st.n].e <= ft.segs[i + st.n - 1].e
  AND (st.n = 2 OR ft.segs[i + 1 : i + st.n - 2] = st.segs[2 : st.n - 1]))),
fe AS (SELECT seqid, strand, UNNEST(segs) AS x FROM ft),
fi AS (SELECT DISTINCT seqid, strand, segs[i].e + 1 AS s, segs[i + 1].s - 1 AS e FROM ft, UNNEST(range(1, len(segs))) AS u(i)),
si AS (SELECT chain, seqid, strand, segs[i].e + 1 AS s, segs[i + 1].s - 1 AS e FROM structs, UNNEST(range(1, n)) AS u(i)),
part AS (SELECT DISTINCT seqid, strand, chain FROM si JOIN fi USING (seqid, strand, s, e)),
one AS (SELECT st.seqid, st.strand, st.chain, COUNT(*) FILTER (fe.x.s <= st.s AND st.e <= fe.x.e) AS n_full, COUNT(*) AS n_over FROM structs st JOIN fe ON st.seqid = fe.seqid AND st.strand = fe.strand AND fe.x.s <= st.e AND st.s <= fe.x.e WHERE st.n = 1 GROUP BY ALL),
cnt AS (SELECT seqid, strand, chain, COUNT(*) AS n_full FROM multi GROUP BY ALL)
SELECT st.seqid AS contig, st.strand, st.chain, CASE WHEN COALESCE(cnt.n_full, one.n_full, 0) > 0 THEN 'full' WHEN part.chain IS NOT NULL OR COALESCE(one.n_over, 0) > 0 THEN 'partial' ELSE 'none' END AS chain_support, COALESCE(cnt.n_full, one.n_full, 0) AS chain_n
FROM structs st LEFT JOIN cnt USING (seqid, strand, chain) LEFT JOIN one USING (seqid, strand, chain) LEFT JOIN part USING (seqid, strand, chain)""")
def chain_containment(spark, d):
    return co.add_chains(ad.structures(spark, d), ad.full_length(spark, d), BIN).select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "chain_support", "chain_n")


@query("protein_intron_support", f"""WITH {ad.STRUCTURES}, {ad.INTRON_PART}, {ad.PROT},
p1 AS (SELECT seqid, s, e, MAX(n) AS pn FROM prot GROUP BY ALL),
si AS (SELECT chain, seqid, strand, segs[i].e + 1 AS s, segs[i + 1].s - 1 AS e FROM structs, UNNEST(range(1, n)) AS u(i))
SELECT si.seqid AS contig, si.strand, si.chain, COUNT(pn) AS prot_introns, MIN(COALESCE(pn, 0)) AS prot_intron_min_n FROM si LEFT JOIN p1 USING (seqid, s, e) GROUP BY ALL""")
def protein_intron_support(spark, d):
    s = co.add_protein_introns(ad.structures(spark, d), ad.protein_hints(spark, d)).filter("n_introns > 0")
    return s.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "prot_introns", "prot_intron_min_n")


@query("protein_conflicts", f"""WITH {ad.STRUCTURES}, {ad.INTRON_PART}, {ad.PROT},
pairs AS (SELECT st.seqid, st.strand, st.chain, p.n AS pn, CASE WHEN p.s < st.s OR p.e > st.e THEN 'beyond'
  WHEN len(list_filter(range(1, st.n), lambda i: st.segs[i].e + 1 = p.s AND st.segs[i + 1].s - 1 = p.e)) > 0 THEN 'exact'
  WHEN len(list_filter(st.segs, lambda x: x.s <= p.s AND p.e <= x.e)) > 0 THEN 'extra' ELSE 'shifted' END AS kind
  FROM structs st JOIN prot p ON st.seqid = p.seqid AND st.strand = p.strand AND p.s <= st.e AND st.s <= p.e)
SELECT seqid AS contig, strand, chain, COUNT(*) FILTER (kind <> 'beyond') AS in_span, COUNT(*) FILTER (kind = 'extra') AS extra, COALESCE(MAX(pn) FILTER (kind = 'extra'), 0) AS extra_n, COUNT(*) FILTER (kind = 'shifted') AS shifted, COALESCE(MAX(pn) FILTER (kind = 'shifted'), 0) AS shifted_n,
  COUNT(*) FILTER (kind = 'beyond') AS beyond, COALESCE(MAX(pn) FILTER (kind = 'beyond'), 0) AS beyond_n FROM pairs GROUP BY ALL""")
def protein_conflicts(spark, d):
    s = co.add_conflicts(ad.structures(spark, d), ad.protein_hints(spark, d), BIN).filter("prot_hints_in_span + prot_beyond > 0")
    names = dict(zip(co.CONFLICTS, ["in_span", "extra", "extra_n", "shifted", "shifted_n", "beyond", "beyond_n"], strict=True))
    return s.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), *[F.col(c).alias(n) for c, n in names.items()])


@query("codon_hints", f"""WITH {ad.STRUCTURES}, hint AS (SELECT DISTINCT seqid, CASE WHEN tx % 2 = 0 THEN s ELSE e - 2 END AS pos, CASE WHEN tx % 3 = 0 THEN 'start' ELSE 'stop' END AS kind FROM chains WHERE tx % 5 = 0),
p AS (SELECT *, CASE WHEN strand = '+' THEN s ELSE e - 2 END AS p1, CASE WHEN strand = '+' THEN e - 2 ELSE s END AS p2 FROM structs)
SELECT p.seqid AS contig, strand, chain, CASE WHEN (SELECT COUNT(*) FROM hint) = 0 THEN NULL WHEN EXISTS (SELECT 1 FROM hint h WHERE h.kind = 'start' AND h.seqid = p.seqid AND h.pos = p.p1) THEN 1 ELSE 0 END::BIGINT AS prot_start,
  CASE WHEN (SELECT COUNT(*) FROM hint) = 0 THEN NULL WHEN EXISTS (SELECT 1 FROM hint h WHERE h.kind = 'stop' AND h.seqid = p.seqid AND h.pos = p.p2) THEN 1 ELSE 0 END::BIGINT AS prot_stop FROM p""")
def codon_hints(spark, d):
    c = ad.chains(spark, d).filter("tx % 5 = 0")
    hint = c.select("contig", F.expr("CASE WHEN tx % 2 = 0 THEN segs[0].start ELSE element_at(segs, -1).end - 2 END").alias("pos"), F.expr("CASE WHEN tx % 3 = 0 THEN 'start' ELSE 'stop' END").alias("kind"))
    return co.add_codons(ad.structures(spark, d), hint).select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "prot_start", "prot_stop")


@query("identical_models", f"WITH {ad.STRUCTURES} SELECT seqid AS contig, strand, chain, CASE WHEN EXISTS (SELECT 1 FROM chains c WHERE c.tx % 7 = 0 AND c.seqid = st.seqid AND c.strand = st.strand AND c.chain = st.chain) THEN 1 ELSE 0 END::BIGINT AS matched FROM structs st")
def identical_models(spark, d):
    s = co.add_match(ad.structures(spark, d), ad.chains(spark, d).filter("tx % 7 = 0"), "matched")
    return s.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "matched")


@query("structure_hits", f"""WITH {ad.STRUCTURES}, h AS (SELECT 't' || (l_orderkey % 4) AS tool, l_orderkey || CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE '.p1' END AS query, CAST(MAX(ROUND(l_extendedprice * 100)) AS BIGINT) AS bits FROM lineitem GROUP BY ALL),
m AS (SELECT s.seqid, s.strand, s.chain, COALESCE(h1.bits, h2.bits) AS bits FROM sets s LEFT JOIN h h1 ON h1.tool = s.tool AND h1.query = CAST(s.tx AS VARCHAR) LEFT JOIN h h2 ON h2.tool = s.tool AND h2.query = s.tx || '.p1')
SELECT seqid AS contig, strand, chain, MAX(bits) AS bits, CASE WHEN MAX(bits) IS NULL THEN 0 ELSE 1 END::BIGINT AS hit FROM m GROUP BY ALL""")
def structure_hits(spark, d):
    li = ad.table(spark, d, "lineitem")
    h = li.groupBy(F.expr("concat('t', l_orderkey % 4)").alias("tool"), F.expr("concat(l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE '.p1' END)").alias("query")).agg(F.max(F.expr("round(l_extendedprice * 100)")).cast("bigint").alias("bits"))
    s = co.add_hits(ad.structures(spark, d), h.withColumn("hit", F.struct("query")))
    return s.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), F.col("dmd_bits").alias("bits"), F.col("dmd_hit").alias("hit"))


@query("tier_table", f"""WITH {ad.STRUCTURES}, tt(tools, cls, tier) AS (VALUES ('t0', 'e1', 1.5), ('t0', '*', 4.0), ('t0,t1', '*', 8.5), ('t2', 'e5', 2.0)),
k AS (SELECT *, CASE WHEN n = 1 THEN 'e1' WHEN n <= 4 THEN 'e2_4' ELSE 'e5' END AS cls FROM structs)
SELECT k.seqid AS contig, k.strand, k.chain, CAST(10 * COALESCE(a.tier, b.tier, 0) AS BIGINT) AS tier10 FROM k LEFT JOIN tt a ON a.tools = k.tools AND a.cls = k.cls LEFT JOIN tt b ON b.tools = k.tools AND b.cls = '*'""")
def tier_table(spark, d):
    t = spark.createDataFrame([("t0", "e1", 1.5), ("t0", "*", 4.0), ("t0,t1", "*", 8.5), ("t2", "e5", 2.0)], "tools string, struct_class string, tier double")
    return co.table_tier(ad.structures(spark, d), t).select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), (F.col("tier") * 10).cast("bigint").alias("tier10"))


@query("cluster_context", f"""WITH {TIERED}, f AS (SELECT cluster, seqid, strand, chain, tier, n_tools, len, CASE WHEN len % 4 = 0 THEN NULL ELSE len % 11 END AS hit, CASE WHEN n > 1 THEN n % 3 END AS rf FROM numbered)
SELECT seqid AS contig, strand, chain, COUNT(*) OVER w AS cl_n, CAST(MAX(tier) OVER w AS BIGINT) AS cl_maxtier, CAST(tier - MAX(tier) OVER w AS BIGINT) AS tier_gap, CAST(n_tools - MAX(n_tools) OVER w AS BIGINT) AS ntools_gap, CAST(MAX(hit) OVER w AS BIGINT) AS top_bits, CAST(COALESCE(rf, 1) - COALESCE(MAX(rf) OVER w, 1) AS BIGINT) AS rf_rel FROM f WINDOW w AS (PARTITION BY cluster)""")
def cluster_context(spark, d):
    s = co.assign_tiers(co.add_loci(ad.structures(spark, d)), PLAIN)
    f = s.select("cluster", "contig", "strand", "segs", "base_tier", F.size("tools").alias("n_tools"), "cds_len", F.expr("CASE WHEN cds_len % 4 = 0 THEN NULL ELSE cast(cds_len % 11 as double) END").alias("dmd_bits"), F.expr("CASE WHEN n_exons > 1 THEN cast(n_exons % 3 as double) END").alias("rna_frac"))
    f = f.withColumns({"lr_dev": F.lit(None).cast("double"), "prot_intron_frac": F.lit(None).cast("double"), "dmd_hit": F.lit(1), "log_mult": F.lit(None).cast("double")})
    c = co.cluster_context(f).withColumn("top_bits", F.max("dmd_bits").over(Window.partitionBy("cluster")))
    whole = [F.col(x).cast("bigint").alias(n) for x, n in (("cl_n", "cl_n"), ("cl_maxtier", "cl_maxtier"), ("tier_gap", "tier_gap"), ("ntools_gap", "ntools_gap"), ("top_bits", "top_bits"), ("rna_frac_rel", "rf_rel"))]
    return c.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), *whole)


@query("model_selection", f"""WITH {TIERED}, p AS (SELECT *, (len * 7 + n * 13) % 101 AS p100, n = 1 AND tools = 't0' AS uns, n > 2 AND len % 2 = 0 AS res FROM numbered),
r1 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY CASE WHEN uns THEN -100 ELSE p100 END DESC, segs) AS r FROM p),
r2 AS (SELECT *, MAX(CASE WHEN r = 1 THEN NOT uns AND p100 >= 60 END) OVER (PARTITION BY cluster) AS op, MIN(CASE WHEN res AND NOT uns THEN r END) OVER (PARTITION BY cluster) AS alt FROM r1),
r3 AS (SELECT *, NOT op AND alt IS NOT NULL AS saved, CASE WHEN NOT op AND r = alt THEN 1 WHEN NOT op AND r < alt THEN r + 1 ELSE r END AS rk FROM r2)
SELECT cluster, seqid AS contig, strand, chain, CAST(rk AS BIGINT) AS rank, CASE WHEN uns THEN 'dropped_lone_single_exon' WHEN NOT op AND NOT saved THEN 'locus_below_min' WHEN rk = 1 AND saved THEN 'primary_protein_rescue' WHEN rk = 1 THEN 'primary' WHEN p100 >= 30 THEN 'isoform_classifier' ELSE 'isoform_rejected' END AS why FROM r3""")
def model_selection(spark, d):
    s = co.add_loci(ad.structures(spark, d)).withColumn("p", F.expr("(cds_len * 7 + n_exons * 13) % 101 / 100"))
    s = s.withColumn("unselectable", F.expr("n_exons = 1 AND array_join(tools, ',') = 't0'")).withColumn("rescuable", F.expr("n_exons > 2 AND cds_len % 2 = 0"))
    return co.select_model(s, 0.6, 0.3, ["segs"]).select("cluster", "contig", "strand", co.chain_text(F.col("segs")).alias("chain"), "rank", "why")


@query("model_features", f"""WITH {TIERED}, {ad.INTRON_PART}, {ad.RNA},
si AS (SELECT chain, seqid, strand, segs[i].e + 1 AS s, segs[i + 1].s - 1 AS e FROM structs, UNNEST(range(1, n)) AS u(i)),
ev AS (SELECT si.seqid, si.strand, si.chain, MIN(COALESCE(rna.mult, 0)) AS mm, COUNT(*) FILTER (COALESCE(rna.mult, 0) >= 2) AS ok FROM si LEFT JOIN rna USING (seqid, s, e) GROUP BY ALL),
f AS (SELECT m.*, LN(1 + ev.mm) AS lm, CAST(printf('%.3f', CASE WHEN n > 1 THEN ok / (n - 1) END) AS DOUBLE) AS rf FROM numbered m LEFT JOIN ev USING (seqid, strand, chain)),
ref AS (SELECT COALESCE(MEDIAN(lm) FILTER (n_tools = (SELECT MAX(n_tools) FROM f)), 0) AS r FROM f)
SELECT seqid AS contig, strand, chain, n_tools, CASE WHEN dt THEN 1 ELSE 0 END AS dt, CAST(ROUND(1000000 * LOG10(len)) AS BIGINT) AS log_len, CAST(ROUND(1000000 * (lm - r)) AS BIGINT) AS mult_rel, CAST(ROUND(1000 * (COALESCE(rf, 1) - COALESCE(MAX(rf) OVER w, 1))) AS BIGINT) AS frac_rel,
  COUNT(*) OVER w AS cl_n, CAST(MAX(tier) OVER w AS BIGINT) AS cl_maxtier, CAST(ROUND(1000000 * len / MAX(len) OVER w) AS BIGINT) AS len_rel FROM f, ref WINDOW w AS (PARTITION BY cluster)""")
def model_features(spark, d):
    s = co.add_rna(co.add_loci(ad.structures(spark, d)), ad.rna_hints(spark, d), None)
    f = co.model_features(co.assign_tiers(s, PLAIN), PLAIN.roles)
    big = lambda c, k=1: F.round(F.col(c) * k).cast("bigint")
    return f.select("contig", "strand", co.chain_text(F.col("segs")).alias("chain"), F.col("n_tools").cast("bigint").alias("n_tools"), "dt", big("log_cds_len", 1000000).alias("log_len"), big("log_mult_rel", 1000000).alias("mult_rel"), big("rna_frac_rel", 1000).alias("frac_rel"), "cl_n", big("cl_maxtier").alias("cl_maxtier"), big("len_rel_cluster", 1000000).alias("len_rel"))
