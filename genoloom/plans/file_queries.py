"""Formats: tables written as text, read back by the scans, and compared with the tables they came from."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import attrs as at
from ..operators import genemodel as gm
from ..operators import hints as hi
from ..operators import support as su
from ..operators.components import shared_folder
from ..sinks import writers as wr
from ..sources import scans as sc
from . import adapter as ad
from .registry import query


def _path(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _text(df, *parts) -> str:
    """Writes lines of tab-separated parts, one file for each task; where they are."""
    path = _path(df.sparkSession)
    df.select(F.concat_ws("\t", *[p if not isinstance(p, str) else F.lit(p) for p in parts]).alias("line")).write.text(path)
    return path


@query("scan_gtf", f"WITH {ad.EXONS} SELECT 'g' || (tx % 7) AS gene, 't' || tx AS tx, seqid, strand, CAST(s AS BIGINT) AS start_, CAST(e AS BIGINT) AS end_, tx % 9 / 4.0 AS cov FROM exons")
def scan_gtf(spark, d):
    x = ad.exons(spark, d)
    path = _text(x, F.col("seqid"), "asm", "exon", F.col("start"), F.col("end"), ".", F.col("strand"), ".", F.expr("concat('gene_id \"g', tx % 7, '\"; transcript_id \"t', tx, '\"; cov \"', tx % 9 / 4, '\";')"))
    return sc.gtf(spark, path).select(F.col("gene_id").alias("gene"), F.col("transcript_id").alias("tx"), "seqid", "strand", F.col("start").alias("start_"), F.col("end").alias("end_"), "cov")


@query("scan_gtf_transcripts", f"WITH {ad.EXONS} SELECT 't' || tx AS tx, ANY_VALUE(seqid) AS seqid, ANY_VALUE(strand) AS strand, COUNT(*) AS n, CAST(MIN(s) AS BIGINT) AS start_, CAST(MAX(e) AS BIGINT) AS end_ FROM exons GROUP BY tx")
def scan_gtf_transcripts(spark, d):
    path = _path(spark)
    x = ad.exons(spark, d)
    wr.write_gtf(x.select(F.lit("g").alias("gene_id"), F.concat(F.lit("t"), "tx").alias("tx_id"), "seqid", "strand", F.lit("exon").alias("type"), "start", "end", F.lit(None).cast("string").alias("phase")), path, parts=True)
    t = sc.gtf_transcripts(spark, path)
    return t.select(F.col("tx_id").alias("tx"), "seqid", "strand", F.size("exons").cast("bigint").alias("n"), F.get("exons", F.lit(0))["start"].alias("start_"), F.try_element_at("exons", F.lit(-1))["end"].alias("end_"))


@query("scan_gff3", f"WITH {ad.EXONS} SELECT 'x;' || tx || ',' || s AS id, 't' || tx AS parent, 'u%' || (tx % 5) AS second, 'a=b & c' AS note, seqid, CAST(s AS BIGINT) AS start_, CAST(e AS BIGINT) AS end_ FROM exons")
def scan_gff3(spark, d):
    entry = lambda k, *v: F.struct(F.lit(k).alias("key"), F.array(*v).alias("values"))
    attrs = F.array(entry("ID", F.concat(F.lit("x;"), "tx", F.lit(","), "start")), entry("Parent", F.concat(F.lit("t"), "tx"), F.expr("concat('u%', tx % 5)")), entry("note", F.lit("a=b & c")))
    x = ad.exons(spark, d).withColumn("attrs", attrs)
    f = sc.gff3(spark, _text(x, F.col("seqid"), "src", "exon", F.col("start"), F.col("end"), ".", F.col("strand"), ".", at.format_attributes(F.col("attrs"))))
    return f.select("id", F.get("parents", F.lit(0)).alias("parent"), F.get("parents", F.lit(1)).alias("second"), at.get_first(F.col("attrs"), "note").alias("note"), "seqid", F.col("start").alias("start_"), F.col("end").alias("end_"))


@query("scan_gff3_transcripts", f"WITH {ad.EXONS} SELECT 't' || tx AS tx, 'g' || (tx % 7) AS gene, COUNT(*) AS n, CAST(SUM(e - s + 1) AS BIGINT) AS bases FROM exons GROUP BY tx")
def scan_gff3_transcripts(spark, d):
    x = ad.exons(spark, d)
    t = x.groupBy("tx", "seqid", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(*x.columns, F.lit("mRNA").alias("type"), F.expr("concat('ID=t', tx, ';Parent=g', tx % 7)").alias("a"))
    g = t.groupBy("seqid", "strand", F.expr("tx % 7").alias("tx")).agg(F.min("start").alias("start"), F.max("end").alias("end")).select(*x.columns, F.lit("gene").alias("type"), F.expr("concat('ID=g', tx)").alias("a"))
    f = x.withColumn("type", F.lit("exon")).withColumn("a", F.expr("concat('Parent=t', tx)")).unionByName(t).unionByName(g.dropDuplicates(["tx"]))
    out = sc.gff3_transcripts(spark, _text(f, F.col("seqid"), "src", F.col("type"), F.col("start"), F.col("end"), ".", F.col("strand"), ".", F.col("a")))
    bases = F.aggregate("exons", F.lit(0).cast("bigint"), lambda a, e: a + e["end"] - e["start"] + 1)
    return out.select(F.col("tx_id").alias("tx"), F.col("gene_id").alias("gene"), F.size("exons").cast("bigint").alias("n"), bases.alias("bases"))


def _hint_lines(spark, d) -> str:
    i = ad.tx_introns(spark, d)
    kind = F.expr("CASE WHEN tx % 7 = 0 THEN 'intronpart' WHEN tx % 7 = 1 THEN 'CDSpart' WHEN tx % 7 = 2 THEN 'start' ELSE 'intron' END")
    src = F.expr("array('E', 'P', 'C', 'M', 'b2h', 'PH')[cast(tx % 6 as int)]")
    swap = F.expr("tx % 5 = 0")
    mult = F.expr("CASE WHEN tx % 4 = 0 THEN '' ELSE concat('mult=', 1 + tx % 4, ';') END")
    return _text(i, F.col("contig"), "prog", kind, F.when(swap, F.col("end")).otherwise(F.col("start")), F.when(swap, F.col("start")).otherwise(F.col("end")), F.expr("CAST(tx % 3 AS STRING)"), F.col("strand"), ".", F.concat(mult, F.lit("pri=4;src="), src))


HINT_ROWS = f"""{ad.INTRONS}, h AS (SELECT tx, seqid, strand, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, CASE WHEN tx % 7 = 0 THEN 'intronpart' WHEN tx % 7 = 1 THEN 'CDSpart' WHEN tx % 7 = 2 THEN 'start' ELSE 'intron' END AS type,
 (['E', 'P', 'C', 'M', 'b2h', 'PH'])[1 + tx % 6] AS src, CASE WHEN tx % 4 = 0 THEN 1 ELSE 1 + tx % 4 END AS mult, tx % 3 AS score FROM introns)"""


@query("scan_hints", f"WITH {HINT_ROWS} SELECT seqid, strand, s AS start_, e AS end_, type, src, mult, CASE WHEN src IN ('E', 'b2h') THEN 'rna' WHEN src IN ('P', 'PH') THEN 'protein' WHEN src = 'C' THEN 'combined' ELSE 'other' END AS class, 4 AS pri FROM h")
def scan_hints(spark, d):
    return sc.hints(spark, _hint_lines(spark, d)).select("seqid", "strand", F.col("start").alias("start_"), F.col("end").alias("end_"), "type", "src", "mult", "class", "pri")


@query("scan_support_hints", f"WITH {HINT_ROWS} SELECT seqid, strand, s AS start_, e AS end_, CASE WHEN type = 'intron' THEN 'intron' ELSE 'exon' END AS kind, CASE WHEN src IN ('E', 'b2h') THEN 'rna' WHEN src IN ('P', 'PH') THEN 'protein' WHEN src = 'C' THEN 'combined' ELSE 'other' END AS class FROM h WHERE type IN ('intron', 'CDSpart')")
def scan_support_hints(spark, d):
    return sc.support_hints(spark, _hint_lines(spark, d)).select("seqid", "strand", F.col("start").alias("start_"), F.col("end").alias("end_"), "kind", "class")


@query("scan_intron_hints", f"WITH {HINT_ROWS} SELECT seqid AS contig, s AS start_, e AS end_, CAST(SUM(mult) AS BIGINT) AS mult FROM h WHERE type IN ('intron', 'intronpart') GROUP BY ALL")
def scan_intron_hints(spark, d):
    return sc.intron_hints(spark, _hint_lines(spark, d)).select("contig", F.col("start").alias("start_"), F.col("end").alias("end_"), "mult")


@query("scan_protein_hints", f"WITH {HINT_ROWS} SELECT seqid AS contig, strand, s AS start_, e AS end_, score AS n FROM h WHERE type IN ('intron', 'intronpart')")
def scan_protein_hints(spark, d):
    return sc.protein_hints(spark, _hint_lines(spark, d))[0].select("contig", "strand", F.col("start").alias("start_"), F.col("end").alias("end_"), "n")


@query("scan_bedgraph", f"WITH {ad.EXONS} SELECT seqid AS contig, CAST(s AS BIGINT) AS start_, CAST(e AS BIGINT) AS end_, (1 + tx % 9) / 8.0 AS depth FROM exons WHERE tx % 9 >= 2")
def scan_bedgraph(spark, d):
    path = _path(spark)
    wr.write_bedgraph(ad.exons(spark, d).select(F.col("seqid").alias("contig"), "start", "end", F.expr("(1 + tx % 9) / 8").alias("depth")), path, parts=True)
    return sc.bedgraph(spark, path, 0.3).select("contig", F.col("start").alias("start_"), F.col("end").alias("end_"), "depth")


def _hit_query(layout: int):
    names = {"qseqid": "concat('q', l_orderkey)", "sseqid": "concat(l_suppkey, '_', l_partkey)", "pident": "l_linenumber / 2", "length": "l_partkey", "mismatch": "1", "gapopen": "0", "qstart": "1 + l_partkey % 9", "qend": "90", "sstart": "1 + l_suppkey % 5", "send": "80", "evalue": "'1e-5'", "bitscore": "l_linenumber / 4", "qlen": "100", "slen": "CASE WHEN l_partkey % 9 = 0 THEN 'none' ELSE '200' END"}
    cols = sc.LAYOUTS[layout]
    slen = ", CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 200::BIGINT END AS slen" if "slen" in cols else ""

    @query(f"scan_hits_{layout}", f"SELECT 'q' || l_orderkey AS query, l_suppkey || '_' || l_partkey AS subject, l_linenumber / 2.0 AS pident, l_partkey AS length, 1e-5::DOUBLE AS evalue, l_linenumber / 4.0 AS bitscore{slen} FROM lineitem")
    def scan(spark, d):
        path = _text(ad.table(spark, d, "lineitem"), *[F.expr(f"cast({names[c]} as string)") for c in cols])
        return sc.tabular_hits(spark, path).select("query", "subject", "pident", "length", "evalue", "bitscore", *(["slen"] if slen else []))


for _layout in (14, 12, 8):
    _hit_query(_layout)


@query("scan_fasta", f"WITH {ad.SEQS} SELECT 's' || id AS id, 'text ' || id AS description, CAST(length(seq) AS BIGINT) AS length, md5(seq) AS sum_ FROM seqs")
def scan_fasta(spark, d):
    path = _path(spark)
    wr.write_fasta(ad.sequences(spark, d).select(F.concat(F.lit("s"), "id").alias("id"), F.concat(F.lit("text "), "id").alias("description"), F.lower("seq").alias("seq")), path)
    return sc.fasta(spark, path).select("id", "description", "length", F.md5(F.col("seq")).alias("sum_"))


@query("scan_cmscan", "SELECT 'RF' || l_partkey AS accession, 'c' || (l_suppkey % 9) AS seqid, LEAST(l_partkey, l_orderkey) AS start_, GREATEST(l_partkey, l_orderkey) AS end_, CASE WHEN l_partkey <= l_orderkey THEN '+' ELSE '-' END AS strand, l_quantity AS score FROM lineitem WHERE l_linenumber <> 2 AND l_linenumber <> 3")
def scan_cmscan(spark, d):
    f = ["1", "'fam'", "concat('RF', l_partkey)", "concat('c', l_suppkey % 9)", "'-'", "'cl'", "'cm'", "1", "90", "l_partkey", "l_orderkey", "CASE WHEN l_partkey <= l_orderkey THEN '+' ELSE '-' END", "'no'", "1", "0.5", "0.0", "l_quantity", "'1e-9'", "CASE WHEN l_linenumber = 2 THEN '?' ELSE '!' END", "CASE WHEN l_linenumber = 3 THEN '=' ELSE '*' END", *["'-'"] * 7, "'a text'"]
    path = _path(spark)
    ad.table(spark, d, "lineitem").select(F.concat_ws("  ", *[F.expr(f"cast({x} as string)") for x in f])).write.text(path)
    return sc.cmscan(spark, path).select("accession", "seqid", F.col("start").alias("start_"), F.col("end").alias("end_"), "strand", "score")


@query("scan_families", "SELECT 'RF' || p_partkey AS accession, 'Gene; ' || p_brand || ';' AS kind FROM part")
def scan_families(spark, d):
    p = ad.table(spark, d, "part").select(F.expr("concat('RF', p_partkey, '\t', p_name, '\tGene; ', p_brand, ';\tmore')").alias("line"))
    path = _path(spark)
    p.unionByName(spark.createDataFrame([("# rows",), ("rfam_acc\trfam_id\ttype\tx",)], "line string")).write.text(path)
    return sc.family_types(spark, path)


@query("rna_families", """SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'riboswitch' WHEN p_partkey % 5 = 1 THEN 'autocatalytically_spliced_intron' WHEN p_partkey % 5 = 2 THEN 'lnc_RNA' WHEN p_partkey % 5 = 3 THEN 'snoRNA' ELSE 'ncRNA' END AS feature, CASE WHEN p_partkey % 5 = 2 THEN 'lncRNA' WHEN p_partkey % 5 = 3 THEN 'snoRNA' WHEN p_partkey % 5 = 4 THEN 'ncRNA' END AS biotype FROM part""")
def rna_families(spark, d):
    from ..operators.annotate import rna_class

    kind = F.expr("array('Cis-reg; riboswitch;', 'Intron;', 'Gene; lncRNA;', 'Gene; snRNA; snoRNA; CD-box;', 'Gene; other;')[cast(p_partkey % 5 as int)]")
    return ad.table(spark, d, "part").withColumn("c", rna_class(kind)).select(F.col("p_partkey").alias("id"), "c.feature", "c.biotype")


@query("scan_terms", "SELECT 'p' || user_id AS accession, event_type AS term, CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE value END AS score, 'a, \"b\"' AS description, 'F' AS category FROM events")
def scan_terms(spark, d):
    path = _path(spark)
    e = ad.table(spark, d, "events").select(F.concat(F.lit("p"), "user_id").alias("query_accession"), F.col("event_type").alias("go_id"), F.expr("CASE WHEN event_id % 5 = 0 THEN 'none' ELSE cast(value as string) END").alias("reliability_index"), F.lit('a, "b"').alias("go_description"), F.lit("F").alias("category"))
    e.write.option("header", True).option("escape", '"').csv(path)
    return sc.term_table(spark, path)


@query("scan_tiers", "SELECT p_brand || p_partkey AS tools, CASE WHEN p_size % 2 = 0 THEN '*' ELSE 'multi' END AS struct_class, p_size / 4.0 AS tier FROM part")
def scan_tiers(spark, d):
    path = _path(spark)
    ad.table(spark, d, "part").select(F.expr("concat(p_brand, p_partkey)").alias("tools"), F.expr("CASE WHEN p_size % 2 = 0 THEN '*' ELSE 'multi' END").alias("struct_class"), F.expr("p_size / 4").alias("tier")).coalesce(1).write.option("sep", "\t").option("header", True).csv(path)
    return sc.tier_table(spark, path)


@query("scan_accuracy", "SELECT s_suppkey AS id, 'intron chain' AS level, s_suppkey % 100 / 2.0 AS sensitivity, s_suppkey % 50 / 4.0 AS precision_ FROM supplier")
def scan_accuracy(spark, d):
    path = _path(spark)
    text = F.expr("concat('#= ', s_suppkey, '\nIntron chain level:    ', s_suppkey % 100 / 2, '     |    ', s_suppkey % 50 / 4, '    |')")
    ad.table(spark, d, "supplier").coalesce(1).select(text).write.text(path)
    from pyspark.sql import Window

    raw = sc.lines(spark, path).filter("value LIKE '#= %'").select("file_ord", F.col("line_no").alias("line_no"), F.expr("cast(substring(value, 4) as bigint)").alias("id"))
    return sc.accuracy_stats(spark, path).withColumn("line_no", F.col("line_no") - 1).join(raw, ["file_ord", "line_no"]).select("id", "level", "sensitivity", F.col("precision").alias("precision_"))


@query("scan_completeness", "SELECT ROW_NUMBER() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS file, 40.5 AS single, 9.5 AS duplicated, 50.0 AS complete, CASE WHEN s_suppkey % 2 = 0 THEN 7.0 ELSE 7.5 END AS fragmented, 43.0 AS missing, 255::BIGINT AS n FROM supplier")
def scan_completeness(spark, d):
    """A file for each summary, in either form."""
    path = _path(spark)
    s = ad.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.expr("CASE WHEN s_suppkey % 2 = 0 THEN 'C:50.0%[S:40.5%,D:9.5%],F:7.0%,M:43.0%,n:255' ELSE 'S:40.5%, 103\nD: 9.5%, 24\nF:5.0%, 13\nI:2.5%, 5\nM:43.0%, 110\nN:255' END").alias("line"))
    s.repartition(8, "id").write.partitionBy("id").text(path)
    return sc.completeness(spark, f"{path}/id=*").select(F.col("file_ord").alias("file"), "single", "duplicated", "complete", "fragmented", "missing", "n")


@query("scan_tsv", "SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, '' AS none FROM customer")
def scan_tsv(spark, d):
    path = _path(spark)
    c = ad.table(spark, d, "customer").select(F.concat_ws("\t", "c_name", F.col("c_nationkey").cast("string"), F.lit("")).alias("line"))
    spark.createDataFrame([("# a comment",), ("name\tnation\tnone",)], "line string").coalesce(1).union(c.coalesce(1)).coalesce(1).write.text(path)
    return sc.tsv(spark, path)[1].drop("line_no")


@query("normalized_models", f"""WITH {ad.EXONS}, b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tx ORDER BY s) AS i, COUNT(*) OVER (PARTITION BY tx) AS n, COALESCE(SUM(e - s + 1) OVER (PARTITION BY tx ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM exons)
SELECT 't' || tx || '.exon' || i AS id, 'exon' AS type, CAST(s AS BIGINT) AS start_, CAST(e AS BIGINT) AS end_, NULL::BIGINT AS phase, 't' || tx AS parent, NULL AS biotype FROM b
UNION ALL SELECT 't' || tx || '.cds', 'CDS', s, e, CAST(((tx % 3 - done) % 3 + 3) % 3 AS BIGINT), 't' || tx, NULL FROM b WHERE tx % 4 <> 0
UNION ALL SELECT 't' || tx, CASE WHEN tx % 4 <> 0 THEN 'mRNA' ELSE 'transcript' END, MIN(s), MAX(e), NULL, 'g' || tx, NULL FROM b GROUP BY tx UNION ALL SELECT 'g' || tx, 'gene', MIN(s), MAX(e), NULL, NULL, CASE WHEN tx % 4 <> 0 THEN 'protein_coding' END FROM b GROUP BY tx""")
def normalized_models(spark, d):
    """Coding transcripts without exons get them from their coding parts."""
    x = ad.exons(spark, d).withColumns({"gene_id": F.concat(F.lit("g"), "tx"), "tx_id": F.concat(F.lit("t"), "tx")})
    f = x.filter("tx % 4 <> 0").withColumn("type", F.lit("CDS")).unionByName(x.filter("tx % 4 = 0").withColumn("type", F.lit("exon"))).withColumn("phase", F.expr("cast(tx % 3 as string)"))
    out, _ = gm.normalize(f.drop("tx"))
    return out.select("id", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), "phase", "parent", "biotype")


@query("contract_violations", f"""WITH {ad.EXONS} SELECT DISTINCT 'cds_outside_exon' AS rule, 't' || tx AS feature FROM exons WHERE tx % 3 = 0 AND s % 2 = 0 UNION ALL SELECT DISTINCT 'strand', 't' || tx FROM exons WHERE tx % 5 = 0 AND EXISTS (SELECT 1 FROM exons y WHERE y.tx = exons.tx AND y.s <> exons.s)""")
def contract_violations(spark, d):
    from pyspark.sql import Window

    x = ad.exons(spark, d).withColumns({"gene_id": F.concat(F.lit("g"), "tx"), "tx_id": F.concat(F.lit("t"), "tx"), "type": F.lit("exon")})
    flip = F.expr("tx % 5 = 0") & (F.row_number().over(Window.partitionBy("tx").orderBy("start")) == 1)
    c = x.filter("tx % 3 = 0 AND start % 2 = 0").withColumns({"type": F.lit("CDS"), "end": F.col("end") + 1})
    f = x.withColumn("strand", F.when(flip, F.when(F.col("strand") == "+", "-").otherwise("+")).otherwise(F.col("strand"))).unionByName(c)
    one = f.groupBy("tx_id").agg(F.count_distinct("strand").alias("n"))
    bad = gm.normalize(f.drop("tx"))[1].filter("rule IN ('cds_outside_exon', 'strand')")
    return bad.filter("rule <> 'strand'").select("rule", "feature").unionByName(bad.filter("rule = 'strand'").join(one, F.col("feature") == F.col("tx_id"), "left_semi").join(x.filter("tx % 5 = 0").select("tx_id").distinct(), F.col("feature") == F.col("tx_id"), "left_semi").select("rule", "feature"))


@query("contract_lines", f"""WITH {ad.EXONS} SELECT seqid || chr(9) || 'genoloom' || chr(9) || 'exon' || chr(9) || s || chr(9) || e || chr(9) || '.' || chr(9) || strand || chr(9) || '.' || chr(9) || 'ID=t' || tx || '.x' || s || ';Parent=t' || tx || ';note=a%3Bb;tag=' || (tx % 3) AS line FROM exons""")
def contract_lines(spark, d):
    """Attributes besides ID and Parent stay."""
    x = ad.exons(spark, d).withColumns({"gene_id": F.concat(F.lit("g"), "tx"), "tx_id": F.concat(F.lit("t"), "tx"), "type": F.lit("exon"), "phase": F.lit(None).cast("bigint"), "biotype": F.lit(None).cast("string")})
    x = x.withColumns({"id": F.concat("tx_id", F.lit(".x"), "start"), "parent": F.col("tx_id"), "attrs": at.parse_attributes(F.expr("concat('ID=old;note=a%3Bb;Parent=old;tag=', tx % 3)"))})
    return wr.gff3_lines(x).select("line")


@query("merged_features", f"""WITH {ad.EXONS}, t AS (SELECT tx, ROW_NUMBER() OVER (ORDER BY tx) AS g FROM (SELECT DISTINCT tx FROM exons)), b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tx ORDER BY s) AS i, printf('gene_%06d', g) AS gene,
 COALESCE(SUM(e - s + 1) OVER (PARTITION BY tx ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM exons JOIN t USING (tx))
SELECT gene || '.t1.exon' || i AS id, 'exon' AS type, CAST(s AS BIGINT) AS start_, CAST(e AS BIGINT) AS end_, NULL::BIGINT AS phase FROM b UNION ALL SELECT gene || '.t1.cds' || i, 'CDS', s, e, CAST((3 - done % 3) % 3 AS BIGINT) FROM b WHERE tx % 2 = 0
UNION ALL SELECT gene || '.t1', CASE WHEN tx % 2 = 0 THEN 'mRNA' ELSE 'transcript' END, MIN(s), MAX(e), NULL FROM b GROUP BY gene, tx UNION ALL SELECT gene, 'gene', MIN(s), MAX(e), NULL FROM b GROUP BY gene""")
def merged_features(spark, d):
    from pyspark.sql import Window

    c = ad.chains(spark, d)
    number = c.select("tx", F.row_number().over(Window.orderBy("tx")).alias("gene"))  # the test's own numbers
    t = c.join(number, "tx").select("gene", F.lit(1).alias("isoform"), F.col("contig").alias("seqid"), "strand", F.col("segs").alias("exons"), F.when(F.expr("tx % 2 = 0"), F.col("segs")).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("cds"))
    return gm.merged_features(t).select("id", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), "phase")


@query("support_totals", f"""WITH {ad.INTRONS}, i AS (SELECT tx, COUNT(*) AS n, COUNT(*) FILTER (tx % 4 IN (0, 2)) AS rna, COUNT(*) FILTER (tx % 4 IN (1, 2)) AS prot, COUNT(*) FILTER (tx % 4 < 3) AS any_, COUNT(*) FILTER (tx % 4 = 2) AS both_ FROM introns GROUP BY tx), t AS (SELECT DISTINCT tx FROM exons), j AS (SELECT t.tx, COALESCE(n, 0) AS n, COALESCE(rna, 0) AS rna, COALESCE(prot, 0) AS prot, COALESCE(any_, 0) AS any_, COALESCE(both_, 0) AS both_ FROM t LEFT JOIN i USING (tx))
SELECT COUNT(*) AS transcripts, COUNT(*) FILTER (n = 0) AS single_exon, COUNT(*) FILTER (n > 0 AND any_ = n) AS fully, COUNT(*) FILTER (n > 0 AND any_ = 0) AS none, CAST(SUM(n) AS BIGINT) AS introns, CAST(SUM(rna) AS BIGINT) AS introns_rna, CAST(SUM(prot) AS BIGINT) AS introns_protein, CAST(SUM(both_) AS BIGINT) AS introns_both, CAST(SUM(any_) AS BIGINT) AS introns_any FROM j""")
def support_totals(spark, d):
    classes = F.expr("CASE tx % 4 WHEN 0 THEN array('rna') WHEN 1 THEN array('protein') WHEN 2 THEN array('combined') ELSE cast(array() as array<string>) END")
    i = ad.tx_introns(spark, d).withColumn("classes", classes)
    x = ad.exons(spark, d).withColumns({"rna": F.lit(True), "protein": F.lit(False)})
    return su.support_totals(i, x).select("transcripts", "single_exon", "fully", "none", *su.SUPPORT_TOTALS[5:10])


@query("support_summary", "SELECT 0 AS ord, '# Gene support summary' AS line UNION ALL SELECT 1, '# Transcripts: ' || COUNT(*) FROM orders UNION ALL SELECT 2, '#   Single-exon (no introns to evaluate): ' || COUNT(*) FILTER (o_orderkey % 8 = 0) || ' (' || printf('%.1f', 100.0 * COUNT(*) FILTER (o_orderkey % 8 = 0) / COUNT(*)) || '%)' FROM orders")
def support_summary(spark, d):
    o = ad.table(spark, d, "orders").agg(F.count("*").alias("transcripts"), F.count(F.expr("CASE WHEN o_orderkey % 8 = 0 THEN 1 END")).alias("single_exon"))
    for c in su.SUPPORT_TOTALS[2:]:
        o = o.withColumn(c, F.lit(0))
    return wr.support_summary(o).filter("ord < 3").select(F.col("ord").cast("int").alias("ord"), "line")


@query("statistics_text", "SELECT 0 AS ord, 'Genes:                  ' || lpad(format('{:,}', COUNT(DISTINCT o_custkey)), 8, ' ') AS line FROM orders UNION ALL SELECT 1, 'Transcripts:            ' || lpad(format('{:,}', COUNT(*)), 8, ' ') FROM orders")
def statistics_text(spark, d):
    x = ad.table(spark, d, "orders").select(F.col("o_custkey").alias("gene"), F.col("o_orderkey").alias("tx"), F.lit(1).cast("bigint").alias("start"), F.lit(90).cast("bigint").alias("end"))
    return wr.statistics_text(su.gene_set_statistics(x)).filter("ord < 2").select(F.col("ord").cast("int").alias("ord"), "line")


@query("hint_classes", "SELECT l_orderkey AS id, l_linenumber AS line, CASE l_partkey % 8 WHEN 0 THEN 'rna' WHEN 1 THEN 'rna' WHEN 2 THEN 'rna' WHEN 3 THEN 'protein' WHEN 4 THEN 'protein' WHEN 5 THEN 'combined' ELSE 'other' END AS class FROM lineitem")
def hint_classes(spark, d):
    src = F.expr("array('E', 'W', 'b2h', 'P', 'PH', 'C', 'M', 'XNT')[cast(l_partkey % 8 as int)]")
    return ad.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), hi.source_class(src).alias("class"))
