"""Hit, term, lookup, vector and coordinate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import attrs as at
from ..operators import annotate as an
from ..operators import genemodel as gm
from ..operators import hits as ht
from ..streaming.streams import event_windows
from . import adapter as ad
from .registry import query

HITS = """hits AS (SELECT l_orderkey AS query, l_suppkey || '_' || l_partkey AS subject, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS bitscore, CAST(ROUND(100 * (1 - l_discount)) AS BIGINT) AS pident,
  CAST(l_quantity AS BIGINT) AS length, l_linenumber * 100000000000 + CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 1000 + l_partkey % 1000 AS line_no FROM lineitem)"""


def _hits(spark, d):
    li = ad.table(spark, d, "lineitem")
    bits = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return li.select(
        F.col("l_orderkey").alias("query"), F.expr("concat(l_suppkey, '_', l_partkey)").alias("subject"), bits.alias("bitscore"), F.expr("cast(round(100 * (1 - l_discount)) as bigint)").alias("pident"), F.col("l_quantity").cast("bigint").alias("length"),
        (F.col("l_linenumber") * F.lit(100000000000) + bits * 1000 + F.expr("l_partkey % 1000")).alias("line_no"),
    )


@query("hit_summary", f"WITH {HITS}, f AS (SELECT * FROM hits QUALIFY line_no - 1 IS DISTINCT FROM LAG(line_no) OVER (PARTITION BY query ORDER BY line_no)) SELECT query, arg_max(subject, line_no) AS best, arg_max(bitscore, line_no) AS bits, 1::BIGINT AS n_runs_kept FROM f GROUP BY query")
def hit_summary(spark, d):
    """Lines of a query are far apart here, so that each is a run of its own and the last one counts."""
    s = ht.hit_summary(_hits(spark, d))
    return s.select("query", F.col("best.subject").alias("best"), F.col("best.bitscore").alias("bits"), F.col("n_hits").alias("n_runs_kept"))


@query("hit_summary_runs", """WITH h AS (SELECT l_orderkey AS query, l_suppkey || '_' || l_partkey AS subject, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS bits, ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey, l_quantity) AS line_no FROM lineitem)
SELECT query, arg_min(subject, line_no) AS best, arg_min(bits, line_no) AS bits, COUNT(*) AS n_hits, COUNT(DISTINCT split_part(subject, '_', 1)) AS n_taxa FROM h GROUP BY query""")
def hit_summary_runs(spark, d):
    from pyspark.sql import Window

    li = ad.table(spark, d, "lineitem")
    # Lines are numbered per query here; runs only need neighbouring numbers inside a query.
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity")
    h = li.select(F.col("l_orderkey").alias("query"), F.expr("concat(l_suppkey, '_', l_partkey)").alias("subject"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("bits"), F.row_number().over(w).cast("bigint").alias("line_no"))
    return ht.hit_summary(h).select("query", F.col("best.subject").alias("best"), F.col("best.bits").alias("bits"), "n_hits", "n_taxa")


@query("species_rank", """WITH hits AS (SELECT l_orderkey AS query, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_suppkey % 7 AS VARCHAR) WHEN l_partkey % 3 = 1 THEN 'Genus_s' || l_suppkey % 5 ELSE 'P' || l_suppkey % 4 END AS species, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS bits, CAST(ROUND(100 * (1 - l_discount)) AS BIGINT) AS pident,
  CAST(l_quantity AS BIGINT) AS length, l_linenumber * 100000000000 + CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 1000 + l_partkey % 1000 AS line_no FROM lineitem),
f AS (SELECT *, bits * length / 64.0 AS score FROM hits WHERE pident >= 95 AND length >= 32), n AS (SELECT query, MIN(line_no) AS first FROM f GROUP BY query),
b AS (SELECT * FROM f QUALIFY ROW_NUMBER() OVER (PARTITION BY query ORDER BY score DESC, line_no) = 1)
SELECT species, COUNT(*) AS votes, CAST(SUM(score) * 64 AS BIGINT) AS score FROM b JOIN n USING (query) GROUP BY species ORDER BY votes DESC, SUM(score) DESC, MIN(first) LIMIT 8""")
def species_rank(spark, d):
    subject = F.expr("CASE WHEN l_partkey % 3 = 0 THEN concat(l_suppkey % 7, '_0:00', l_partkey) WHEN l_partkey % 3 = 1 THEN concat('Genus_s', l_suppkey % 5, '_g', l_partkey) ELSE concat('P', l_suppkey % 4, ' text') END")
    li = ad.table(spark, d, "lineitem")
    bits = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    h = li.select(
        F.col("l_orderkey").alias("query"), subject.alias("subject"), bits.alias("bitscore"), F.expr("cast(round(100 * (1 - l_discount)) as bigint)").alias("pident"), F.col("l_quantity").cast("bigint").alias("length"),
        (F.col("l_linenumber") * F.lit(100000000000) + bits * 1000 + F.expr("l_partkey % 1000")).alias("line_no"), F.lit(0.0).alias("evalue"), F.lit(64).alias("qlen"),
    )
    return ht.rank_species(h, 8, pident=95).select("species", "votes", (F.col("score") * 64).cast("bigint").alias("score"))


ORFS = """a AS (SELECT l_orderkey AS cds_id, l_suppkey AS protein, 1 + CAST(l_quantity AS BIGINT) % 9 AS q, l_linenumber AS s, 1 + (l_partkey * 7) % 100 AS pid, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS bits FROM lineitem WHERE l_partkey % 2 = 0),
b AS (SELECT l_orderkey AS cds_id, l_suppkey AS protein, 1 + l_partkey % 11 AS q2, 1 + l_partkey % 13 AS s2, (l_partkey * 3) % 60 AS pid2, CAST(ROUND(l_extendedprice * 97) AS BIGINT) AS bits2 FROM lineitem WHERE l_partkey % 3 <> 0),
p AS (SELECT cds_id, pid / CAST(CASE WHEN pid2 = 0 THEN 0.0001 ELSE pid2 END AS DOUBLE) AS r, (s2 - s) - (q - 1) AS shift, ROW_NUMBER() OVER (PARTITION BY cds_id ORDER BY GREATEST(bits, bits2) DESC, protein, q, s, q2, s2) AS n FROM a JOIN b USING (cds_id, protein)),
v AS (SELECT cds_id, bool_or(shift + pow(ln(r), 1000) > 0) AS incomplete FROM p WHERE n <= 25 GROUP BY cds_id)"""


def _orf_hits(spark, d):
    li = ad.table(spark, d, "lineitem").withColumn("cds_id", F.col("l_orderkey")).withColumn("protein", F.col("l_suppkey"))
    full = li.filter("l_partkey % 2 = 0").select("cds_id", "protein", F.expr("1 + cast(l_quantity as bigint) % 9").alias("qstart"), F.col("l_linenumber").alias("sstart"), F.expr("1 + (l_partkey * 7) % 100").alias("pident"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("bitscore"))
    short = li.filter("l_partkey % 3 <> 0").select("cds_id", "protein", F.expr("1 + l_partkey % 11").alias("qstart"), F.expr("1 + l_partkey % 13").alias("sstart"), F.expr("(l_partkey * 3) % 60").alias("pident"), F.round(F.col("l_extendedprice") * 97).cast("bigint").alias("bitscore"))
    return full, short


@query("orf_revision", f"WITH {ORFS} SELECT * FROM v")
def orf_revision(spark, d):
    return ht.revise_orfs(*_orf_hits(spark, d))


@query("orf_records", f"""WITH {ORFS}, o AS (SELECT o_orderkey AS id, 'o' || o_orderkey || ' type:' || (['5prime_partial', 'internal', 'complete', '3prime_partial'])[1 + o_orderkey % 4] || ' x' AS d, o_orderpriority AS seq FROM orders),
u AS (SELECT o.*, incomplete IS NOT NULL AND NOT incomplete AND o.id % 4 < 2 AND o.id % 5 <> 0 AS use_ FROM o LEFT JOIN v ON v.cds_id = o.id)
SELECT id, CASE WHEN use_ THEN 's' || replace(replace(d, '5prime_partial', 'complete'), 'internal', '3prime_partial') ELSE d END AS description, CASE WHEN use_ THEN substr(seq, 3) ELSE seq END AS seq, CASE WHEN use_ THEN 'shortened' ELSE 'full' END AS source FROM u""")
def orf_records(spark, d):
    o = ad.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr("concat('o', o_orderkey, ' type:', array('5prime_partial', 'internal', 'complete', '3prime_partial')[cast(o_orderkey % 4 as int)], ' x')").alias("description"), F.col("o_orderpriority").alias("seq"))
    short = o.filter("id % 5 <> 0").select("id", F.concat(F.lit("s"), "description").alias("description"), F.expr("substring(seq, 3)").alias("seq"))
    return ht.revised_records(o, ht.revise_orfs(*_orf_hits(spark, d)), short)


@query("orf_features", f"""WITH {ad.EXONS}, n AS (SELECT tx, CAST(SUM(e - s + 1) AS BIGINT) AS n FROM exons GROUP BY tx), o AS (SELECT tx, n, CASE WHEN tx % 2 = 0 THEN '+' ELSE '-' END AS strand, 1 + tx % 3 AS a, n - tx % 4 AS b FROM n WHERE n > 8 AND tx % 7 <> 0), r AS (
SELECT *, 'gene' AS type, 1 AS s, n AS e, 't' || tx || '.p1.gene' AS id, NULL AS parent FROM o UNION ALL SELECT *, 'mRNA', 1, n, 't' || tx || '.p1', 't' || tx || '.p1.gene' FROM o UNION ALL SELECT *, 'exon', 1, n, 't' || tx || '.p1.exon1', 't' || tx || '.p1' FROM o
UNION ALL SELECT *, 'CDS', a, b, 'cds.t' || tx || '.p1', 't' || tx || '.p1' FROM o
UNION ALL SELECT *, CASE WHEN strand = '+' THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END, 1, a - 1, 't' || tx || '.p1.' || CASE WHEN strand = '+' THEN 'utr5p1' ELSE 'utr3p1' END, 't' || tx || '.p1' FROM o WHERE a > 1
UNION ALL SELECT *, CASE WHEN strand = '+' THEN 'three_prime_UTR' ELSE 'five_prime_UTR' END, b + 1, n, 't' || tx || '.p1.' || CASE WHEN strand = '+' THEN 'utr3p1' ELSE 'utr5p1' END, 't' || tx || '.p1' FROM o WHERE b < n)
SELECT 't' || tx AS seqid, strand, type, CAST(s AS BIGINT) AS start_, CAST(e AS BIGINT) AS end_, id, parent FROM r""")
def orf_features(spark, d):
    x = ad.exons(spark, d).withColumn("tx_id", F.concat(F.lit("t"), "tx"))
    n = x.groupBy("tx").agg(F.sum(F.col("end") - F.col("start") + 1).alias("n")).filter("n > 8")
    text = F.expr("concat('t', tx, '.p1 name', tx, ' t', tx, CASE WHEN tx % 7 = 0 THEN '' ELSE concat(':', 1 + tx % 3, '-', n - tx % 4, '(', CASE WHEN tx % 2 = 0 THEN '+' ELSE '-' END, ')') END)")
    o = n.select(F.concat(F.lit("t"), "tx", F.lit(".p1")).alias("id"), text.alias("description"))
    return ht.orf_features(o, x).select("seqid", "strand", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), "id", "parent")


@query("lift_to_genome", f"""WITH {ad.EXONS}, x AS (SELECT *, COALESCE(SUM(e - s + 1) OVER (PARTITION BY tx ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM exons),
y AS (SELECT *, GREATEST(5, off + 1) AS a, LEAST(60, off + e - s + 1) AS b FROM x)
SELECT tx AS orf, CAST(CASE WHEN strand = '-' THEN e - (b - off - 1) ELSE s + a - off - 1 END AS BIGINT) AS start_, CAST(CASE WHEN strand = '-' THEN e - (a - off - 1) ELSE s + b - off - 1 END AS BIGINT) AS end_ FROM y WHERE a <= b""")
def lift_to_genome(spark, d):
    x = ad.exons(spark, d).withColumnRenamed("tx", "tx_id")
    orfs = x.select("tx_id").distinct().select(F.col("tx_id").alias("orf_id"), "tx_id", F.lit(5).cast("bigint").alias("start"), F.lit(60).cast("bigint").alias("end"))
    return ht.lift_to_genome(orfs, x).select(F.col("orf_id").alias("orf"), F.col("start").alias("start_"), F.col("end").alias("end_"))


@query("go_rollup", """WITH t AS (SELECT DISTINCT user_id AS accession, event_type AS term FROM events WHERE COALESCE(value, 0) >= 0.5), x AS (SELECT o_custkey AS gene, o_orderkey % 150 AS tx FROM orders)
SELECT gene, array_to_string(list_sort(list_distinct(list(term))), ',') AS terms FROM x JOIN t ON tx = accession GROUP BY gene""")
def go_rollup(spark, d):
    terms = ad.table(spark, d, "events").select(F.col("user_id").alias("accession"), F.col("event_type").alias("term"), F.col("value").cast("string").alias("score"))
    tx = ad.table(spark, d, "orders").select(F.col("o_custkey").alias("gene"), F.expr("o_orderkey % 150").alias("tx"))
    return an.go_rollup(tx, terms).select("gene", F.array_join("terms", ",").alias("terms"))


@query("term_totals", "SELECT COUNT(*) AS rows, COUNT(*) FILTER (COALESCE(value, 0) >= 50) AS confident_rows, COUNT(DISTINCT user_id) FILTER (user_id % 7 > 0) AS proteins, COUNT(DISTINCT user_id) FILTER (user_id % 7 > 0 AND COALESCE(value, 0) >= 50) AS confident_proteins FROM events")
def term_totals(spark, d):
    """Every seventh accession is blank."""
    e = ad.table(spark, d, "events")
    return an.term_totals(e.select(F.expr("CASE WHEN user_id % 7 > 0 THEN cast(user_id as string) ELSE ' ' END").alias("accession"), F.col("value").cast("string").alias("score")), 50.0)


@query("namespace_counts", "SELECT event_type AS namespace, COUNT(*) AS n, COUNT(*) FILTER (COALESCE(value, 0) >= 50) AS confident FROM events WHERE event_type <> 'error' GROUP BY event_type")
def namespace_counts(spark, d):
    e = ad.table(spark, d, "events")
    return an.namespace_counts(e.select(F.expr("CASE WHEN event_type = 'error' THEN ' ' ELSE event_type END").alias("namespace"), F.col("value").alias("score")), 50.0)


@query("category_membership", """WITH r(category, term) AS (VALUES ('use', 'view'), ('use', 'click'), ('trade', 'purchase'), ('localisation', 'signup')), p AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 60),
h AS (SELECT DISTINCT user_id, category FROM p JOIN r ON term = event_type), m AS (SELECT * FROM h WHERE category <> 'localisation')
SELECT user_id AS accession, category FROM m UNION ALL SELECT user_id, category FROM h WHERE category = 'localisation' AND user_id NOT IN (SELECT user_id FROM m) UNION ALL SELECT DISTINCT user_id, 'other' FROM p WHERE user_id NOT IN (SELECT user_id FROM h)""")
def category_membership(spark, d):
    rules = spark.createDataFrame([("use", "view"), ("use", "click"), ("trade", "purchase"), ("localisation", "signup")], "category string, term string")
    p = ad.table(spark, d, "events").filter("value > 60").select(F.col("user_id").alias("accession"), F.col("event_type").alias("term"))
    return an.category_membership(p, rules)


@query("alias_lookup", "SELECT n_name AS name, r_name AS key FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <> 2")
def alias_lookup(spark, d):
    n = ad.table(spark, d, "nation").withColumn("name", F.concat(F.lit("REGION-"), F.col("n_regionkey")))
    t = ad.table(spark, d, "region").filter("r_regionkey <> 2").select(F.col("r_name").alias("key"), F.array(F.concat(F.lit("region-"), F.col("r_regionkey"))).alias("aliases"))
    return an.alias_lookup(n, t).select(F.col("n_name").alias("name"), "key")


@query("vector_topk", """WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0)
SELECT query, neighbour, rank FROM (SELECT q.vec_id AS query, e.vec_id AS neighbour, ROW_NUMBER() OVER (PARTITION BY q.vec_id ORDER BY list_sum(list_transform(range(1, 65), lambda i: (CAST(q.embedding[i] AS DOUBLE) - CAST(e.embedding[i] AS DOUBLE)) ** 2)), e.vec_id) AS rank FROM q JOIN embeddings e ON q.vec_id <> e.vec_id) WHERE rank <= 5""")
def vector_topk(spark, d):
    e = ad.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return an.nearest_vectors(e.filter("id % 20 = 0"), e, 5).select("query", "neighbour", F.col("rank").cast("bigint").alias("rank"))


@query("tree_closure", """WITH RECURSIVE f AS (SELECT 'r' || r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders UNION ALL SELECT 'x' || o_orderkey, 'o' || o_orderkey FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'y' || o_orderkey, 'x' || o_orderkey FROM orders WHERE o_orderkey % 6 = 0),
t AS (SELECT id AS root, id FROM f WHERE id LIKE 'r%' UNION SELECT t.root, f.id FROM t JOIN f ON f.parent = t.id) SELECT CAST(substr(root, 2) AS INT) AS root, id FROM t""")
def tree_closure(spark, d):
    """Six levels."""
    named = lambda table, tag, key, up=None, cond="true": ad.table(spark, d, table).filter(cond).select(F.concat(F.lit(tag), F.col(key)).alias("id"), (F.concat(F.lit(up[0]), F.col(up[1])) if up else F.lit(None).cast("string")).alias("parent"))
    r = named("region", "r", "r_regionkey")
    f = r.unionByName(named("nation", "n", "n_nationkey", ("r", "n_regionkey"))).unionByName(named("customer", "c", "c_custkey", ("n", "c_nationkey"))).unionByName(named("orders", "o", "o_orderkey", ("c", "o_custkey")))
    f = f.unionByName(named("orders", "x", "o_orderkey", ("o", "o_orderkey"), "o_orderkey % 3 = 0")).unionByName(named("orders", "y", "o_orderkey", ("x", "o_orderkey"), "o_orderkey % 6 = 0"))
    out = gm.tree_closure(f, r)
    return out.select(F.expr("cast(substring(root, 2) as int)").alias("root"), "id")


@query("attribute_roundtrip", "SELECT l_orderkey AS tx, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, 'ID=x' || l_partkey || ';Parent=t' || l_orderkey || ',u' || l_suppkey || ';note=a%3Bb;flag' AS text, 'u' || l_suppkey AS second FROM lineitem")
def attribute_roundtrip(spark, d):
    text = F.expr("concat('note=a%3Bb;Parent=t', l_orderkey, ',u', l_suppkey, ';flag;ID=x', l_partkey)")
    e = ad.table(spark, d, "lineitem").withColumn("a", at.parse_attributes(text))
    return e.select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), at.format_attributes(F.col("a")).alias("text"), F.get(at.get_all(F.col("a"), "Parent"), F.lit(1)).alias("second"))


@query("event_windows", "SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '2024-01-01')) AS BIGINT) AS hour_, event_type, COUNT(*) AS n FROM events GROUP BY ALL")
def windows(spark, d):
    """The batch form of the streaming operator."""
    w = event_windows(ad.table(spark, d, "events"))
    return w.select(F.unix_timestamp("window_start").alias("hour_"), "event_type", "n")


@query("orf_shortening", "SELECT c_custkey AS id, CASE WHEN instr(p, 'M') > 0 THEN substr(p, instr(p, 'M')) END AS protein, CASE WHEN instr(p, 'M') > 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 100 + 3 * (instr(p, 'M') - 1) ELSE 100 END END::BIGINT AS start_ FROM (SELECT c_custkey, upper(c_mktsegment) AS p FROM customer)")
def orf_shortening(spark, d):
    c = ad.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.upper("c_mktsegment").alias("p"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END").alias("strand"))
    s = ht.shorten(F.col("p"), F.lit(100).cast("bigint"), F.lit(900).cast("bigint"), F.col("strand"))
    return c.withColumn("s", s).select("id", F.col("s.protein").alias("protein"), F.col("s.start").alias("start_"))


@query("id_prefixes", """SELECT l_orderkey AS tx, l_linenumber AS line, l_partkey AS part, 'gene_id "sr.g' || l_suppkey || '"; transcript_id "sr.t' || l_orderkey || '"; note "transcript"' AS text FROM lineitem""")
def id_prefixes(spark, d):
    from ..operators.tidy import prefix_ids

    text = F.expr("""concat('gene_id "g', l_suppkey, '"; transcript_id "t', l_orderkey, '"; note "transcript"')""")
    return ad.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), prefix_ids(text, "sr.").alias("text"))


@query("numbering", "SELECT c_custkey AS id, format('rRNA_{:d}', ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey)) AS name FROM customer")
def numbering(spark, d):
    from ..operators.tidy import numbered

    return numbered(ad.table(spark, d, "customer"), "rRNA_%d", ["c_acctbal", "c_custkey"], ["c_nationkey"], "name").select(F.col("c_custkey").alias("id"), "name")


@query("species_filter", "SELECT s_suppkey AS id FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def species_filter(spark, d):
    from ..operators.tidy import keep_species

    keep = ad.table(spark, d, "nation").filter("n_regionkey = 1").select(F.concat(F.col("n_nationkey"), F.lit("")).alias("species"))
    s = ad.table(spark, d, "supplier").withColumn("subject", F.concat("s_nationkey", F.lit("_0:x")))
    return keep_species(s, keep, ht.species_key(F.col("subject"))).select(F.col("s_suppkey").alias("id"))


@query("replaced_sequences", "SELECT c_custkey AS cds_id, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN substr(c_name, 4) ELSE c_name END AS seq, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'shortened' ELSE 'full' END AS source FROM customer")
def replaced(spark, d):
    from ..operators.tidy import replaced_sequences

    c = ad.table(spark, d, "customer").select(F.col("c_custkey").alias("cds_id"), F.col("c_name").alias("seq"))
    v = c.filter("cds_id % 5 <> 1 OR cds_id % 3 = 0").select("cds_id", F.expr("cds_id % 3 = 0").alias("incomplete"))
    return replaced_sequences(c, v, c.filter("cds_id % 2 = 0").withColumn("seq", F.expr("substring(seq, 4)")))


@query("reason_counts", "SELECT COALESCE(CASE WHEN l_quantity < 10 THEN 'short' WHEN l_discount > 0.05 THEN 'cheap' END, 'kept') AS reason, COUNT(*) AS n FROM lineitem GROUP BY 1")
def reasons(spark, d):
    from ..operators.tidy import reason_counts

    return reason_counts(ad.table(spark, d, "lineitem").select(F.expr("CASE WHEN l_quantity < 10 THEN 'short' WHEN l_discount > 0.05 THEN 'cheap' END").alias("reason")))


@query("positive_shares", "SELECT 'q' AS column_, COUNT(*) AS n, COUNT(*) FILTER (l_quantity > 25) AS positive FROM lineitem UNION ALL SELECT 'd', COUNT(*) FILTER (l_linenumber > 1), COUNT(*) FILTER (l_linenumber > 1 AND l_discount > 0) FROM lineitem")
def positive_shares(spark, d):
    from ..operators.support import positive_share

    li = ad.table(spark, d, "lineitem").select(F.expr("l_quantity - 25").alias("q"), F.expr("CASE WHEN l_linenumber > 1 THEN l_discount END").alias("d"))
    return positive_share(li, ["q", "d"]).withColumnRenamed("column", "column_")


@query("hit_features", """WITH h AS (SELECT l_orderkey AS query, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS bits, CAST(l_quantity AS BIGINT) + 60 AS qlen, l_partkey % 50 + 40 AS slen, 1 + l_suppkey % 7 AS qs, 30 + l_linenumber AS qe, 1 + l_partkey % 5 AS ss, 28 + l_linenumber AS se, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_partkey, l_suppkey, l_quantity) AS ln FROM lineitem),
b AS (SELECT * FROM h WHERE ln = 1), m AS (SELECT query, MEDIAN((qs - ss)::DOUBLE) AS nt, MEDIAN((qlen - qe - (slen - se))::DOUBLE) AS ct FROM h WHERE ln <= 10 GROUP BY query)
SELECT query, bits, CAST(ROUND(1000000 * (qe - qs + 1) / qlen) AS BIGINT) AS qcov, CAST(ROUND(1000000 * (se - ss + 1) / slen) AS BIGINT) AS tcov, CAST(nt * 2 AS BIGINT) AS nterm2, CAST(ct * 2 AS BIGINT) AS cterm2 FROM b JOIN m USING (query)""")
def hit_features(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity")
    h = ad.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("query"), F.row_number().over(w).cast("bigint").alias("line_no"), F.expr("concat(l_suppkey, '_', l_partkey)").alias("subject"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("bitscore"), F.lit(90).alias("pident"),
        (F.col("l_quantity").cast("bigint") + 60).alias("qlen"), F.expr("l_partkey % 50 + 40").alias("slen"), F.expr("1 + l_suppkey % 7").alias("qstart"), F.expr("30 + l_linenumber").alias("qend"), F.expr("1 + l_partkey % 5").alias("sstart"), F.expr("28 + l_linenumber").alias("send"),
    )
    f = ht.hit_features(ht.hit_summary(h))
    big = lambda c, k: F.round(F.col(c) * k).cast("bigint")
    return f.select("query", F.col("dmd_bits").alias("bits"), big("dmd_qcov", 1000000).alias("qcov"), big("dmd_tcov", 1000000).alias("tcov"), big("dmd_nterm_offset", 2).alias("nterm2"), big("dmd_cterm_offset", 2).alias("cterm2"))
