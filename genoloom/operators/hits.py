"""Alignment hits: summaries, species ranking, sequence revision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Fixed value: Genus_species in front of a reference proteome's id.
GENUS = r"^([A-Z][a-z]+_[a-z][A-Za-z0-9.-]*)_"


def taxon(subject: Column) -> Column:
    """What stands before the first '_' of a subject id."""
    return F.substring_index(subject, "_", 1)


def species_key(subject: Column) -> Column:
    """The species of a subject id: the taxon of <taxid>_<n>:<hex>, Genus_species of Genus_species_<id>; an id of another form, up to its first blank, is a species of its own."""
    head = F.regexp_extract(subject, r"^(\S*)", 1)
    return F.when(F.regexp_like(head, F.lit(r"^\d+_\d+:")), F.substring_index(head, "_", 1)).when(F.regexp_like(head, F.lit(GENUS)), F.regexp_extract(head, GENUS, 1)).otherwise(head)


def hit_summary(hits: DataFrame, top: int = 10) -> DataFrame:
    """Per query: best (the first hit in file order), top (the first `top`), n_hits, n_taxa. A query that comes in separate runs counts with its last run only. hits: line_no, query, subject and more."""
    w = Window.partitionBy("query").orderBy("line_no")
    # A new run starts where the query's lines are not neighbours.
    new = F.coalesce(F.col("line_no") != F.lag("line_no").over(w) + 1, F.lit(True)).cast("int")
    h = hits.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    h = h.withColumn("_last", F.max("_run").over(Window.partitionBy("query"))).filter("_run = _last").drop("_new", "_run", "_last")
    row = F.struct("line_no", *[c for c in hits.columns if c not in ("query", "line_no")])
    return h.groupBy("query").agg(F.min(row).alias("best"), F.slice(F.array_sort(F.collect_list(row)), 1, top).alias("top"), F.count("*").alias("n_hits"), F.count_distinct(taxon(F.col("subject"))).alias("n_taxa"))


def hit_features(summary: DataFrame, qlen: Column | None = None) -> DataFrame:
    """Ten features of a query's hits; lengths and ends come from best and top (qlen, slen, qstart, qend, sstart, send, bitscore, pident)."""
    q = F.coalesce(F.col("best.qlen"), qlen) if qlen is not None else F.col("best.qlen")
    long = lambda r: F.coalesce(r["qlen"], qlen) if qlen is not None else r["qlen"]
    middle = lambda xs: F.get(xs, F.floor((F.size(xs) - 1) / 2).cast("int")) / 2.0 + F.get(xs, F.floor(F.size(xs) / 2).cast("int")) / 2.0
    med = lambda f: middle(F.array_sort(F.filter(F.transform("top", f), lambda x: x.isNotNull())))
    return summary.select(
        "query", F.col("best.bitscore").alias("dmd_bits"), F.try_divide("best.bitscore", q).alias("dmd_bits_per_aa"), F.col("best.pident").alias("dmd_pident"), F.col("n_hits").alias("dmd_n_hits"), F.col("n_taxa").alias("dmd_n_taxa"),
        F.try_divide(F.col("best.qend") - F.col("best.qstart") + 1, q).alias("dmd_qcov"), F.try_divide(F.col("best.send") - F.col("best.sstart") + 1, F.col("best.slen")).alias("dmd_tcov"),
        med(lambda r: F.try_divide(long(r), r["slen"])).alias("dmd_len_ratio"), med(lambda r: ((r["qstart"] - 1) - (r["sstart"] - 1)).cast("double")).alias("dmd_nterm_offset"),
        med(lambda r: ((long(r) - r["qend"]) - (r["slen"] - r["send"])).cast("double")).alias("dmd_cterm_offset"),
    )


def rank_species(hits: DataFrame, most: int = 8, evalue: float = 1e-5, pident: float = 30.0, cover: float = 0.5) -> DataFrame:
    """The species with most best hits: votes, score, first. A hit's score is its bits times the share of the query that it covers; a query votes with its best hit by score, the first on ties, and its score counts for the species. Ties of species by score, then by the first fine hit of their queries. hits: line_no, query, subject, pident, length, evalue, bitscore, qlen."""
    share = F.col("length") / F.col("qlen")
    fine = hits.filter((F.col("evalue") <= evalue) & (F.col("pident") >= pident) & (F.col("qlen") > 0)).filter(share >= cover)
    fine = fine.withColumn("species", species_key(F.col("subject"))).withColumn("score", F.col("bitscore") * share)
    best = fine.groupBy("query").agg(F.max_by(F.struct("species", "score"), F.struct(F.col("score"), -F.col("line_no"))).alias("b"), F.min("line_no").alias("first"))
    per = best.groupBy("b.species").agg(F.count("*").alias("votes"), F.sum("b.score").alias("score"), F.min("first").alias("first"))
    return per.orderBy(F.col("votes").desc(), F.col("score").desc(), "first").limit(most)


def support_score(sstart_short: Column, sstart_full: Column, qstart_full: Column, pident_full: Column, pident_short: Column) -> Column:
    """How much a pair of hits to one protein speaks for the full form: what the shortened one misses of the protein, less what the full one has in front of its hit, plus the logarithm of the identities' ratio to the power of 1000 (next to nothing or infinite). A shortened form without identity counts as 0.0001."""
    ratio = pident_full / F.when(pident_short == 0, F.lit(1e-4)).otherwise(pident_short)
    power = F.when(ratio == 0, float("inf")).otherwise(F.pow(F.ln(ratio), F.lit(1000.0)))
    return (sstart_short - sstart_full) - (qstart_full - 1) + power


def revise_orfs(full: DataFrame, short: DataFrame, top: int = 25) -> DataFrame:
    """cds_id, incomplete: whether any of a sequence's `top` pairs of hits of its full and shortened form to one protein (by the larger of both bit scores, then protein and places) has a positive support_score. full, short: cds_id, protein, pident, qstart, sstart, bitscore."""
    side = lambda x, df: df.select("cds_id", "protein", *[F.col(c).alias(f"{c}_{x}") for c in ("pident", "qstart", "sstart", "bitscore")])
    pairs = side("short", short).join(side("full", full), ["cds_id", "protein"])
    c = F.col
    pairs = pairs.withColumn("score", support_score(c("sstart_short"), c("sstart_full"), c("qstart_full"), c("pident_full"), c("pident_short")))
    w = Window.partitionBy("cds_id").orderBy(F.greatest("bitscore_short", "bitscore_full").desc(), "protein", "qstart_full", "sstart_full", "qstart_short", "sstart_short")
    ranked = pairs.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top)
    return ranked.groupBy("cds_id").agg(F.coalesce(F.bool_or(F.col("score") > 0), F.lit(False)).alias("incomplete"))


def revised_records(full: DataFrame, verdict: DataFrame, short: DataFrame) -> DataFrame:
    """id, description, seq, source (full or shortened) of every record of full. Only records of the types 5prime_partial and internal that were judged complete, and have a shortened form, are replaced by it, as type complete or 3prime_partial. full, short: id, description, seq; verdict: cds_id, incomplete."""
    has = lambda c, t: F.coalesce(F.col(c).contains(f"type:{t}"), F.lit(False))
    partial = ~has("description", "complete") & (has("description", "5prime_partial") | has("description", "internal"))
    v = verdict.select(F.col("cds_id").alias("id"), "incomplete")
    s = short.select("id", F.col("description").alias("_d"), F.col("seq").alias("_s"))
    j = full.join(v, "id", "left").join(s, "id", "left")
    use = F.coalesce(partial & ~F.col("incomplete") & F.col("_s").isNotNull(), F.lit(False))
    name = F.when(has("_d", "5prime_partial"), F.replace(F.col("_d"), F.lit("type:5prime_partial"), F.lit("type:complete"))).otherwise(F.replace(F.col("_d"), F.lit("type:internal"), F.lit("type:3prime_partial")))
    return j.select("id", F.when(use, name).otherwise(F.col("description")).alias("description"), F.when(use, F.col("_s")).otherwise(F.col("seq")).alias("seq"), F.when(use, "shortened").otherwise("full").alias("source"))


def orf_features(orfs: DataFrame, exons: DataFrame) -> DataFrame:
    """seqid, source, type, start, end, strand, phase, id, parent, name: gene, mRNA, exon, CDS and untranslated regions of ORFs (id, description) on their transcripts, whose lengths are sums of exons (tx_id, start, end). A transcript's id is what stands before '.p' of the ORF's. ORFs without such a transcript or without coordinates are left out."""
    length = exons.groupBy("tx_id").agg(F.sum(F.col("end") - F.col("start") + 1).cast("bigint").alias("n"))
    h = orf_header(F.col("description"))
    words = F.split(F.trim("description"), r"\s+")
    o = orfs.select("id", F.substring_index("id", ".p", 1).alias("tx_id"), h["start"].alias("a"), h["end"].alias("b"), h["strand"].alias("strand"), F.get(words, F.lit(0)).alias("first"), F.coalesce(F.get(words, F.lit(1)), F.get(words, F.lit(0))).alias("name"))
    o = o.filter("a IS NOT NULL").join(length, "tx_id")
    gene, one, n, none = F.concat("first", F.lit(".gene")), F.lit(1).cast("bigint"), F.col("n"), F.lit(None).cast("string")
    part = lambda source, kind, s, e, phase, id_, parent, name=none: F.struct(F.lit(source).alias("source"), F.lit(kind).alias("type"), s.alias("start"), e.alias("end"), F.lit(phase).alias("phase"), id_.alias("id"), parent.alias("parent"), name.alias("name"))
    id_, plus = F.col("id"), F.col("strand") == "+"
    below = lambda kind, tag: part("TransDecoder", kind, one, F.col("a") - 1, ".", F.concat(id_, F.lit(f".{tag}1")), id_)
    above = lambda kind, tag: part("TransDecoder", kind, F.col("b") + 1, n, ".", F.concat(id_, F.lit(f".{tag}1")), id_)
    five, three = ("five_prime_UTR", "utr5p"), ("three_prime_UTR", "utr3p")
    parts = F.array(
        part("StringTie", "gene", one, n, ".", gene, none, F.col("name")), part("StringTie", "mRNA", one, n, ".", id_, gene, F.col("name")), part("StringTie", "exon", one, n, ".", F.concat(id_, F.lit(".exon1")), id_),
        part("TransDecoder", "CDS", F.col("a"), F.col("b"), "0", F.concat(F.lit("cds."), id_), id_), F.when(plus, below(*five)).otherwise(below(*three)), F.when(plus, above(*three)).otherwise(above(*five)),
    )
    return o.select(F.col("tx_id").alias("seqid"), "strand", F.inline(parts)).filter("start <= end")


def orf_header(header: Column) -> dict[str, Column]:
    """type, start, end and strand of an ORF header: ... type:X ... name:start-end(strand)."""
    m = r":(\d+)-(\d+)\(([+-])\)"
    return {"type": F.regexp_extract(header, r"type:(\S+)", 1), "start": F.try_to_number(F.regexp_extract(header, m, 1), F.lit("999999999999")).cast("bigint"), "end": F.try_to_number(F.regexp_extract(header, m, 2), F.lit("999999999999")).cast("bigint"), "strand": F.regexp_extract(header, m, 3)}


def shorten(protein: Column, start: Column, end: Column, strand: Column) -> Column:
    """The protein from its first M on (null without one), with its coordinates moved by three bases for each residue cut."""
    at = F.instr(protein, "M") - 1
    return F.when(at >= 0, F.struct(F.substring(protein, at + 1, F.length(protein)).alias("protein"), F.when(strand == "+", start + 3 * at).otherwise(start).alias("start"), F.when(strand == "+", end).otherwise(end - 3 * at).alias("end")))


def lift_to_genome(orfs: DataFrame, exons: DataFrame) -> DataFrame:
    """orf_id, seqid, strand, start, end: ORFs in transcript coordinates (orf_id, tx_id, start, end) as genome blocks, by exon offsets."""
    order = F.when(F.col("strand") == "-", -F.col("end")).otherwise(F.col("start"))
    w = Window.partitionBy("tx_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    x = exons.withColumn("_off", F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(w), F.lit(0)))
    x = x.select("tx_id", "seqid", "strand", F.col("start").alias("_s"), F.col("end").alias("_e"), "_off")
    j = orfs.join(x, "tx_id").withColumn("_a", F.greatest(F.col("start"), F.col("_off") + 1)).withColumn("_b", F.least(F.col("end"), F.col("_off") + F.col("_e") - F.col("_s") + 1)).filter("_a <= _b")
    minus = F.col("strand") == "-"
    low = F.when(minus, F.col("_e") - (F.col("_b") - F.col("_off") - 1)).otherwise(F.col("_s") + F.col("_a") - F.col("_off") - 1)
    high = F.when(minus, F.col("_e") - (F.col("_a") - F.col("_off") - 1)).otherwise(F.col("_s") + F.col("_b") - F.col("_off") - 1)
    return j.select("orf_id", "seqid", "strand", low.alias("start"), high.alias("end"))
