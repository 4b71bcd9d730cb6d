"""Gene models: hierarchy, spans, phases, isoform choice, merge of annotations, contract checks, sequence checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as sq
from .components import cut, exon_components, release
from .intervals import interval_join, merge_intervals

#: Feature types outside the contract, dropped on reading.
DROPPED = ("start_codon", "stop_codon", "intron", "transcription_start_site", "transcription_end_site", "tss", "tts")


def cds_phases(cds: DataFrame, tx: list[str], first: str | None = None) -> DataFrame:
    """cds (tx, strand, start, end) with phase: bases to skip before the first whole codon, in the order of transcription. first: column with the phase of the first segment (0 if none)."""
    order = F.when(F.col("strand") == "-", -F.col("end")).otherwise(F.col("start"))
    w = Window.partitionBy(*tx).orderBy(order)
    length = F.col("end") - F.col("start") + 1
    done = F.coalesce(F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lead = F.coalesce(F.first(first).over(w), F.lit(0)).cast("bigint") if first else F.lit(0)
    return cds.withColumn("phase", F.pmod(lead - done, F.lit(3)).cast("bigint"))


def longest_isoform(tx: DataFrame, gene: str, length: str, order: str) -> DataFrame:
    """One transcript per gene: the longest, the first in order on ties."""
    w = Window.partitionBy(gene).orderBy(F.col(length).desc(), order)
    return tx.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def cap_isoforms(tx: DataFrame, gene: str, length: str, tx_id: str, most: int = 10) -> DataFrame:
    """At most `most` transcripts per gene by falling length, then id."""
    w = Window.partitionBy(gene).orderBy(F.col(length).desc(), tx_id)
    return tx.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def malformed(parts: DataFrame, tx: str) -> DataFrame:
    """Transcripts with a part whose start is behind its end, or with overlapping parts (touching is fine)."""
    w = Window.partitionBy(tx).orderBy("start", "end")
    bad = (F.col("start") > F.col("end")) | F.coalesce(F.lag("end").over(w) >= F.col("start"), F.lit(False))
    return parts.withColumn("_bad", bad).groupBy(tx).agg(F.bool_or("_bad").alias("_bad")).filter("_bad").select(tx)


def merge_annotations(tx: DataFrame) -> DataFrame:
    """tx (tx BIGINT in file order, seqid, strand, exons, cds: arrays of start/end, utr_bp) without duplicates, with gene (number by contig and start) and isoform number. Transcripts of one coding chain (non-coding: exon chain) are one: most exon bases, then most UTR bases, then the first. Genes are components by shared exon bases, numbered by contig, start, strand and end; isoforms by start, then tx."""
    span = lambda c: F.transform(c, lambda x: F.struct(x["start"].cast("bigint").alias("start"), x["end"].cast("bigint").alias("end")))
    chain = F.when(F.size("cds") > 0, span("cds")).otherwise(span("exons"))
    bases = F.aggregate("exons", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"] + 1)
    same = Window.partitionBy("seqid", "strand", F.size("cds") > 0, "_chain").orderBy(F.col("_bp").desc(), F.col("utr_bp").desc(), "tx")
    kept = tx.withColumn("_chain", chain).withColumn("_bp", bases).withColumn("_r", F.row_number().over(same)).filter("_r = 1").drop("_r", "_chain", "_bp")
    kept = cut(kept, "kept", "zstd")
    release(kept.sparkSession)
    exons = kept.select("tx", "seqid", "strand", F.explode("exons").alias("x")).select("tx", "seqid", "strand", "x.start", "x.end")
    comp = exon_components(exons, ["seqid", "strand"], "tx").select("tx", "component")
    release(kept.sparkSession)
    # Genes and isoforms are numbered by ends alone; whole transcripts meet their numbers once.
    out = kept.select("tx", "seqid", "strand", F.get("exons", F.lit(0))["start"].alias("_s"), F.try_element_at("exons", F.lit(-1))["end"].alias("_e")).join(comp, "tx")
    span = out.groupBy("component", "seqid", "strand").agg(F.min("_s").alias("gene_start"), F.max("_e").alias("gene_end"))
    # Genes are numbered inside their contig; the contigs' offsets are sums over few rows.
    inside = F.row_number().over(Window.partitionBy("seqid").orderBy("gene_start", "strand", "gene_end", "component"))
    per = span.groupBy("seqid").agg(F.count("*").alias("_n"))
    base = per.select("seqid", F.coalesce(F.sum("_n").over(Window.orderBy("seqid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    span = span.withColumn("_i", inside).join(base, "seqid").select("component", (F.col("_i") + F.col("_b")).alias("gene"), "gene_start", "gene_end")
    isoform = F.row_number().over(Window.partitionBy("component").orderBy("_s", "tx"))
    places = out.join(span, "component").select("tx", F.col("gene").cast("bigint").alias("gene"), "gene_start", "gene_end", isoform.cast("bigint").alias("isoform"))
    return kept.join(places, "tx")


def priority_merge(tx: DataFrame, priority: DataFrame, bin_size: int | None = None) -> DataFrame:
    """priority's rows and those of tx whose span meets none of them on the same strand (seqid, strand, start, end)."""
    return priority.unionByName(interval_join(tx, priority, ["seqid", "strand"], "left_anti", bin_size), allowMissingColumns=True)


def structure_reason() -> Column:
    """First failing structure check of a transcript: strand, exons, cds (sorted arrays), first_phase; null if it passes."""
    length = F.aggregate("cds", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"] + 1)
    n = F.size("cds")
    wrong = F.exists("cds", lambda c: c["start"] > c["end"]) | F.exists(F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.get("cds", i - 1)["end"] >= F.get("cds", i)["start"])
    wrong = wrong | ~F.coalesce(F.col("strand").isin("+", "-"), F.lit(False))
    outside = (F.size("exons") > 0) & ~F.forall("cds", lambda c: F.exists("exons", lambda x: (x["start"] <= c["start"]) & (c["end"] <= x["end"])))
    return F.when(n <= 0, "no_cds").when((length - F.coalesce("first_phase", F.lit(0))) % 3 != 0, "cds_length_mod3").when(wrong, "cds_structure").when(outside, "cds_outside_exon")


#: Stop codons of genetic code 1.
STOPS = ("TAA", "TAG", "TGA")


def sequence_checks(tx: DataFrame, sequences: DataFrame, keep: bool = False) -> DataFrame:
    """tx (tx_id, seqid, strand, exons, cds, first_phase; utrs, an array with start, end and type, may be there) with reason, action (removed, flagged with keep, kept), internal_stop, extended_stop, no_stop and non_atg_start. sequences: id, seq, or tiles (id, tile, bases).

    Coding segments, and the triplets behind them, meet the tiles they lie on; only a transcript's own bases come together. Where the triplet behind a coding region without a stop is one, the last segment and its exon are extended and the untranslated region gives way (not with keep); where another exon follows, the triplet must lie in the exon that holds the end. A transcript on an unknown sequence has the reason no_sequence.
    """
    chain = "array<struct<start:bigint,end:bigint>>"
    key, plus = ["seqid", "tx_id"], F.col("strand") != "-"
    s = tx.withColumns({"exons": F.col("exons").cast(chain), "cds": F.col("cds").cast(chain)}).withColumn("reason", structure_reason())
    fine = s.filter("reason IS NULL").select(*key, "strand", "cds")
    last = F.when(plus, F.try_element_at("cds", F.lit(-1))["end"]).otherwise(F.get("cds", F.lit(0))["start"])
    low = F.when(plus, last + 1).otherwise(last - 3)
    # One join with the tiles: a row for each segment, one more for the triplet behind the last.
    parts = F.concat(F.transform("cds", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(False).alias("behind"))), F.array(F.struct(low.alias("start"), (low + 2).alias("end"), F.lit(True).alias("behind"))))
    asked = fine.select(*key, F.inline(parts)).select(*key, F.col("seqid").alias("_on"), "start", "end", "behind").filter("NOT behind OR start >= 1")
    text = sq.spliced_at(asked.withColumnsRenamed({"seqid": "_key", "_on": "seqid"}), sequences, ["_key", "tx_id", "behind"])
    got = text.groupBy(F.col("_key").alias("seqid"), "tx_id").agg(F.max(F.when(~F.col("behind"), F.col("text"))).alias("_cds"), F.max(F.when(F.col("behind"), F.col("text"))).alias("_behind"))
    known = sequences.select(F.col("id").alias("seqid")).distinct().withColumn("_known", F.lit(True))
    s = s.join(got, key, "left").join(known, "seqid", "left")
    turned = lambda c: F.when(plus, F.col(c)).otherwise(sq.reverse_complement(F.col(c)))
    phase = F.coalesce("first_phase", F.lit(0)).cast("int")
    s = s.withColumn("reason", F.when(F.col("reason").isNull() & F.col("_known").isNull(), "no_sequence").otherwise(F.col("reason")))
    s = s.withColumn("_cds", F.coalesce("_cds", F.lit("")))
    s = s.withColumn("_cds", F.upper(F.substring(turned("_cds"), phase + 1, F.length("_cds")))).withColumn("_aa", sq.translate(F.col("_cds")))
    passed = F.col("reason").isNull()
    s = s.withColumn("internal_stop", passed & F.coalesce(F.expr("substring(_aa, 1, greatest(length(_aa) - 1, 0))").contains("*"), F.lit(False)))
    high = F.when(plus, last + 3).otherwise(last - 3)
    holds = lambda x: (x["start"] <= last) & (last <= x["end"])
    followed = F.exists("exons", lambda x: F.when(plus, x["start"] > last).otherwise(x["end"] < last))
    split = followed & F.exists("exons", lambda x: holds(x) & F.when(plus, x["end"] < high).otherwise(x["start"] > high))
    stop = F.coalesce(F.upper(turned("_behind")).isin(*STOPS), F.lit(False)) & ~split
    open_end = passed & ~F.col("internal_stop") & ~F.coalesce(F.substring("_aa", -1, 1) == "*", F.lit(False))
    s = s.withColumn("extended_stop", F.coalesce(open_end & stop, F.lit(False))).withColumn("no_stop", open_end & ~F.col("extended_stop"))
    s = s.withColumn("non_atg_start", F.coalesce(passed & ~F.col("internal_stop") & (phase == 0) & ~sq.starts_with_atg(F.col("_cds")), F.lit(False)))
    s = s.withColumn("reason", F.coalesce("reason", F.when(F.col("internal_stop"), "internal_stop")))
    s = s.withColumn("action", F.when(F.col("reason").isNull(), "kept").when(F.lit(keep), "flagged").otherwise("removed"))
    s = s.drop("_cds", "_behind", "_aa", "_known")
    if keep:
        return s
    grow = F.col("extended_stop")

    def longer(part: Column) -> Column:
        return F.when(plus, F.struct(part["start"].alias("start"), F.greatest(part["end"], high).alias("end"))).otherwise(F.struct(F.least(part["start"], high).alias("start"), part["end"].alias("end")))

    changed = {
        "exons": F.transform("exons", lambda x: F.when(holds(x), longer(x)).otherwise(x)),
        "cds": F.transform("cds", lambda x: F.when(F.when(plus, x["end"] == last).otherwise(x["start"] == last), longer(x)).otherwise(x)),
    }
    if "utrs" in tx.columns:
        far = F.when(plus, last + 1).otherwise(last - 1)  # the codon's base next to the coding end
        meets = lambda u: (u["start"] <= F.greatest(far, high)) & (u["end"] >= F.least(far, high))
        moved = lambda u: F.struct(F.when(meets(u) & plus, high + 1).otherwise(u["start"]).alias("start"), F.when(meets(u) & ~plus, high - 1).otherwise(u["end"]).alias("end"), *[u[c].alias(c) for c in kept])
        kept = [c for c in tx.schema["utrs"].dataType.elementType.names if c not in ("start", "end")]
        changed["utrs"] = F.filter(F.transform("utrs", moved), lambda u: u["start"] <= u["end"]).cast(tx.schema["utrs"].dataType)
    # The coding segments last: the others are told by their old ends.
    for c in sorted(changed, key=lambda c: c == "cds"):
        s = s.withColumn(c, F.when(grow, changed[c]).otherwise(F.col(c)))
    return s


def check_report(checked: DataFrame, keep: bool = False) -> DataFrame:
    """gene_id, tx_id, action, reason of sequence_checks: a row for each reason to remove and each note on a kept transcript."""
    note = lambda c, action: F.when(F.col(c) & F.col("reason").isNull(), F.struct(F.lit(action).alias("action"), F.lit(c).alias("reason")))
    rows = F.array(F.when(F.col("reason").isNotNull(), F.struct(F.col("action").alias("action"), F.col("reason").alias("reason"))), note("extended_stop", "flagged" if keep else "kept"), note("no_stop", "kept"), note("non_atg_start", "kept"))
    return checked.select("gene_id", "tx_id", F.inline(F.filter(rows, lambda x: x.isNotNull())))


def without_stop(segs: Column, strand: Column, n: int = 3) -> Column:
    """The coding chain without its last n bases, across segments."""
    ordered = F.when(strand == "-", segs).otherwise(F.reverse(segs))
    start = F.struct(F.lit(n).cast("bigint").alias("left"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        size = x["end"] - x["start"] + 1
        cut = F.least(a["left"], size)
        part = F.when(strand == "-", F.struct((x["start"] + cut).alias("start"), x["end"].alias("end"))).otherwise(F.struct(x["start"].alias("start"), (x["end"] - cut).alias("end")))
        return F.struct((a["left"] - cut).alias("left"), F.when(cut < size, F.concat(a["out"], F.array(part))).otherwise(a["out"]).alias("out"))

    return F.array_sort(F.aggregate(ordered, start, step, lambda a: a["out"]))


# What stands between a transcript's id and the number of a part of it.
PART_TAGS = {"exon": "exon", "five_prime_UTR": "utr5p", "three_prime_UTR": "utr3p"}


def normalize(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contract form of features (gene_id, tx_id, seqid, strand, type, start, end, and phase where there is one), and the violations (rule, feature, message). Exons are the union of children where there are none; UTRs get their side; phases follow from that of the first coding segment; genes and transcripts get spans; parts are named <tx>.exonN, <tx>.cds, <tx>.utr5pN and <tx>.utr3pN by place; genes with a coding transcript have the biotype protein_coding."""
    f = features.filter(~F.col("type").isin(*DROPPED))
    key = ["gene_id", "tx_id", "seqid", "strand"]
    # Parts, exons and coding segments are used many times below; each is worked out once.
    part = cut(f.filter(F.col("type").isin("exon", "CDS", "UTR", "five_prime_UTR", "three_prime_UTR")), "parts")
    given = part.filter("type = 'exon'").select(*key, "start", "end")
    need = part.join(given.select("tx_id").distinct(), "tx_id", "left_anti")
    exon = cut(given.unionByName(merge_intervals(need, key).select(*key, "start", "end")), "exons")
    phase = F.col("phase").cast("string").try_cast("bigint") if "phase" in f.columns else F.lit(None).cast("bigint")
    cds = part.filter("type = 'CDS'").withColumn("_first", phase).groupBy(*key, "start", "end").agg(F.min("_first").alias("_first"))
    cds = cut(cds_phases(cds, ["tx_id"], "_first").drop("_first"), "cds")
    span = cds.groupBy("tx_id").agg(F.min("start").alias("_cs"), F.max("end").alias("_ce"))
    utr = part.filter(F.col("type").contains("UTR")).select(*key, "start", "end", F.col("type").alias("_given")).join(span, "tx_id", "left")
    left = F.col("end") < F.col("_cs")
    side = F.when(F.col("_cs").isNull() & F.col("_given").isin("five_prime_UTR", "three_prime_UTR"), F.col("_given")).when(left == (F.col("strand") != "-"), "five_prime_UTR").otherwise("three_prime_UTR")
    utr = utr.withColumn("type", side)
    w = Window.partitionBy("tx_id").orderBy("start", "end")
    rows = lambda df, rule, message: df.select(F.lit(rule).alias("rule"), F.col("tx_id").alias("feature"), F.lit(message).alias("message")).distinct()
    bad = rows(exon.withColumn("_p", F.lag("end").over(w)).filter("_p >= start"), "exon_overlap", "exons of a transcript overlap")
    bad = bad.unionByName(rows(utr.filter("_cs IS NOT NULL AND start <= _ce AND end >= _cs"), "utr_in_cds", "an untranslated region lies in the coding span"))
    inner = exon.select("tx_id", F.col("start").alias("_xs"), F.col("end").alias("_xe"))

    def outside(df: DataFrame) -> DataFrame:
        inside = df.select("tx_id", "start", "end").join(inner, "tx_id", "left").groupBy("tx_id", "start", "end").agg(F.coalesce(F.bool_or(F.expr("_xs <= start AND end <= _xe")), F.lit(False)).alias("ok"))
        return inside.filter("NOT ok")

    bad = bad.unionByName(rows(outside(cds), "cds_outside_exon", "a coding segment lies in no exon")).unionByName(rows(outside(utr), "utr_outside_exon", "an untranslated region lies in no exon"))
    places = part.groupBy("tx_id").agg(F.count_distinct("seqid").alias("_c"), F.count_distinct("strand").alias("_s"))
    bad = bad.unionByName(rows(places.filter("_c > 1"), "seqid", "parts of a transcript lie on several sequences")).unionByName(rows(places.filter("_s > 1"), "strand", "parts of a transcript lie on both strands"))
    parts = exon.withColumn("type", F.lit("exon")).withColumn("phase", F.lit(None).cast("bigint")).unionByName(cds.withColumn("type", F.lit("CDS"))).unionByName(utr.drop("_cs", "_ce", "_given").withColumn("phase", F.lit(None).cast("bigint")))
    t = exon.groupBy(*key).agg(F.min("start").alias("start"), F.max("end").alias("end")).join(span, "tx_id", "left")
    t = t.withColumn("type", F.when(F.col("_cs").isNotNull(), "mRNA").otherwise("transcript")).withColumn("coding", F.col("_cs").isNotNull())
    g = t.groupBy("gene_id", "seqid", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.bool_or("coding").alias("coding"))
    g = g.withColumn("type", F.lit("gene")).withColumn("tx_id", F.lit(None).cast(f.schema["tx_id"].dataType))
    biotype = F.when(F.col("coding"), "protein_coding")
    out = g.withColumn("biotype", biotype).drop("coding").unionByName(t.drop("coding", "_cs", "_ce"), allowMissingColumns=True).unionByName(parts, allowMissingColumns=True)
    number = F.row_number().over(Window.partitionBy("tx_id", "type").orderBy("start", "end"))
    tag = F.element_at(F.create_map(*[F.lit(x) for kv in PART_TAGS.items() for x in kv]), F.col("type"))
    name = F.when(F.col("type") == "gene", F.col("gene_id")).when(F.col("type").isin("mRNA", "transcript"), F.col("tx_id")).when(F.col("type") == "CDS", F.concat("tx_id", F.lit(".cds"))).otherwise(F.concat("tx_id", F.lit("."), tag, number.cast("string")))
    parent = F.when(F.col("type").isin("mRNA", "transcript"), F.col("gene_id")).when(F.col("type") != "gene", F.col("tx_id"))
    return out.withColumn("id", name).withColumn("parent", parent), bad


def merged_features(tx: DataFrame) -> DataFrame:
    """seqid, source, type, start, end, strand, phase, id, parent, biotype, and gene, level, isoform, part, ix, which order them, of the genes of merge_annotations (gene, isoform, seqid, strand, exons, cds; utrs with start, end and type, and source, labels joined by commas, may be there): gene_NNNNNN, its transcripts .tN, and their parts exonN, utrN and cdsN by place. A coding transcript is an mRNA and makes its gene protein_coding. Untranslated regions keep their types and widen transcript and gene; without exons the coding segments stand for them. A phase that a coding segment has stays (null: none); where segments have no such field, phases follow from the lengths. A gene's source lists those of its transcripts; without any it is merge."""
    chain = "array<struct<start:bigint,end:bigint>>"
    utr = "array<struct<start:bigint,end:bigint,type:string>>"
    t = tx.withColumn("gene_id", F.format_string("gene_%06d", "gene")).withColumn("tx_id", F.concat("gene_id", F.lit(".t"), "isoform")).withColumn("coding", F.size("cds") > 0)
    plain = F.transform("cds", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    t = t.withColumn("_x", F.array_sort(F.when(F.size("exons") > 0, F.col("exons").cast(chain)).otherwise(plain.cast(chain))))
    t = t.withColumn("_u", F.array_sort(F.col("utrs").cast(utr)) if "utrs" in tx.columns else F.array().cast(utr)).withColumn("_u", F.coalesce("_u", F.array().cast(utr)))
    labels = F.filter(F.split(F.coalesce(F.col("source"), F.lit("")), ","), lambda v: v != "") if "source" in tx.columns else F.array().cast("array<string>")
    joined = lambda v: F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(v)), ","), F.lit("")), F.lit("merge"))
    bounds = lambda of, at: of(F.concat(F.transform("_x", lambda x: x[at]), F.transform("_u", lambda x: x[at])))
    t = t.withColumns({"_labels": labels, "start": bounds(F.array_min, "start"), "end": bounds(F.array_max, "end")}).withColumn("source", joined(F.col("_labels")))
    # Read by each kind of line; raw forms and what follows from numbers are not stored.
    held = cut(t.select("gene", "isoform", "seqid", "strand", "source", "start", "end", "coding", "_labels", "_x", "_u", "cds"), "merged", "zstd")
    release(held.sparkSession)
    t = held.withColumn("gene_id", F.format_string("gene_%06d", "gene")).withColumn("tx_id", F.concat("gene_id", F.lit(".t"), "isoform"))
    none, nil = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    g = t.groupBy("gene", "seqid", "strand", F.col("gene_id").alias("id")).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max(F.when(F.col("coding"), "protein_coding")).alias("biotype"), joined(F.flatten(F.collect_set("_labels"))).alias("source"))
    g = g.withColumns({"type": F.lit("gene"), "parent": none, "phase": nil, "level": F.lit(0), "isoform": F.lit(0).cast("bigint"), "part": F.lit(0), "ix": F.lit(0)})
    own = ["gene", F.col("isoform").cast("bigint").alias("isoform"), "seqid", "strand", "source"]
    m = t.select(*own, F.col("tx_id").alias("id"), "start", "end", none.alias("biotype"), F.when(F.col("coding"), "mRNA").otherwise("transcript").alias("type"), F.col("gene_id").alias("parent"), nil.alias("phase"), F.lit(1).alias("level"), F.lit(0).alias("part"), F.lit(0).alias("ix"))

    def kids(c: Column, tag: str, part: int, kind: Column, phase: Column) -> DataFrame:
        x = t.select(*own, "tx_id", F.posexplode(c).alias("ix", "x"))
        return x.select("gene", "isoform", "seqid", "strand", "source", F.concat("tx_id", F.lit(f".{tag}"), F.col("ix") + 1).alias("id"), F.col("x.start").cast("bigint").alias("start"), F.col("x.end").cast("bigint").alias("end"), none.alias("biotype"), kind.alias("type"), F.col("tx_id").alias("parent"), phase.alias("phase"), F.lit(2).alias("level"), F.lit(part).alias("part"), "ix")

    phased = "phase" in tx.schema["cds"].dataType.elementType.names
    by_start = F.array_sort("cds", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    cds = kids(by_start, "cds", 2, F.lit("CDS"), F.col("x.phase").cast("string").try_cast("bigint") if phased else nil)
    if not phased:
        cds = cds_phases(cds.drop("phase"), ["parent"])
    return g.unionByName(m).unionByName(kids(F.col("_x"), "exon", 0, F.lit("exon"), nil)).unionByName(kids(F.col("_u"), "utr", 1, F.col("x.type"), nil)).unionByName(cds)


def transcript_filter(tx: DataFrame, min_length=300, min_cov=3.0, min_tpm=1.0, long_length=3000, min_tpm_long=0.5, drop_unstranded=False) -> DataFrame:
    """tx (length, cov, tpm, strand) with reason: the first rule it fails (length, cov, tpm or tpm_long, unstranded), or pass, or pass_long_relaxed for a long one, and keep. A number that is not there fails its rule."""
    long = F.col("length") >= long_length
    below = lambda c, least: F.coalesce(F.col(c) < least, F.lit(True))
    few = F.when(long, below("tpm", min_tpm_long)).otherwise(below("tpm", min_tpm))
    reason = F.when(F.col("length") < min_length, "length").when(below("cov", min_cov), "cov").when(few & long, "tpm_long").when(few, "tpm")
    reason = reason.when(F.lit(drop_unstranded) & ~F.coalesce(F.col("strand").isin("+", "-"), F.lit(False)), "unstranded").when(long, "pass_long_relaxed").otherwise("pass")
    return tx.withColumn("reason", reason).withColumn("keep", F.col("reason").startswith("pass"))


def require_expression(tx: DataFrame) -> None:
    """An error if there are transcripts and none has cov or TPM, as after a merge of assemblies."""
    row = tx.agg(F.count("*").alias("n"), F.count(F.coalesce("cov", "tpm")).alias("known")).first()
    if row["n"] and not row["known"]:
        raise ValueError("no transcript has cov and TPM: pass the assembly of the reads, not a merge")


def tree_closure(features: DataFrame, roots: DataFrame) -> DataFrame:
    """Of features (id, parent): the roots and all their descendants, however deep, root by root. Each level is written and read back; a feature met before is not followed again, so that cycles end."""
    level = cut(features.join(roots.select(F.col("id").alias("root")).distinct(), F.col("id") == F.col("root")).select("root", "id").distinct())
    out = level
    while not level.isEmpty():
        below = features.join(level.select("root", F.col("id").alias("parent")), "parent").select("root", "id").distinct()
        level = cut(below.join(out, ["root", "id"], "left_anti"))
        out = out.unionByName(level)
    return out
