"""Consensus of several gene sets: merge by coding chain, evidence, tiers, loci, selection by rules or by a model.

A structure is a distinct coding chain (contig, strand, segs). Roles says which gene sets are ab initio predictors and which
are transcript-based ORF callers; the rules read roles, not names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from .components import cut
from .intervals import covered_bases, interval_join, islands

KEY = ["contig", "strand", "segs"]
#: Bases of a bin, at least, where whole spans meet intervals.
SPAN_BIN = 1 << 13


@dataclass(frozen=True)
class Roles:
    """Names of the gene sets, in the order in which their members are listed."""

    first: str = "t0"  #: main ab initio predictor
    second: str = "t1"  #: other ab initio predictor
    orf: str = "t2"  #: ORF caller
    orf2: str = "t3"  #: second ORF caller

    @property
    def order(self) -> list[str]:
        return [self.first, self.second, self.orf, self.orf2]


@dataclass(frozen=True)
class Rules:
    roles: Roles = field(default_factory=Roles)
    min_mult: int = 2
    cov_full: float = 0.9
    rna_rules: bool = True
    agree_rules: bool = True
    chain_rules: bool = True
    rna_penalty: float = 2.0
    chain_bonus: float = 1.0
    rescue_tier: float = 6.0
    full_len_min: float = 0.8
    full_len_max: float = 1.25
    drop_lone_single_exon: tuple[str, ...] = ()
    drop_lone_rna_conflict: bool = False
    rescue_lone_match: float | None = None
    min_locus: float = 4.0
    iso_min_tier: float = 8.0
    iso_dt: str = "filtered"
    iso_rna: bool = False
    iso_chain_min_tier: float | None = 4.0
    iso_dt_chains: bool = False
    tier_table: bool = False


def introns(segs: Column) -> Column:
    """The gaps between the segments of a chain."""
    return F.when(F.size(segs) < 2, F.array().cast("array<struct<start:bigint,end:bigint>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(segs) - 1), lambda i: F.struct((F.get(segs, i - 1)["end"] + 1).alias("start"), (F.get(segs, i)["start"] - 1).alias("end")))
    )


def chain_text(segs: Column) -> Column:
    return F.array_join(F.transform(segs, lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))), ",")


def build_structures(transcripts: DataFrame, order: list[str], prefer: list[str] | None = None) -> DataFrame:
    """One row per chain: sid, tools (sorted), members in tool then file order, rep (the member of the most preferred tool, then smallest id), cds_len, n_exons, n_introns. transcripts: tool, tx_id, tx_ord, contig, strand, segs (sorted, touching segments joined)."""
    place = lambda names: F.array_position(F.array(*[F.lit(n) for n in names]), F.col("tool")).cast("int")
    preferred = F.when(place(prefer or order) > 0, place(prefer or order)).otherwise(99)
    out = transcripts.groupBy(*KEY).agg(
        F.array_sort(F.collect_set("tool")).alias("tools"),
        F.array_sort(F.collect_list(F.struct(place(order).alias("tool_rank"), "tx_ord", "tool", "tx_id"))).alias("members"),
        F.min_by(F.struct("tool", "tx_id"), F.struct(preferred, F.col("tx_id"))).alias("rep"),
    )
    length = F.aggregate("segs", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"] + 1)
    first, last = F.get("segs", F.lit(0))["start"], F.element_at("segs", -1)["end"]
    return out.select(
        F.xxhash64(*KEY).alias("sid"), "*", length.alias("cds_len"), F.size("segs").cast("bigint").alias("n_exons"), (F.size("segs") - 1).cast("bigint").alias("n_introns"),
        first.alias("start"), last.alias("end"), introns(F.col("segs")).alias("introns"),
    )


def explode_introns(structures: DataFrame) -> DataFrame:
    return structures.select("sid", "contig", "strand", "tools", F.posexplode("introns").alias("ix", "i")).select("sid", "contig", "strand", "tools", F.col("ix").cast("bigint").alias("ix"), "i.start", "i.end")


def explode_segments(structures: DataFrame) -> DataFrame:
    return structures.select("sid", "contig", "strand", F.posexplode("segs").alias("ix", "s")).select("sid", "contig", "strand", F.col("ix").cast("bigint").alias("ix"), "s.start", "s.end")


def add_loci(structures: DataFrame, by: str = "cluster") -> DataFrame:
    """cluster: number of the locus (structures of one contig and strand whose spans share a base), by contig, strand and start."""
    # What runs, their numbers and those before a contig and strand are told from is worked out once.
    out = cut(islands(cut(structures, "structures"), ["contig", "strand"], touching=False), "loci")
    # Loci before a contig and strand are few numbers per key; they are summed over the keys, not over the rows.
    per = out.groupBy("contig", "strand").agg(F.max("island").alias("_n"))
    base = per.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("contig", "strand").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return out.join(base, ["contig", "strand"]).withColumn(by, (F.col("_base") + F.col("island") - 1).cast("bigint")).drop("island", "_base")


def add_rna(structures: DataFrame, hints: DataFrame | None, coverage: DataFrame | None, min_mult: int = 2, bin_size: int | None = None) -> DataFrame:
    """rna_introns, rna_frac, rna_min_mult and rna_cov. hints: contig, start, end, mult (summed over strands here); coverage: contig, start, end. Absent evidence leaves nulls, except rna_frac, which is 0 without hints, as no intron is supported."""
    long = explode_introns(structures)
    if hints is None:
        per = long.groupBy("sid").agg(F.lit(0).cast("bigint").alias("rna_introns"), F.lit(None).cast("bigint").alias("rna_min_mult"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("rna_set"))
    else:
        summed = hints.groupBy("contig", "start", "end").agg(F.sum("mult").alias("mult"))
        long = long.join(summed, ["contig", "start", "end"], "left").withColumn("mult", F.coalesce("mult", F.lit(0)))
        enough = F.col("mult") >= min_mult
        per = long.groupBy("sid").agg(F.count(F.when(enough, 1)).alias("rna_introns"), F.min("mult").cast("bigint").alias("rna_min_mult"), F.collect_set(F.when(enough, F.struct("start", "end"))).alias("rna_set"))
    out = structures.join(per, "sid", "left").withColumn("rna_introns", F.coalesce("rna_introns", F.lit(0)).cast("bigint"))
    out = out.withColumn("rna_frac", F.when(F.col("n_introns") > 0, F.col("rna_introns") / F.col("n_introns")))
    if coverage is None:
        return out.withColumn("rna_covered", F.lit(None).cast("bigint")).withColumn("rna_cov", F.lit(None).cast("double"))
    cov = covered_bases(explode_segments(structures), ["contig"], coverage, ["sid"], bin_size).withColumnRenamed("covered", "rna_covered")
    return out.join(cov, "sid", "left").withColumn("rna_cov", F.col("rna_covered") / F.col("cds_len"))


def add_agreement(structures: DataFrame) -> DataFrame:
    """agreed (introns that a tool outside the structure's own set predicts too) and tool_intron_frac."""
    structures = cut(structures, "agreement")
    long = explode_introns(structures)
    where = ["contig", "strand", "start", "end"]
    tools = long.select(*where, F.explode("tools").alias("t")).groupBy(*where).agg(F.collect_set("t").alias("all_tools"))
    per = long.join(tools, where).groupBy("sid").agg(F.count(F.when(F.size(F.array_except("all_tools", "tools")) > 0, 1)).alias("agreed"))
    out = structures.join(per, "sid", "left").withColumn("agreed", F.coalesce("agreed", F.lit(0)).cast("bigint"))
    return out.withColumn("tool_intron_frac", F.when(F.col("n_introns") > 0, F.col("agreed") / F.col("n_introns")))


def add_chains(structures: DataFrame, transcripts: DataFrame | None, bin_size: int | None = None) -> DataFrame:
    """chain_support (full, partial, none) and chain_n of full-length transcripts: contig, strand ('.' counts for both), exons (array, merged). A multi-exon chain is found by an equi join on its first intron; a single exon by overlap."""
    if transcripts is None:
        return structures.withColumn("chain_support", F.lit(None).cast("string")).withColumn("chain_n", F.lit(None).cast("bigint"))
    both = F.when(F.col("strand").isin("+", "-"), F.array("strand")).otherwise(F.array(F.lit("+"), F.lit("-")))
    t = transcripts.withColumn("strand", F.explode(both)).withColumn("t_introns", introns(F.col("exons")))
    occ = t.select("contig", "strand", "exons", "t_introns", F.posexplode("t_introns").alias("at", "i")).select("contig", "strand", "exons", "t_introns", "at", "i.start", "i.end")
    multi = structures.filter("n_introns > 0").select("sid", "contig", "strand", "segs", "introns", "n_introns", F.get("introns", F.lit(0))["start"].alias("start"), F.get("introns", F.lit(0))["end"].alias("end"))
    m = F.col("n_introns").cast("int")
    fits = (F.size("t_introns") - F.col("at") >= m) & (F.slice("t_introns", F.col("at") + 1, m) == F.col("introns"))
    fits &= (F.get("exons", F.col("at"))["start"] <= F.get("segs", F.lit(0))["start"]) & (F.element_at("segs", -1)["end"] <= F.get("exons", F.col("at") + m)["end"])
    full = multi.join(occ, ["contig", "strand", "start", "end"]).filter(fits).groupBy("sid").agg(F.count("*").alias("n_full"))
    some = explode_introns(structures).join(occ.select("contig", "strand", "start", "end").distinct(), ["contig", "strand", "start", "end"], "left_semi").select("sid").distinct().withColumn("touched", F.lit(True))
    exons = t.select("contig", "strand", F.explode("exons").alias("x")).select("contig", "strand", "x.start", "x.end")
    single = interval_join(structures.filter("n_introns = 0").select("sid", "contig", "strand", "start", "end"), exons, ["contig", "strand"], "inner", bin_size)
    single = single.groupBy("sid").agg(F.count(F.when((F.col("r_start") <= F.col("start")) & (F.col("end") <= F.col("r_end")), 1)).alias("n_full"), F.lit(True).alias("touched"))
    got = full.withColumn("touched", F.lit(True)).unionByName(single).unionByName(some.withColumn("n_full", F.lit(0).cast("bigint"))).groupBy("sid").agg(F.max("n_full").alias("n_full"), F.max("touched").alias("touched"))
    out = structures.join(got, "sid", "left").withColumn("chain_n", F.coalesce("n_full", F.lit(0)).cast("bigint"))
    return out.withColumn("chain_support", F.when(F.col("chain_n") > 0, "full").when(F.col("touched"), "partial").otherwise("none")).drop("n_full", "touched")


def add_protein_introns(structures: DataFrame, hints: DataFrame | None) -> DataFrame:
    """prot_introns, prot_intron_min_n, prot_intron_frac from protein introns (contig, start, end, n; the largest n of an intron counts, whatever its strand)."""
    if hints is None:
        return structures.withColumn("prot_introns", F.lit(None).cast("bigint")).withColumn("prot_intron_min_n", F.lit(None).cast("bigint")).withColumn("prot_intron_frac", F.lit(None).cast("double"))
    best = hints.groupBy("contig", "start", "end").agg(F.max("n").alias("n"))
    per = explode_introns(structures).join(best, ["contig", "start", "end"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    per = per.groupBy("sid").agg(F.count(F.when(F.col("n") > 0, 1)).alias("prot_introns"), F.min("n").cast("bigint").alias("prot_intron_min_n"))
    out = structures.join(per, "sid", "left")
    return out.withColumn("prot_intron_frac", F.when(F.col("n_introns") > 0, F.col("prot_introns") / F.col("n_introns")))


CONFLICTS = ["prot_hints_in_span", "prot_extra", "prot_extra_max_n", "prot_shifted", "prot_shifted_max_n", "prot_beyond", "prot_beyond_max_n"]


def add_conflicts(structures: DataFrame, hints: DataFrame, bin_size: int | None = None) -> DataFrame:
    """CONFLICTS: protein introns (contig, strand, '.' counts for both, start, end, n) that overlap a structure's span: beyond it, inside one segment (extra), or with other splice sites (shifted)."""
    both = F.when(F.col("strand").isin("+", "-"), F.array("strand")).otherwise(F.array(F.lit("+"), F.lit("-")))
    h = hints.withColumn("strand", F.explode(both)).groupBy("contig", "strand", "start", "end").agg(F.max("n").alias("n"))
    structures = cut(structures, "structures")  # read for the spans, for the chains of the pairs and for the result
    # A span is long beside a bin for exons: only its ends go through the bins, of at least its size; the chain meets the pairs by sid.
    spans = structures.select("sid", "contig", "strand", "start", "end")
    pair = interval_join(spans, h, ["contig", "strand"], "inner", bin_size and max(bin_size, SPAN_BIN))
    pair = pair.select("sid", "r_start", "r_end", "r_n").join(structures.select("sid", "start", "end", "segs", "introns"), "sid")
    a, b = F.col("r_start"), F.col("r_end")
    beyond = (a < F.col("start")) | (b > F.col("end"))
    exact = F.exists("introns", lambda i: (i["start"] == a) & (i["end"] == b))
    extra = F.exists("segs", lambda s: (s["start"] <= a) & (b <= s["end"]))
    kind = F.when(beyond, "beyond").when(exact, "exact").when(extra, "extra").otherwise("shifted")
    pair = pair.withColumn("kind", kind)
    count = lambda k: F.count(F.when(F.col("kind") == k, 1))
    most = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.col("r_n"))), F.lit(0)).cast("bigint")
    per = pair.groupBy("sid").agg(
        F.count(F.when(F.col("kind") != "beyond", 1)).alias("prot_hints_in_span"), count("extra").alias("prot_extra"), most("extra").alias("prot_extra_max_n"),
        count("shifted").alias("prot_shifted"), most("shifted").alias("prot_shifted_max_n"), count("beyond").alias("prot_beyond"), most("beyond").alias("prot_beyond_max_n"),
    )
    return structures.join(per, "sid", "left").fillna(0, CONFLICTS)


def codon_positions(strand: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """First base of the start codon and of the stop codon on the contig."""
    return F.when(strand == "+", start).otherwise(end - 2), F.when(strand == "+", end - 2).otherwise(start)


def add_codons(structures: DataFrame, codons: DataFrame | None) -> DataFrame:
    """prot_start and prot_stop: 1 if the codon's first base is a hint base (contig, pos, kind), 0 if not, null without any codon hint."""
    null = F.lit(None).cast("bigint")
    if codons is None:
        return structures.withColumn("prot_start", null).withColumn("prot_stop", null)
    at_start, at_stop = codon_positions(F.col("strand"), F.col("start"), F.col("end"))
    starts = codons.filter("kind = 'start'").select("contig", F.col("pos").alias("_s"), F.lit(1).alias("_hs")).distinct()
    stops = codons.filter("kind = 'stop'").select("contig", F.col("pos").alias("_t"), F.lit(1).alias("_ht")).distinct()
    any_ = codons.agg(F.count("*").alias("_any"))
    out = structures.withColumn("_s", at_start).withColumn("_t", at_stop).join(starts, ["contig", "_s"], "left").join(stops, ["contig", "_t"], "left").crossJoin(F.broadcast(any_))
    some = F.col("_any") > 0
    return out.withColumn("prot_start", F.when(some, F.coalesce("_hs", F.lit(0)).cast("bigint"))).withColumn("prot_stop", F.when(some, F.coalesce("_ht", F.lit(0)).cast("bigint"))).drop("_s", "_t", "_hs", "_ht", "_any")


def add_match(structures: DataFrame, models: DataFrame | None, name: str) -> DataFrame:
    """name: 1 if a reference model has the same chain, else 0; null without reference models."""
    if models is None:
        return structures.withColumn(name, F.lit(None).cast("bigint"))
    same = models.select(*KEY).distinct().withColumn("_same", F.lit(1))
    return structures.join(same, KEY, "left").withColumn(name, F.coalesce("_same", F.lit(0)).cast("bigint")).drop("_same")


def add_hits(structures: DataFrame, hits: DataFrame) -> DataFrame:
    """Best hit of a structure over its members: hits (tool, query, bits, order columns kept as struct `hit`) are found by the member's id, else by the id with '.p1'; the highest bits win, the first member on ties."""
    m = structures.select("sid", F.posexplode("members").alias("pos", "m")).select("sid", "pos", F.col("m.tool").alias("tool"), F.col("m.tx_id").cast("string").alias("tx_id"))
    h = hits.select("tool", F.col("query").alias("q1"), F.col("bits").alias("b1"), F.col("hit").alias("h1"))
    p = hits.select("tool", F.col("query").alias("q2"), F.col("bits").alias("b2"), F.col("hit").alias("h2"))
    m = m.withColumn("q1", F.col("tx_id")).withColumn("q2", F.concat("tx_id", F.lit(".p1"))).join(h, ["tool", "q1"], "left").join(p, ["tool", "q2"], "left")
    bits, hit = F.when(F.col("h1").isNotNull(), F.col("b1")).otherwise(F.col("b2")), F.coalesce("h1", "h2")
    best = m.filter(F.coalesce("h1", "h2").isNotNull()).groupBy("sid").agg(F.max_by(hit, F.struct(bits, -F.col("pos"))).alias("hit"), F.max(bits).alias("dmd_bits"))
    return structures.join(best, "sid", "left").withColumn("dmd_hit", F.col("dmd_bits").isNotNull().cast("bigint"))


def has(tool: str) -> Column:
    return F.array_contains("tools", tool)


def is_dt(r: Roles) -> Column:
    """Both ORF callers agree and no ab initio predictor has it."""
    return has(r.orf) & has(r.orf2) & ~has(r.first) & ~has(r.second)


def base_tier(r: Roles) -> Column:
    """Tier of the tool set; lone models of the main predictor by size."""
    a, b, tx, n, length = has(r.first), has(r.second), has(r.orf) | has(r.orf2), F.col("n_exons"), F.col("cds_len")
    large = (n >= 5) | ((n >= 3) & (length >= 600)) | (length >= 1200)
    return (
        F.when(a & b & tx, 10).when(a & tx, 9).when(a & b, 8).when(b & has(r.orf) & has(r.orf2), 7).when(a & large, 5).when(a, 3).when(b & tx, 4).otherwise(0).cast("double")
    )


def table_tier(structures: DataFrame, table: DataFrame) -> DataFrame:
    """tier from a table (tools, struct_class, tier), class '*' for all others, 0 if there is none."""
    n = F.col("n_exons")
    s = structures.withColumn("_tools", F.array_join("tools", ",")).withColumn("_class", F.when(n == 1, "e1").when(n <= 4, "e2_4").otherwise("e5"))
    exact = table.select(F.col("tools").alias("_tools"), F.col("struct_class").alias("_class"), F.col("tier").alias("_t1"))
    rest = table.filter("struct_class = '*'").select(F.col("tools").alias("_tools"), F.col("tier").alias("_t2"))
    return s.join(exact, ["_tools", "_class"], "left").join(rest, "_tools", "left").withColumn("tier", F.coalesce("_t1", "_t2", F.lit(0.0))).drop("_tools", "_class", "_t1", "_t2")


def rank_score(rules: Rules) -> Column:
    r = F.col("tier") if rules.tier_table else F.when(is_dt(rules.roles), 5.5).otherwise(F.col("tier"))
    if rules.rna_penalty:
        r = r - F.when((F.col("n_introns") > 0) & (F.col("rna_frac") < 1), rules.rna_penalty).otherwise(0.0)
    if rules.chain_bonus:
        r = r + F.when(F.col("chain_support") == "full", rules.chain_bonus).otherwise(0.0)
    return r + 0.01 * F.size("tools")


def assign_tiers(structures: DataFrame, rules: Rules, tier_table: DataFrame | None = None, have_rna: bool = True) -> DataFrame:
    """base_tier, tier, adjustment, open_tier, no_primary, score. Needs the evidence columns; missing ones count as absent. Every step reads the tier of the step before."""
    wanted = {"rna_introns": "bigint", "rna_frac": "double", "rna_cov": "double", "tool_intron_frac": "double", "chain_support": "string", "prot_intron_frac": "double", "dmd_hit": "bigint", "dmd_len_ratio": "double", "mp_train_match": "bigint", "mp_rep_match": "bigint"}
    s = structures.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in structures.columns})
    s = table_tier(s, tier_table) if tier_table is not None else s.withColumn("tier", base_tier(rules.roles))
    r, up, tier = rules.roles, rules.rescue_tier, F.col("tier")
    lone = (F.size("tools") == 1) & (has(r.first) | (has(r.second) if rules.tier_table else F.lit(False)))
    yes = lambda c: F.coalesce(c, F.lit(False))
    chain = F.lit(rules.chain_rules) & yes(F.col("chain_support") == "full") & (tier < up)
    agree = F.lit(rules.agree_rules) & yes((F.col("n_introns") > 0) & (F.col("tool_intron_frac") == 1.0))
    rna = F.lit(rules.rna_rules and have_rna) & (yes((F.col("n_introns") > 0) & (F.col("rna_frac") == 1.0)) | yes((F.col("n_introns") == 0) & (F.col("rna_cov") >= rules.cov_full)))
    adjust = F.when(lone & chain, "up_chain_support").when(lone & agree, F.when(tier < up, "up_intron_agreement")).when(lone & rna & (tier < up), "up_rna_support")
    s = s.withColumn("base_tier", tier).withColumn("adjustment", adjust).withColumn("tier", F.when(F.col("adjustment").isNotNull(), up).otherwise(tier))
    matched = yes(F.col("mp_train_match") == 1) | yes(F.col("mp_rep_match") == 1)
    part = lone & yes(F.col("dmd_hit") == 1) & yes(~F.col("dmd_len_ratio").between(rules.full_len_min, rules.full_len_max)) & ~matched & ~yes((F.col("n_introns") > 0) & (F.col("prot_intron_frac") == 1.0))
    s = s.withColumn("_part", part).withColumn("adjustment", F.when(F.col("_part"), "down_partial_protein").otherwise(F.col("adjustment"))).withColumn("tier", F.when(F.col("_part"), 2.0).otherwise(tier)).drop("_part")
    single = F.size("tools") == 1
    short = single & F.get("tools", F.lit(0)).isin(*rules.drop_lone_single_exon) & (F.col("n_exons") == 1) & ~matched if rules.drop_lone_single_exon else F.lit(False)
    conflict = F.lit(rules.drop_lone_rna_conflict and have_rna) & single & (has(r.first) | has(r.second)) & (F.col("n_introns") > 0) & (F.col("rna_introns") >= 1) & yes(F.col("rna_frac") < 1) & ~matched
    rescue = single & (has(r.first) | has(r.second)) & matched & (tier < rules.rescue_lone_match) if rules.rescue_lone_match is not None else F.lit(False)
    s = s.withColumn("_step", F.when(short, "down_lone_single_exon").when(conflict, "down_lone_rna_conflict").when(rescue, "up_lone_match"))
    down = F.col("_step").startswith("down")
    s = s.withColumn("open_tier", F.when(yes(down), tier)).withColumn("no_primary", yes(down))
    s = s.withColumn("tier", F.when(F.col("no_primary"), 2.0).when(F.col("_step").isNotNull(), F.lit(rules.rescue_lone_match or 0.0)).otherwise(tier)).withColumn("adjustment", F.coalesce("_step", "adjustment")).drop("_step")
    return s.withColumn("score", rank_score(rules))


def select_rules(structures: DataFrame, rules: Rules) -> DataFrame:
    """rank, keep, why, novel_introns, novel_rna_frac per locus (cluster)."""
    r = rules.roles
    yes = lambda c: F.coalesce(c, F.lit(False))
    locus = Window.partitionBy("cluster")
    order = locus.orderBy(F.col("score").desc(), F.col("segs"))
    worth = F.col("tier") if rules.tier_table else F.when(is_dt(r), 5.5).otherwise(F.col("tier"))
    ab = has(r.first) | has(r.second)
    s = structures.withColumn("_r", F.row_number().over(order))
    s = s.withColumn("_open", F.max(F.when(ab, F.coalesce("open_tier", "tier")).otherwise(0.0)).over(locus) >= rules.min_locus)
    s = s.withColumn("_demoted", F.max(F.when(F.col("_r") == 1, F.col("no_primary"))).over(locus))
    s = s.withColumn("_alt", F.min(F.when(~F.col("no_primary") & (worth >= rules.min_locus), F.col("_r"))).over(locus))
    swap = F.col("_open") & F.col("_demoted") & F.col("_alt").isNotNull()
    s = s.withColumn("_open", F.col("_open") & (~F.col("_demoted") | F.col("_alt").isNotNull()))
    s = s.withColumn("rank", F.when(swap & (F.col("_r") == F.col("_alt")), 1).when(swap & (F.col("_r") < F.col("_alt")), F.col("_r") + 1).otherwise(F.col("_r")).cast("bigint"))
    stop = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    first = lambda c: F.max_by(c, -F.col("rank")).over(locus)
    s = s.withColumn("_introns1", first(F.col("introns"))).withColumn("_stop1", first(stop)).withColumn("_len1", first(F.col("cds_len")))
    s = s.withColumn("_novel", F.array_except("introns", "_introns1")).withColumn("novel_introns", F.size("_novel").cast("bigint"))
    known = F.size(F.array_intersect("_novel", "rna_set")) if "rna_set" in structures.columns else F.lit(0)
    s = s.withColumn("novel_rna_frac", F.when(F.col("novel_introns") > 0, F.coalesce(known, F.lit(0)) / F.col("novel_introns")))
    full = yes(F.col("chain_support") == "full") if "chain_support" in structures.columns else F.lit(False)
    dt = {"all": F.lit(True), "filtered": (stop == F.col("_stop1")) | (F.col("cds_len") >= 0.95 * F.col("_len1")), "none": F.lit(False)}[rules.iso_dt]
    dt = is_dt(r) & dt & (F.lit(not rules.iso_rna) | F.col("novel_rna_frac").isNull() | yes(F.col("novel_rna_frac") == 1.0)) & (F.lit(not rules.iso_dt_chains) | full)
    by_chain = full & (worth >= rules.iso_chain_min_tier) if rules.iso_chain_min_tier is not None else F.lit(False)
    why = (
        F.when(~F.col("_open"), "locus_below_min").when(F.col("rank") == 1, "primary").when(F.col("tier") >= rules.iso_min_tier, "isoform_tier")
        .when(by_chain, "isoform_chain").when(dt, "isoform_orf_agreement").otherwise("isoform_rejected")
    )
    s = s.withColumn("why", why).withColumn("keep", ~F.col("why").isin("locus_below_min", "isoform_rejected"))
    return s.drop("_r", "_open", "_demoted", "_alt", "_introns1", "_stop1", "_len1", "_novel")


def select_model(structures: DataFrame, t_locus: float, t_iso: float, order: list[str]) -> DataFrame:
    """rank, keep, why per locus from p (probability), unselectable and rescuable (booleans); ties by the order columns."""
    locus = Window.partitionBy("cluster")
    s = structures.withColumn("_p", F.when(F.col("unselectable"), -1.0).otherwise(F.col("p")))
    s = s.withColumn("_r", F.row_number().over(locus.orderBy(F.col("_p").desc(), *order)))
    s = s.withColumn("_open", F.max(F.when(F.col("_r") == 1, ~F.col("unselectable") & (F.col("p") >= t_locus))).over(locus))
    s = s.withColumn("_alt", F.min(F.when(F.col("rescuable") & ~F.col("unselectable"), F.col("_r"))).over(locus))
    saved = ~F.col("_open") & F.col("_alt").isNotNull()
    s = s.withColumn("rank", F.when(saved & (F.col("_r") == F.col("_alt")), 1).when(saved & (F.col("_r") < F.col("_alt")), F.col("_r") + 1).otherwise(F.col("_r")).cast("bigint"))
    why = (
        F.when(F.col("unselectable"), "dropped_lone_single_exon").when(~F.col("_open") & ~saved, "locus_below_min")
        .when(F.col("rank") == 1, F.when(saved, "primary_protein_rescue").otherwise("primary")).when(F.col("p") >= t_iso, "isoform_classifier").otherwise("isoform_rejected")
    )
    s = s.withColumn("why", why).withColumn("keep", F.col("why").startswith("primary") | (F.col("why") == "isoform_classifier"))
    return s.drop("_p", "_r", "_open", "_alt")


def shift_log_odds(p: Column, support: Column, full: float, partial: float) -> Column:
    """p after its log-odds move by full or partial; p is clamped to 1e-6 from its ends first; other supports leave it."""
    w = F.when(support == "full", F.lit(float(full))).when(support == "partial", F.lit(float(partial))).otherwise(0.0)
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.when(w == 0, p).otherwise(1 / (1 + F.exp(-(F.ln(q / (1 - q)) + w))))


def locus_threshold(model: dict, t_locus: float | None = None, unknown_clade: bool = False, fragmented: float | None = None) -> tuple[float, str]:
    """The locus threshold and where it comes from: given, fragmented assembly, the model's for unknown clades, the model's."""
    for value, source in ((t_locus, "t_locus"), (fragmented, "fragmented_assembly"), (model.get("t_locus_unknown_clade", model["t_locus"]) if unknown_clade else None, "model_unknown_clade")):
        if value is not None:
            return float(value), source
    return float(model["t_locus"]), "model"


def rescuable(min_cov: float, min_intron_frac: float) -> Column:
    return F.coalesce((F.col("n_exons") >= 2) & (F.col("dmd_qcov") >= min_cov) & (F.col("dmd_tcov") >= min_cov) & (F.col("prot_intron_frac") >= min_intron_frac), F.lit(False))


#: Evidence and structure columns that enter the model as they are, the broken numbers rounded as in the report.
MODEL_COLUMNS = [
    "prot_intron_frac", "prot_intron_min_n", "prot_start", "prot_stop", "prot_hints_in_span", "prot_extra", "prot_shifted", "prot_beyond", "dmd_hit", "dmd_bits_per_aa", "dmd_pident", "dmd_n_hits", "dmd_n_taxa", "dmd_qcov", "dmd_tcov",
    "dmd_len_ratio", "dmd_nterm_offset", "dmd_cterm_offset", "rna_frac", "rna_cov", "rna_min_mult", "tool_intron_frac", "novel_introns", "novel_rna_frac", "base_tier", "mp_train_match", "mp_rep_match", "dmd_bits",
]


def model_features(structures: DataFrame, roles: Roles) -> DataFrame:
    """structures with the features of the selection model: MODEL_COLUMNS (missing ones are null), by_<tool>, n_tools, dt, logarithms, and the context of the locus."""
    s = structures.withColumns({c: F.lit(None).cast("double") for c in MODEL_COLUMNS if c not in structures.columns})
    kinds = dict(s.dtypes)
    s = s.withColumns({c: rounded(F.col(c), 3) if kinds[c] == "double" else F.col(c).cast("double") for c in MODEL_COLUMNS})
    s = s.withColumns({f"by_{t}": has(t).cast("int") for t in roles.order}).withColumns({"n_tools": F.size("tools"), "ntools": F.size("tools"), "n_cds_exons": F.size("segs"), "dt": is_dt(roles).cast("int")})
    hits, taxa = F.col("dmd_n_hits"), F.col("dmd_n_taxa")
    s = s.withColumns({
        "log_cds_len": F.log10(F.greatest("cds_len", F.lit(1)).cast("double")), "log_mult": F.log1p("rna_min_mult"), "mp_match": F.greatest("mp_train_match", "mp_rep_match"),
        "hits_per_taxon": F.when(hits.isNull() | taxa.isNull(), None).when(taxa > 0, F.try_divide(hits, taxa)).when(hits > 0, float("inf")),
        "lr_dev": F.abs(F.ln(F.least(F.greatest("dmd_len_ratio", F.lit(0.01)), F.lit(100.0)))) * F.when(F.col("dmd_len_ratio").isNotNull(), 1.0),
    })
    return cluster_context(s)


def cluster_context(df: DataFrame) -> DataFrame:
    """Context features of a locus (A12, A13, A14) from base_tier, n_tools, cds_len, rna_frac, lr_dev, prot_intron_frac, dmd_hit, dmd_bits and log_mult; nulls are skipped."""
    w = Window.partitionBy("cluster")
    out = df.withColumns({"cl_n": F.count("*").over(w), "cl_maxtier": F.max("base_tier").over(w), "cl_max_ntools": F.max("n_tools").over(w), "cl_has_hit": F.max("dmd_hit").over(w)})
    most = F.max("dmd_bits").over(w)
    top = df.agg(F.max("n_tools").alias("n_tools"))
    ref = df.join(F.broadcast(top), "n_tools").agg(F.coalesce(F.median("log_mult"), F.lit(0.0)).alias("_ref"))
    one = lambda c: F.coalesce(c, F.lit(1.0))
    nil = lambda c: F.coalesce(c, F.lit(0.0))
    return out.crossJoin(F.broadcast(ref)).withColumns({
        "tier_gap": F.col("base_tier") - F.col("cl_maxtier"), "ntools_gap": F.col("n_tools") - F.col("cl_max_ntools"), "len_rel_cluster": F.col("cds_len") / F.max("cds_len").over(w),
        "log_mult_rel": F.col("log_mult") - F.col("_ref"), "rna_frac_rel": one(F.col("rna_frac")) - one(F.max("rna_frac").over(w)), "lr_dev_rel": F.col("lr_dev") - F.min("lr_dev").over(w),
        "pif_rel": nil(F.col("prot_intron_frac")) - nil(F.max("prot_intron_frac").over(w)), "dmd_bits_rel_cluster": F.when(most > 0, nil(F.col("dmd_bits")) / most),
    }).drop("_ref")
