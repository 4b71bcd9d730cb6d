"""Small operators on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from genoloom.functions import attrs as at
from genoloom.functions import numbers as nu
from genoloom.operators import annotate as an
from genoloom.operators import consensus as co
from genoloom.functions import sequence as sq
from genoloom.operators import genemodel as gm
from genoloom.operators import hints as hi
from genoloom.operators import hits as ht
from genoloom.operators import tidy as ti

SEGS = "array<struct<start:bigint,end:bigint>>"


def test_splice_strands_and_codon_hints(spark):
    seq = spark.createDataFrame([("c", "AAAGTCCCCCCCCCCCCCCAGTTATGAAATAGCTATTTTCAT")], "id string, seq string")
    i = spark.createDataFrame([("c", 4, 21, ".", 3), ("c", 1, 9, ".", 1), ("c", 1, 9, "-", 2)], "seqid string, start bigint, end bigint, strand string, mult bigint")
    assert sorted((r["start"], r["strand"], r["score"]) for r in hi.find_strands(i, seq).collect()) == [(1, "-", 2), (4, "+", 3)]
    cds = spark.createDataFrame([("a", "c", "+", 24, 32), ("b", "c", "-", 33, 42)], "tx string, seqid string, strand string, start bigint, end bigint")
    # Genes end before their stop codons: 24-29 is followed by TAG, 36-42 (minus) by CTA read backwards.
    cds = spark.createDataFrame([("a", "c", "+", 24, 29), ("b", "c", "-", 36, 42), ("d", "c", "+", 25, 30), ("e", "c", "-", 1, 3), ("f", "none", "+", 1, 9)], "tx string, seqid string, strand string, start bigint, end bigint")
    got = {(r["kind"], r["strand"], r["pos"]) for r in hi.codon_hints(cds, seq).collect()}
    assert got == {("start", "+", 24), ("stop", "+", 27), ("start", "-", 40), ("stop", "-", 36)}
    other = spark.createDataFrame([("c", "TTGAAGTGAACTGA")], "id string, seq string")
    cds = spark.createDataFrame([("a", "c", "+", 1, 6), ("b", "c", "+", 11, 13), ("g", "c", "+", 7, 11)], "tx string, seqid string, strand string, start bigint, end bigint")
    assert {(r["kind"], r["pos"]) for r in hi.codon_hints(cds, other).collect()} == {("start", 1), ("start", 11), ("stop", 4), ("stop", 9)}


def test_bases_over_tiles(spark):
    r = random.Random(3)
    text = "".join(r.choice("ACGT") for _ in range(3 * sq.TILE + 17))
    places = [1, 2, sq.TILE - 2, sq.TILE - 1, sq.TILE, sq.TILE + 1, 2 * sq.TILE, len(text) - 1, len(text), 0, -5, len(text) + 9]
    p = spark.createDataFrame([("s", x) for x in places], "seqid string, at bigint")
    got = {x["at"]: x["bases"] for x in sq.bases_at(p, spark.createDataFrame([("s", text)], "id string, seq string"), "at", 3).collect()}
    assert got == {x: text[x - 1 : x + 2] if x > 0 else "" for x in places}


def test_translation(spark):
    df = spark.createDataFrame([("ATGTTTNNNTAAgc",), ("",), (None,), ("atgé",), ("TGGUGA",)], "s string")
    assert [x["p"] for x in df.select(sq.translate(F.col("s")).alias("p")).collect()] == ["MFX*", "", None, "M", "WX"]


def test_assembly_introns_vote(spark):
    rows = [("t1", "c", "+", 10.0, 1, 200), ("t1", "c", "+", 10.0, 301, 400), ("t2", "c", ".", 3.6, 1, 200), ("t2", "c", ".", 3.6, 301, 350), ("t3", "c", "-", 0.2, 500, 510), ("t3", "c", "-", 0.2, 520, 530)]
    x = spark.createDataFrame(rows, "tx string, seqid string, strand string, cov double, start bigint, end bigint")
    got = {(r["start"], r["end"]): (r["strand"], r["n"], r["mult"]) for r in hi.assembly_introns(x).collect()}
    assert got == {(201, 300): ("+", 2, 14), (511, 519): ("-", 1, 1)}
    assert {r["mult"] for r in hi.assembly_introns(x, "count").collect()} == {2, 1}


def test_orf_headers_and_shortening(spark):
    df = spark.createDataFrame([("p1 type:5prime_partial tx1:10-99(+)", "AKMLV"), ("p2 type:complete tx:5-40(-)", "AK")], "h string, p string")
    o = ht.orf_header(F.col("h"))
    r = df.select(*[c.alias(k) for k, c in o.items()], ht.shorten(F.col("p"), o["start"], o["end"], o["strand"]).alias("s")).collect()
    assert (r[0]["type"], r[0]["start"], r[0]["end"], r[0]["strand"]) == ("5prime_partial", 10, 99, "+")
    assert tuple(r[0]["s"]) == ("MLV", 16, 99) and r[1]["s"] is None
    score = lambda a, b: ht.support_score(F.lit(9), F.lit(4), F.lit(3), F.lit(a), F.lit(b))
    x = df.select(score(90.0, 0.0).alias("a"), score(90.0, 90.0).alias("b"), score(90.0, 80.0).alias("c"), score(0.0, 80.0).alias("d"), score(20.0, 90.0).alias("e")).first()
    assert x["a"] == x["d"] == float("inf") and x["b"] == 3.0 == x["c"] and x["e"] > 1e100


def test_species_keys(spark):
    r = spark.range(1).select(ht.species_key(F.lit("9606_12:ab")).alias("a"), ht.species_key(F.lit("Homo_sapiens_1")).alias("b"), ht.species_key(F.lit("sp|P1_HUMAN x")).alias("c"), ht.species_key(F.lit("9606_12")).alias("d")).first()
    assert tuple(r) == ("9606", "Homo_sapiens", "sp|P1_HUMAN", "9606_12")


def test_rounding_like_the_reports(spark):
    xs = [0.0005, 2.675, 1.0005, 0.1235, 12345.6785]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select(nu.rounded(F.col("x"), 3).alias("r"), nu.fixed(F.col("x"), 1).alias("t")).collect()
    assert [r["r"] for r in got] == [round(x, 3) for x in xs] and [r["t"] for r in got] == [f"{x:.1f}" for x in xs]
    assert df.select(nu.percent(F.lit(1), F.lit(0)).alias("p")).first()["p"] == "NA"


def test_decorate_and_rename(spark):
    f = spark.createDataFrame([("g1", "ID=g1"), ("g2", "ID=g2;Ontology_term=GO:1")], "id string, t string").withColumn("attrs", at.parse_attributes(F.col("t")))
    terms = spark.createDataFrame([("g2", ["GO:1", "GO:2"])], "id string, terms array<string>")
    got = {r["id"]: r["x"] for r in ti.decorate(f, terms).select("id", at.format_attributes(F.col("attrs")).alias("x")).collect()}
    assert got == {"g1": "ID=g1", "g2": "ID=g2;Ontology_term=GO:1,GO:2"}
    with pytest.raises(ValueError):
        ti.decorate(f, terms.withColumn("id", F.lit("none")))
    p = f.select(at.format_attributes(ti.prefix_gff3_ids(F.col("attrs"), "x.")).alias("x")).first()["x"]
    assert p == "ID=x.g1"


def test_unions(spark):
    a, b = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(1,)], "id int")
    assert sorted(r["id"] for r in ti.concat_sets({"sr": a, "lr": b}, ["id"]).collect()) == ["lr.1", "sr.1"]
    with pytest.raises(ValueError):
        ti.strict_union([a, b.withColumnRenamed("id", "x")])
    assert ti.strict_union([a, b]).count() == 2


def test_filters_and_tallies(spark):
    r = spark.createDataFrame([("a", "x 91.2% overall alignment rate"), ("b", "79.9% overall alignment rate"), ("c", "none")], "run string, report string")
    assert [x["run"] for x in ti.aligned_enough(r).collect()] == ["a"]
    v = spark.createDataFrame([("p\tt\t1",), ("p\tt\t1",), ("p\tt",)], "value string")
    assert ti.version_lines(v).count() == 1
    n = spark.createDataFrame([("rRNA", "18S ribosomal RNA"), ("rRNA", "18S x"), ("tRNA", "tRNA-Ala")], "type string, product string")
    assert {(x["type"], x["subunit"], x["n"]) for x in ti.rna_counts(n).collect()} == {("rRNA", "18S", 2), ("tRNA", None, 1)}
    s = spark.createDataFrame([("a", "MKV**"), ("b", "MKVL")], "id string, seq string")
    assert [x["id"] for x in ti.short_proteins(s, 4).collect()] == ["a"]
    kinds = ["Gene; snRNA; snoRNA; CD-box;", "Cis-reg;", "Cis-reg; riboswitch;", "Cis-reg; IRES;", "Intron;", "Gene; rRNA;", "Gene; lncRNA;", "Gene; antisense;", "Gene; snRNA; snoRNA; scaRNA;", "Gene;", "", None]
    k = spark.createDataFrame([(i, x) for i, x in enumerate(kinds)], "i int, k string").select("i", an.rna_class(F.col("k")).alias("c")).orderBy("i").collect()
    assert [tuple(x["c"]) for x in k] == [
        ("snoRNA", "snoRNA"), ("regulatory_region", None), ("riboswitch", None), ("internal_ribosome_entry_site", None), ("autocatalytically_spliced_intron", None), ("rRNA", "rRNA"), ("lnc_RNA", "lncRNA"), ("antisense_RNA", "antisense_RNA"),
        ("scaRNA", "scaRNA"), ("ncRNA", "ncRNA"), ("ncRNA", "ncRNA"), ("ncRNA", "ncRNA"),
    ]


def test_hint_classes_and_transcript_rules(spark):
    c = spark.createDataFrame([(x,) for x in ["E", "W", "b2h", "P", "PH", "C", "M", "B", None]], "s string").select(hi.source_class(F.col("s")).alias("c")).collect()
    assert [x["c"] for x in c] == ["rna", "rna", "rna", "protein", "protein", "combined", "other", "other", "other"]
    rows = [(299, 9.0, 9.0, "+"), (300, None, 9.0, "+"), (300, 3.0, None, "+"), (300, 3.0, 0.9, "+"), (3000, 3.0, 0.4, "+"), (3000, 3.0, 0.6, "+"), (300, 3.0, 1.0, ".")]
    t = spark.createDataFrame(rows, "length int, cov double, tpm double, strand string")
    assert [x["reason"] for x in gm.transcript_filter(t).collect()] == ["length", "cov", "tpm", "tpm", "tpm_long", "pass_long_relaxed", "pass"]
    assert gm.transcript_filter(t, drop_unstranded=True).collect()[-1]["reason"] == "unstranded"
    gm.require_expression(t)
    with pytest.raises(ValueError):
        gm.require_expression(t.withColumns({"cov": F.lit(None).cast("double"), "tpm": F.lit(None).cast("double")}))


def test_tree_closure_ends_with_cycles(spark):
    f = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("f", "e"), ("x", "y"), ("y", "x")], "id string, parent string")
    got = sorted((r["root"], r["id"]) for r in gm.tree_closure(f, f.filter("id IN ('a', 'x')").select("id")).collect())
    assert got == [("a", c) for c in "abcdef"] + [("x", "x"), ("x", "y")]


def batches_one_by_one(rows, most_rows, most_residues):
    """Ids of each batch, by going through the sorted records."""
    out, now, longest = [], [], 0
    for i, n in sorted(rows, key=lambda r: (max(r[1], 1), r[0])):
        n = max(n, 1)
        if now and (len(now) >= most_rows or max(longest, n) * (len(now) + 1) > most_residues):
            out.append(now)
            now, longest = [], 0
        now, longest = [*now, i], max(longest, n)
    return out + [now] * bool(now)


@pytest.mark.parametrize(("most_rows", "most_residues"), [(8, 3000), (3, 100), (50, 1000), (1, 1)])
def test_residue_batches_do_not_depend_on_partitions(spark, most_rows, most_residues):
    rows = [(i, 100 * (i % 13)) for i in range(150)] + [(1000 + i, 7) for i in range(60)] + [(5000, 9999)]
    want = batches_one_by_one(rows, most_rows, most_residues)
    for parts in (1, 7):
        got: dict = {}
        for r in ti.residue_batches(spark.createDataFrame(rows, "id int, length int").repartition(parts), most_rows, most_residues).collect():
            got.setdefault(r["batch"], set()).add(r["id"])
        assert [got[b] for b in range(len(got))] == [set(b) for b in want]
    assert ti.residue_batches(spark.createDataFrame([], "id int, length int"), 8, 100).count() == 0


def test_a_failing_batch_is_tried_record_by_record(spark):
    def model(texts):
        if any("B" in t for t in texts):
            raise RuntimeError("CUDA error: out of memory")
        if any("X" in t for t in texts):
            raise ValueError("Sequence length 9 is over the maximum")
        return [[len(t), 1] for t in texts]

    p = spark.createDataFrame([(i, s) for i, s in enumerate(["MA", "MB", "MAA", "MX", "M"] * 4)], "id int, seq string").withColumn("length", F.length("seq")).withColumn("prepared", F.col("seq"))
    vectors, failures = an.embed(ti.residue_batches(p, 4, 100), model)
    assert {r["id"]: r["vec"] for r in vectors.collect()} == {i: [float(len(s)), 1.0] for i, s in enumerate(["MA", "MB", "MAA", "MX", "M"] * 4) if "B" not in s and "X" not in s}
    assert sorted(tuple(r) for r in failures.collect()) == sorted(
        [(i, "RuntimeError", "cuda_out_of_memory", "CUDA error: out of memory", 2) for i in range(1, 20, 5)] + [(i, "ValueError", "sequence_too_long", "Sequence length 9 is over the maximum", 2) for i in range(3, 20, 5)]
    )
    with pytest.raises(Exception, match="no such device"):
        an.embed(ti.residue_batches(p, 4, 100), lambda texts: (_ for _ in ()).throw(OSError("no such device")))


def test_pooling(spark):
    v = spark.createDataFrame([("p", [1.0, 2.0]), ("p", [3.0, 4.0]), ("q", [5.0, 6.0])], "accession string, vec array<double>")
    assert {r["accession"]: r["vec"] for r in an.mean_pooling(v).collect()} == {"p": [2.0, 3.0], "q": [5.0, 6.0]}


def test_tier_steps_in_order(spark):
    rules = co.Rules(drop_lone_single_exon=("t0",), rescue_lone_match=4.5)
    rows = [
        ("full", ["t0"], 2, 300, 1, 1, "full", 0.0, None),
        ("agree", ["t0"], 2, 300, 1, 0, "none", 1.0, None),
        ("rna", ["t0"], 2, 300, 1, 1, "none", 0.0, None),
        ("single", ["t0"], 1, 300, 0, 0, "none", None, None),
        ("match", ["t0"], 2, 300, 1, 0, "none", 0.0, 1),
        ("ab", ["t0", "t1"], 2, 300, 1, 0, "none", 0.0, None),
    ]
    df = spark.createDataFrame([(n, t, e, c, i, r, r * 1.0 if i else None, s, f, m) for n, t, e, c, i, r, s, f, m in rows], "name string, tools array<string>, n_exons bigint, cds_len bigint, n_introns bigint, rna_introns bigint, rna_frac double, chain_support string, tool_intron_frac double, mp_train_match bigint")
    got = {r["name"]: (r["base_tier"], r["tier"], r["adjustment"]) for r in co.assign_tiers(df, rules).collect()}
    assert got == {
        "full": (3.0, 6.0, "up_chain_support"), "agree": (3.0, 6.0, "up_intron_agreement"), "rna": (3.0, 6.0, "up_rna_support"),
        "single": (3.0, 2.0, "down_lone_single_exon"), "match": (3.0, 4.5, "up_lone_match"), "ab": (8.0, 8.0, None),
    }


def test_log_odds(spark):
    r = spark.range(1).select(co.shift_log_odds(F.lit(0.5), F.lit("full"), 1.0, 0.5).alias("a"), co.shift_log_odds(F.lit(0.3), F.lit("none"), 1.0, 0.5).alias("b"), co.shift_log_odds(F.lit(1.0), F.lit("full"), 1.0, 0.5).alias("c")).first()
    assert abs(r["a"] - 1 / (1 + 2.718281828459045**-1)) < 1e-12 and r["b"] == 0.3 and r["c"] < 1


def test_merge_is_idempotent(spark):
    rows = [(1, "c", "+", [(100, 200), (900, 1000)]), (2, "c", "+", [(400, 500)]), (3, "c", "+", [(100, 200), (900, 1000)]), (4, "c", "+", [(150, 300)])]
    tx = spark.createDataFrame([(i, s, d, x, x, 0) for i, s, d, x in rows], f"tx bigint, seqid string, strand string, exons {SEGS}, cds {SEGS}, utr_bp int")
    once = gm.merge_annotations(tx)
    got = {r["tx"]: (r["gene"], r["isoform"]) for r in once.collect()}
    assert got == {1: (1, 1), 4: (1, 2), 2: (2, 1)}
    again = {r["tx"]: (r["gene"], r["isoform"]) for r in gm.merge_annotations(once.select(*tx.columns)).collect()}
    assert again == got


def test_conflict_kinds(spark):
    tx = spark.createDataFrame([("t0", "a", 1, "c", "+", [(100, 200), (301, 400), (501, 600)])], f"tool string, tx_id string, tx_ord bigint, contig string, strand string, segs {SEGS}")
    h = spark.createDataFrame([("c", "+", 201, 300, 5), ("c", ".", 120, 150, 4), ("c", "+", 205, 300, 7), ("c", "+", 50, 120, 2), ("c", "-", 120, 150, 9)], "contig string, strand string, start bigint, end bigint, n bigint")
    r = co.add_conflicts(co.build_structures(tx, ["t0"]), h, 64).first()
    assert [r[c] for c in co.CONFLICTS] == [3, 1, 4, 1, 7, 1, 2]


def test_sizes_stops_prefixes_and_subjects(spark):
    from genoloom.sources import scans as sc

    def plain(n):
        size = float(n)
        for unit in ("B", "KB", "MB", "GB", "TB"):
            if size < 1024 or unit == "TB":
                return f"{int(size)} B" if unit == "B" else f"{size:.1f} {unit}"
            size /= 1024

    sizes = [0, 1, 1023, 1024, 1536, 1048575, 1048576, 5 * 1024**3 + 1, 1024**4, 7 * 1024**5]
    got = spark.createDataFrame([(n,) for n in sizes], "n bigint").select("n", ti.size_text(F.col("n")).alias("t")).collect()
    assert {r["n"]: r["t"] for r in got} == {n: plain(n) for n in sizes}
    p = spark.createDataFrame([("MA*",), ("M*A",), ("MA",)], "seq string")
    assert tuple(ti.internal_stop_share(p).first()) == (3, 1, 100.0 / 3, True)
    assert tuple(ti.internal_stop_share(p.limit(0)).first()) == (0, 0, 0.0, False)
    a = spark.createDataFrame([("ID=a; Parent=b;xID=c",), ("note=ID=1",), (" ID=q",)], "a string").select(ti.prefix_line_ids(F.col("a"), "t").alias("a"))
    assert [r["a"] for r in a.collect()] == ["ID=t-a;Parent=t-b;xID=c", "note=ID=1", "ID=t-q"]
    s = spark.createDataFrame([("p1\\tmore",), ("p2\\\\x",), ("p3 text",), ("p4",), ("p\\q",)], "s string").select(sc.first_word(F.col("s")).alias("s"))
    assert [r["s"] for r in s.collect()] == ["p1", "p2", "p3", "p4", "p\\q"]


def test_hit_features_fall_back_on_a_given_length(spark):
    hit = "struct<qlen:bigint,slen:bigint,qstart:bigint,qend:bigint,sstart:bigint,send:bigint,bitscore:double,pident:double>"
    h = (None, 50, 1, 90, 3, 48, 10.0, 99.0)
    df = spark.createDataFrame([("q", h, [h], 1, 1, 100)], f"query string, best {hit}, top array<{hit}>, n_hits bigint, n_taxa bigint, own bigint").withColumn("ql", F.col("own"))
    r = ht.hit_features(df, F.col("ql")).first()
    assert (r["dmd_len_ratio"], r["dmd_cterm_offset"], r["dmd_bits_per_aa"]) == (2.0, 8.0, 0.1)


def test_types_and_biotypes_of_rna_features(spark):
    rows = [("lncRNA", None, None), ("transcript", None, "lncRNA"), ("transcript", None, None), ("tRNA", "x", "y"), ("snRNA", "", "y"), ("lnc_RNA", None, "")]
    c = F.col
    got = spark.createDataFrame(rows, "k string, g string, b string").select(an.locus_rna_type(c("k"), c("b")).alias("t"), an.locus_biotype(c("k"), c("g"), c("b")).alias("b")).collect()
    assert [tuple(r) for r in got] == [("lnc_RNA", "lncRNA"), ("lnc_RNA", "lncRNA"), ("transcript", "ncRNA"), ("tRNA", "x"), ("snRNA", "y"), ("lnc_RNA", "lncRNA")]
