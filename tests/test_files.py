"""Scans and writers on small files."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from genoloom.functions import attrs as at
from genoloom.functions import sequence as sq
from genoloom.operators import annotate as an
from genoloom.operators import consensus as co
from genoloom.operators import genemodel as gm
from genoloom.sinks import writers as wr
from genoloom.sources import scans as sc


def put(path, text):
    path.write_text(text)
    return str(path)


GFF = """##gff-version 3
c1\tx\tgene\t1\t90\t.\t+\t.\tID=g1;Note=a%3Bb,c
c1\tx\tmRNA\t1\t90\t.\t+\t.\tID=t1;Parent=g1
c1\tx\tmRNA\t1\t60\t.\t+\t.\tID=t2;Parent=g1
c1\tx\texon\t1\t30\t.\t+\t.\tParent=t1,t2
c1\tx\texon\t51\t90\t.\t+\t.\tParent=t1
c1\tx\tCDS\t1\t30\t.\t+\t0\tParent=t1
##FASTA
>c1
ACGT
"""


def test_gff3(spark, tmp_path):
    f = sc.gff3(spark, put(tmp_path / "a.gff3", GFF))
    assert f.count() == 6
    g = f.filter("type = 'gene'").select(at.get_all(F.col("attrs"), "Note").alias("n"), at.format_attributes(F.col("attrs")).alias("t")).first()
    assert g["n"] == ["a;b", "c"] and g["t"] == "ID=g1;Note=a%3Bb,c"
    t = {r["tx_id"]: (len(r["exons"]), len(r["cds"]), r["gene_id"]) for r in sc.gff3_transcripts(spark, put(tmp_path / "b.gff3", GFF)).collect()}
    assert t == {"t1": (2, 1, "g1"), "t2": (1, 0, "g1")}
    assert sc.orphans(f).count() == 0


def test_strict_scan_refuses_bad_lines(spark, tmp_path):
    p = put(tmp_path / "a.gff3", "c1\tx\tgene\t9\t1\t.\t+\t.\tID=g\nc1\tx\tgene\t1\t2\t.\t+\t.\tID=h\n")
    with pytest.raises(ValueError, match="start behind end"):
        sc.gff3(spark, p)
    assert [r["id"] for r in sc.gff3(spark, p, strict=False).collect()] == ["h"]


def test_attributes_of_odd_forms(spark):
    df = spark.createDataFrame([("a=1;b;a=2,3;x=%zz+",)], "t string").select(at.parse_attributes(F.col("t")).alias("a"))
    assert [(e["key"], e["values"]) for e in df.first()["a"]] == [("a", ["2", "3"]), ("b", []), ("x", ["%zz+"])]
    m = df.select(at.append_values(F.col("a"), "a", F.array(F.lit("3"), F.lit("4"))).alias("a")).first()["a"]
    assert m[0]["values"] == ["2", "3", "4"]
    raw = spark.createDataFrame([("xID=1;ID=2",)], "t string").select(at.attribute(F.col("t"), "ID").alias("i")).first()["i"]
    assert raw == "2"


def test_gtf_and_dialect(spark, tmp_path):
    p = put(tmp_path / "a.gtf", 'c1\tx\ttranscript\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"; cov "2.5";\nc1\tx\texon\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t";\nshort line\n')
    r = sc.gtf(spark, p).filter("type = 'transcript'").first()
    assert (r["transcript_id"], r["cov"]) == ("t", 2.5)
    assert sc.dialect(spark, p) == "gtf" and sc.dialect(spark, put(tmp_path / "b.gff3", GFF)) == "gff3"
    assert sc.gtf_transcripts(spark, p).first()["tx_id"] == "t"


def test_hints(spark, tmp_path):
    p = put(tmp_path / "h.gff", "c\tx\tintron\t5\t9\t3\t+\t.\tmult=4;pri=4;src=E\nc\tx\tintron\t9\t5\t2\t-\t.\tsrc=P\nc\tx\tstart\t20\t22\t.\t+\t.\tsrc=P\n")
    assert [(r["start"], r["end"], r["mult"]) for r in sc.intron_hints(spark, p).collect()] == [(5, 9, 5)]
    i, c = sc.protein_hints(spark, p)
    assert sorted(r["n"] for r in i.collect()) == [2, 3] and sorted(r["pos"] for r in c.collect()) == [20, 21, 22]
    assert {r["class"] for r in sc.hints(spark, p).collect()} == {"rna", "protein"}


def test_bedgraph_and_back(spark, tmp_path):
    with gzip.open(tmp_path / "d.bg.gz", "wt") as f:
        f.write("c 0 10 2.5\nc 10 12 1\n")
    b = sc.bedgraph(spark, str(tmp_path / "d.bg.gz"), 2)
    assert [(r["start"], r["end"], r["depth"]) for r in b.collect()] == [(1, 10, 2.5)]
    wr.write_bedgraph(b, str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["c\t0\t10\t2.5"]


def test_hit_layouts(spark, tmp_path):
    row = ["q", "9606_1", "91.5", "50", "1", "0", "1", "50", "2", "51", "1e-9", "100", "55", "60"]
    r = sc.tabular_hits(spark, put(tmp_path / "h14", "\t".join(row) + "\n")).first()
    assert (r["query"], r["slen"], r["bitscore"]) == ("q", 60, 100.0)
    assert "slen" not in sc.tabular_hits(spark, put(tmp_path / "h12", "\t".join(row[:12]) + "\n")).columns
    with pytest.raises(ValueError):
        sc.tabular_hits(spark, put(tmp_path / "h9", "\t".join(row[:9]) + "\n"))


def test_fasta(spark, tmp_path):
    p = put(tmp_path / "a.fa", ">s1 first > one\nacgt\nAC\n\n>s2\n>s3 x\nTT\r\n")
    rows = {r["id"]: (r["description"], r["seq"], r["length"]) for r in sc.fasta(spark, p).collect()}
    assert rows == {"s1": ("first > one", "ACGTAC", 6), "s2": ("", "", 0), "s3": ("x", "TT", 2)}
    wr.write_fasta(sc.fasta(spark, p).filter("id = 's1'"), str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == [">s1 first > one", "ACGTAC"]


def test_reports_and_tables(spark, tmp_path):
    c = sc.completeness(spark, put(tmp_path / "b.txt", "C:90.0%[S:80.0%,D:10.0%],F:4.0%,M:6.0%,n:255\n")).first()
    assert (c["complete"], c["fragmented"], c["n"]) == (90.0, 4.0, 255)
    a = sc.accuracy_stats(spark, put(tmp_path / "s.txt", "# x\n  Locus level:  69.7   |   63.3 |\n")).first()
    assert (a["level"], a["sensitivity"], a["precision"]) == ("locus", 69.7, 63.3)
    comments, rows = sc.tsv(spark, put(tmp_path / "t.tsv", "#k v\na\tb\n1\t2\n"))
    assert comments.count() == 1 and rows.first()["b"] == "2"
    t = sc.tier_table(spark, put(tmp_path / "tiers", "tools\tstruct_class\ttier\nt0\t*\t4.5\n")).first()
    assert t["tier"] == 4.5
    go = sc.term_table(spark, put(tmp_path / "go.csv", "query_accession,go_id,reliability_index\np,GO:1,x\n")).first()
    assert (go["accession"], go["score"]) == ("p", 0.0)


def test_tree_model_file(spark, tmp_path):
    model = {"features": ["x"], "baseline": 0.0, "t_locus": 0.3, "t_iso": 0.4, "trees": [{"feat": [0, 0, 0], "thr": [1.0, 0, 0], "left": [1, 0, 0], "right": [2, 0, 0], "leaf": [False, True, True], "value": [0, -1.0, 2.0], "nan_left": [False] * 3}]}
    m = sc.tree_model(put(tmp_path / "m.json", json.dumps(model)))
    df = spark.createDataFrame([(0.5,), (2.0,), (None,), (float("inf"),)], "x double")
    p = [r["p"] for r in an.tree_scores(df, m).collect()]
    assert [round(v, 4) for v in p] == [0.2689, 0.8808, 0.8808, 0.8808]
    with pytest.raises(ValueError):
        an.tree_scores(df, m | {"features": ["y"]})
    assert co.locus_threshold(m) == (0.3, "model") and co.locus_threshold(m, 0.9)[1] == "t_locus"


def test_sequences(spark):
    df = spark.createDataFrame([("ATGAAATAGNNNAC",)], "s string")
    r = df.select(sq.translate(F.col("s")).alias("aa"), sq.reverse_complement(F.lit("ACGTRYN")).alias("rc"), sq.clean_protein(F.lit("M*K.A**")).alias("c"), sq.prepare_residues(F.lit("mUk*")).alias("e"), sq.has_internal_stop(F.lit("MK*A*")).alias("i"), sq.has_internal_stop(F.lit("MKA*")).alias("n")).first()
    assert (r["aa"], r["rc"], r["c"], r["e"], r["i"], r["n"]) == ("MK*X", "NRYACGT", "MXKXA", "M X K", True, False)


def test_sequence_checks(spark):
    seq = "ATG" + "AAA" * 5 + "TAA" + "CCC" + "ATGTAACCCTAG" + "GGGGGG"
    S = "array<struct<start:bigint,end:bigint>>"
    rows = [("ok", "+", [(1, 21)], [(1, 21)]), ("ext", "+", [(1, 30)], [(1, 18)]), ("stop", "+", [(25, 36)], [(25, 36)]), ("mod", "+", [(1, 20)], [(1, 20)]), ("none", "+", [(1, 20)], []), ("out", "+", [(4, 21)], [(1, 21)])]
    tx = spark.createDataFrame([(n, "c", st, x, c, 0) for n, st, x, c in rows], f"tx_id string, seqid string, strand string, exons {S}, cds {S}, first_phase int")
    got = {r["tx_id"]: r for r in gm.sequence_checks(tx, spark.createDataFrame([("c", seq)], "id string, seq string")).collect()}
    assert got["ok"]["action"] == "kept" and not got["ok"]["extended_stop"] and not got["ok"]["no_stop"]
    assert got["ext"]["extended_stop"] and got["ext"]["cds"][0]["end"] == 21
    assert [got[n]["reason"] for n in ("stop", "mod", "none", "out")] == ["internal_stop", "cds_length_mod3", "no_cds", "cds_outside_exon"]


def test_normalize_writes_a_contract_file(spark, tmp_path):
    rows = [("g", "t", "c", "+", "CDS", 1, 10), ("g", "t", "c", "+", "CDS", 21, 31), ("g", "t", "c", "+", "UTR", 32, 40), ("g", "t", "c", "+", "intron", 11, 20)]
    out, bad = gm.normalize(spark.createDataFrame(rows, "gene_id string, tx_id string, seqid string, strand string, type string, start bigint, end bigint"))
    assert bad.count() == 0
    wr.write_gff3(out, str(tmp_path / "o"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "o")).collect()]
    assert lines[0] == "##gff-version 3"
    assert [x.split("\t")[2] for x in lines[1:]] == ["gene", "mRNA", "exon", "CDS", "exon", "CDS", "three_prime_UTR"]
    assert [x.split("\t")[7] for x in lines if "\tCDS\t" in x] == ["0", "2"]


def test_utrs(spark):
    S = "array<struct<start:bigint,end:bigint>>"
    df = spark.createDataFrame([([(1, 100), (200, 300)], [(50, 100), (200, 250)], 20, 280)], f"x {S}, c {S}, l bigint, r bigint")
    got = df.select(an.utr_parts(F.col("x"), F.col("c"), F.col("l"), F.col("r")).alias("u")).first()["u"]
    assert [(u["start"], u["end"]) for u in got] == [(21, 49), (251, 279)]


def packed_one_by_one(lengths, least, most):
    total = sum(n for _, n in lengths)
    if total <= least or most <= 1:
        return [[x for x, _ in lengths]]
    groups, target = [([], 0)], max(least, -(-total // most))
    for x, n in lengths:
        if groups[-1][1] >= target:
            groups.append(([], 0))
        groups[-1] = (groups[-1][0] + [x], groups[-1][1] + n)
    while len(groups) > most:
        sums = [a[1] + b[1] for a, b in zip(groups, groups[1:], strict=False)]
        i = sums.index(min(sums))
        groups[i : i + 2] = [(groups[i][0] + groups[i + 1][0], sums[i])]
    return [g for g, _ in groups]


def test_packing():
    assert an.pack_sequences([(str(i), 50) for i in range(60)], 20, 20) == [[str(i), str(i + 1), str(i + 2)] for i in range(0, 60, 3)]
    assert an.pack_sequences([("a", 5), ("b", 6)], 20, 3) == [["a", "b"]] == an.pack_sequences([("a", 50), ("b", 60)], 20, 1)
    assert an.pack_sequences([], 20, 3) == []
    rng = random.Random(8)
    for _ in range(300):
        least, most = rng.randint(1, 40), rng.randint(1, 6)
        lengths = [(str(i), rng.choice([0, 1, 5, rng.randint(1, 60)])) for i in range(rng.randint(1, 25))]
        assert an.pack_sequences(lengths, least, most) == packed_one_by_one(lengths, least, most)
    assert an.pack_sequences([("a", 5), ("b", 30), ("c", 1)], 20) == [["a", "b"], ["c"]]


def test_selection_cases(spark):
    rows = [(1, 0, 0.4), (1, 1, 0.9), (1, 2, 0.35), (2, 3, 0.2)]
    df = spark.createDataFrame(rows, "cluster bigint, ord bigint, p double").withColumn("unselectable", F.lit(False)).withColumn("rescuable", F.lit(False))
    got = {r["ord"]: (r["rank"], r["why"]) for r in co.select_model(df, 0.25, 0.3, ["ord"]).collect()}
    assert got == {0: (2, "isoform_classifier"), 1: (1, "primary"), 2: (3, "isoform_classifier"), 3: (1, "locus_below_min")}
    assert co.select_model(df, 0.25, 0.38, ["ord"]).filter("ord = 2").first()["why"] == "isoform_rejected"


def test_chain_support_cases(spark):
    S = "array<struct<start:bigint,end:bigint>>"
    t = spark.createDataFrame([("c", "+", [(50, 200), (300, 400), (500, 700)])], f"contig string, strand string, exons {S}")
    cases = [([(100, 200), (300, 400), (500, 600)], "full"), ([(100, 200), (300, 400)], "full"), ([(100, 200), (300, 400), (550, 600)], "partial"), ([(100, 200), (500, 600)], "none"), ([(310, 390)], "full"), ([(390, 450)], "partial")]
    tx = spark.createDataFrame([("t0", str(i), i, "c", "+", s) for i, (s, _) in enumerate(cases)], f"tool string, tx_id string, tx_ord bigint, contig string, strand string, segs {S}")
    got = {r["rep"]["tx_id"]: r["chain_support"] for r in co.add_chains(co.build_structures(tx, ["t0"]), t, 64).collect()}
    assert [got[str(i)] for i in range(len(cases))] == [w for _, w in cases]


def test_each_file_of_a_pattern_is_its_own(spark, tmp_path):
    line = "c\ts\tgene\t{}\t{}\t.\t+\t.\tID={}"
    (tmp_path / "a.gff3").write_text("##gff-version 3\n" + line.format(1, 9, "g1") + "\n##FASTA\n>c\nACGT\n" + line.format(1, 9, "none") + "\n")
    (tmp_path / "b.gff3").write_text(line.format(20, 30, "g2") + "\n" + line.format(40, 50, "g3") + "\n")
    got = sc.gff3(spark, str(tmp_path / "*.gff3")).orderBy("file_ord", "line_no").select("id", "file_ord", "line_no").collect()
    assert [(r["id"], r["line_no"]) for r in got] == [("g1", 1), ("g2", 0), ("g3", 1)] and got[0]["file_ord"] < got[1]["file_ord"] == got[2]["file_ord"]
    assert {r["id"] for r in sc.gff3(spark, str(tmp_path / "{a,b}.gff3")).collect()} == {"g1", "g2", "g3"}
    assert sc.dialect(spark, str(tmp_path / "a.gff3")) == "gff3"
    (tmp_path / "none.txt").write_text("# nothing\n")
    assert sc.dialect(spark, str(tmp_path / "none.txt")) == "gtf"
    many = [f"l{i}" for i in range(5000)]
    (tmp_path / "long.txt").write_text("\n".join(many) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = sc.lines(spark, str(tmp_path / "long.txt")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r["line_no"]: r["value"] for r in rows} == dict(enumerate(many))


def test_combined_models_as_text(spark, tmp_path):
    rows = [("g1", "t1", "c", "+", [(11, 20), (31, 32)], [(1, 22), (31, 40)], ["b", "a"], "x", "s1"), ("g2", "t2", "c", "-", [(101, 102), (111, 122)], None, ["a"], "y", "s2")]
    span = "array<struct<start:bigint,end:bigint>>"
    df = spark.createDataFrame(rows, f"gene_id string, tx_id string, contig string, strand string, segs {span}, exons {span}, tools array<string>, tier string, source_id string")
    wr.write_combined(df, f"file://{tmp_path}/gtf")
    got = [r["value"].split("\t") for r in spark.read.text(f"file://{tmp_path}/gtf").collect()]
    assert [(g[2], int(g[3]), int(g[4]), g[7]) for g in got] == [
        ("transcript", 1, 40, "."), ("exon", 1, 22, "."), ("exon", 31, 40, "."), ("CDS", 11, 19, "0"), ("start_codon", 11, 13, "0"), ("stop_codon", 30, 32, "0"),
        ("transcript", 101, 122, "."), ("exon", 101, 102, "."), ("exon", 111, 122, "."), ("CDS", 112, 122, "0"), ("start_codon", 120, 122, "0"), ("stop_codon", 101, 103, "0"),
    ]
    assert got[0][8] == 'gene_id "g1"; transcript_id "t1"; tools "a,b"; tier "x"; source_id "s1";'
    assert got[1][8] == 'gene_id "g1"; transcript_id "t1";'
    wr.write_combined(df, f"file://{tmp_path}/gff", gff3=True)
    got = [r["value"].split("\t") for r in spark.read.text(f"file://{tmp_path}/gff").collect()]
    assert [(g[2], g[8]) for g in got[:5]] == [("gene", "ID=g1"), ("mRNA", "ID=t1;Parent=g1;tools=a,b;tier=x;source_id=s1"), ("exon", "ID=t1.exon1;Parent=t1"), ("exon", "ID=t1.exon2;Parent=t1"), ("CDS", "ID=t1.cds1;Parent=t1")]


def test_attributes_are_worked_out_once(spark, capsys):
    """Not once more for each key: a text is split at ; and its values at , in one place of the plan."""
    d = spark.range(3).select(F.concat_ws(";", *[F.concat(F.lit(f"k{i}="), "id", F.lit(",%3B")) for i in range(5)], F.lit("k1=last")).alias("a"))
    e = d.select(at.parse_attributes(F.col("a")).alias("e"))
    e.explain()
    assert capsys.readouterr().out.count("split(") <= 2
    assert [r["f"] for r in e.select(at.format_attributes(F.col("e")).alias("f")).collect()] == [f"k0={i},%3B;k1=last;k2={i},%3B;k3={i},%3B;k4={i},%3B" for i in range(3)]


def test_reading_joins_no_lines_with_their_errors(spark, tmp_path, capsys):
    path = put(tmp_path / "a.gff3", GFF)
    sc.gff3(spark, path).explain()
    assert "SortMergeJoin" not in (out := capsys.readouterr().out) and "LeftAnti" not in out
