"""Long spans beside short bins: they must not be copied into a row for each bin with all they carry."""

from pyspark.sql import functions as F

from genoloom.operators import annotate as an
from genoloom.operators import consensus as co
from genoloom.operators import intervals as iv


def test_conflicts_bin_only_the_ends_of_spans(spark, monkeypatch):
    seen, bins = [], iv._bins
    monkeypatch.setattr(iv, "_bins", lambda df, s, e, w: seen.append((set(df.columns), bins(df, s, e, w).count())) or bins(df, s, e, w))
    chain = [(1, 50), (100_001, 100_060)]
    tx = spark.createDataFrame([("t0", 1, 1, "c", "+", chain)], "tool string, tx_id int, tx_ord int, contig string, strand string, segs array<struct<start:bigint,end:bigint>>")
    hints = spark.createDataFrame([("c", "+", 51, 100_000, 3), ("c", "+", 10, 20, 4), ("c", "+", 60, 90, 5), ("c", "+", 100_050, 100_070, 6)], "contig string, strand string, start bigint, end bigint, n bigint")
    r = co.add_conflicts(co.build_structures(tx, ["t0"]), hints, 64).select(*co.CONFLICTS).first()
    assert tuple(r) == (3, 1, 4, 1, 5, 1, 6)
    assert all("segs" not in c and "introns" not in c for c, _ in seen) and max(n for _, n in seen) < 100


def test_matches_with_a_very_long_intron(spark):
    far = 1 << 38
    chain = "array<struct<start:bigint,end:bigint>>"
    cand = spark.createDataFrame([(1, "c", "+", [(5, 9)], []), (2, "c", "+", [(500, 600)], [])], f"tx_id int, seqid string, strand string, cds {chain}, introns {chain}")
    st = spark.createDataFrame([(7, "c", "+", False, 20, [(1, 10), (far, far + 9)], [(11, far - 1)]), (8, "c", "+", True, 220, [(450, 550), (590, 700)], [(551, 589)])], f"st_ord int, seqid string, strand string, is_long boolean, length int, exons {chain}, introns {chain}")
    got = an.match_transcripts(cand, st, 64).select("tx_id", F.col("st.st_ord")).collect()
    assert [tuple(r) for r in got] == [(1, 7)]
