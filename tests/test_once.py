"""Steps that use their input several times work it out once."""

from pyspark.sql import functions as F

from genoloom.operators import consensus as co
from genoloom.operators import genemodel as gm


def test_loci_and_agreement_read_structures_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(tool):
        seen.add(1)
        return tool

    rows = [(f"t{i % 3}", f"x{i}", i, f"c{i % 2}", "+-"[i // 2 % 2], [(100 * (i // 4), 100 * (i // 4) + 20), (100 * (i // 4) + 50, 100 * (i // 4) + 90 + i % 7)]) for i in range(60)]
    tx = spark.createDataFrame(rows, "tool string, tx_id string, tx_ord long, contig string, strand string, segs array<struct<start:bigint,end:bigint>>")
    tx = tx.withColumn("tool", told.asNondeterministic()("tool"))
    got = co.add_agreement(co.add_loci(co.build_structures(tx, ["t0", "t1", "t2"]))).collect()
    assert seen.value == 60
    spans = {}
    for r in got:
        spans.setdefault(r["cluster"], []).append((r["contig"], r["strand"], r["start"], r["end"]))
    assert all(len({x[:2] for x in s}) == 1 for s in spans.values())
    assert len(got) == len({(r["contig"], r["strand"], str(r["segs"])) for r in got})
    # Structures of one place share the first intron; it is agreed where another tool has it.
    for r in got:
        others = {t for o in got if (o["contig"], o["strand"], o["introns"]) == (r["contig"], r["strand"], r["introns"]) for t in o["tools"]}
        assert r["agreed"] == bool(others - set(r["tools"]))


def test_normal_form_reads_features_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(kind):
        seen.add(1)
        return kind

    rows = [(f"g{i // 4}", f"t{i // 4}", "c", "+", "CDS" if i % 8 < 4 else "exon", 100 * (i % 4) + 1, 100 * (i % 4) + 30) for i in range(40)]
    f = spark.createDataFrame(rows, "gene_id string, tx_id string, seqid string, strand string, type string, start long, end long")
    out, bad = gm.normalize(f.withColumn("type", told.asNondeterministic()("type")))
    assert out.count() == 80 and bad.count() == 0  # 10 genes, 10 transcripts, 40 exons, 20 coding segments
    assert seen.value == 40
