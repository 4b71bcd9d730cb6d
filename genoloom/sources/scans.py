"""Text formats as DataFrames. Every row keeps (file_ord, line_no): the order of lines in a file decides ties.

The text source has no line number, so lines are numbered by the block they are read in and their place there, file by file,
without leaving the JVM. Compressed files are read as they are, though not split.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import attrs as at
from .fasta import fasta, fasta_tiles  # noqa: F401


def lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """file_ord, line_no, value of every line of every file. A path may be a pattern with {a,b}; each file is one of its own, in order of the paths given, then of its name. Line numbers come from the blocks in which files are read: a block's lines are consecutive, and blocks follow by where they begin in their file."""
    out = None
    for k, p in enumerate([paths] if isinstance(paths, str) else paths):
        df = spark.read.text(p).select(F.lit(k).alias("_k"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value")
        # One row for each block of a file.
        blocks = df.groupBy("_k", "_file", "_block").agg(F.min("_id").alias("_low"), F.count("*").alias("_n"))
        before = Window.partitionBy("_k", "_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_ord", F.dense_rank().over(Window.partitionBy("_k").orderBy("_file")))
        # A row for each block: the lines stay where they are.
        df = df.join(F.broadcast(blocks), ["_k", "_file", "_block"]).select((F.col("_k") * 1_000_000 + F.col("_ord")).cast("bigint").alias("file_ord"), (F.col("_base") + F.col("_id") - F.col("_low")).alias("line_no"), "value")
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("no paths")
    return out


def _data(df: DataFrame) -> DataFrame:
    """Without blank and comment lines, and without what follows a ##FASTA line."""
    end = df.filter("value LIKE '##FASTA%'").groupBy("file_ord").agg(F.min("line_no").alias("_end"))
    df = df.join(F.broadcast(end), "file_ord", "left").filter("_end IS NULL OR line_no < _end").drop("_end")
    return df.filter("trim(value) <> '' AND NOT startswith(value, '#')")


def _columns(df: DataFrame) -> DataFrame:
    f = F.split("value", "\t")
    num = lambda i: F.get(f, F.lit(i)).try_cast("bigint")
    text = lambda i: F.get(f, F.lit(i))
    return df.select(
        "file_ord", "line_no", "value", F.size(f).alias("n_columns"), text(0).alias("seqid"), text(1).alias("source"), text(2).alias("type"), num(3).alias("start"), num(4).alias("end"),
        text(5).alias("score"), text(6).alias("strand"), text(7).alias("phase"), text(8).alias("attributes"),
    )


def _why() -> Column:
    """What breaks the nine-column contract in a line of _columns; null if nothing does."""
    return F.when(F.col("n_columns") != 9, "not nine columns").when(F.col("start").isNull() | F.col("end").isNull(), "coordinates are not numbers").when(F.col("start") > F.col("end"), "start behind end")


def feature_violations(df: DataFrame) -> DataFrame:
    """file_ord, line_no, message of the lines that break the nine-column contract."""
    return _columns(_data(df)).withColumn("message", _why()).filter("message IS NOT NULL").select("file_ord", "line_no", "message")


def _any_wrong(spark: SparkSession, paths: list[str] | str) -> bool:
    """Whether a line may break the contract (it may also lie behind a ##FASTA line): one pass over the text that numbers no lines."""
    text = spark.read.text([paths] if isinstance(paths, str) else paths).filter("trim(value) <> '' AND NOT startswith(value, '#')")
    return not _columns(text.select(F.lit(0).alias("file_ord"), F.lit(0).alias("line_no"), "value")).filter(_why().isNotNull()).isEmpty()


def gff3(spark: SparkSession, paths: list[str] | str, strict: bool = True) -> DataFrame:
    """Features with parsed attributes, id and parents (array). strict: an error if a line breaks the contract; else such lines are left out."""
    raw = lines(spark, paths)
    if strict and _any_wrong(spark, paths) and (first := feature_violations(raw).orderBy("file_ord", "line_no").first()):
        raise ValueError(f"line {first['line_no'] + 1} of file {first['file_ord']}: {first['message']}")
    c = _columns(_data(raw)).filter(_why().isNull())
    c = c.withColumn("attrs", at.parse_attributes(F.col("attributes")))
    return c.withColumn("id", at.get_first(F.col("attrs"), "ID")).withColumn("parents", F.coalesce(at.get_all(F.col("attrs"), "Parent"), F.array().cast("array<string>"))).drop("value", "n_columns")


def gtf(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Features of GTF lines of nine columns, with gene_id, transcript_id, cov, FPKM and TPM."""
    c = _columns(_data(lines(spark, paths))).filter("n_columns = 9 AND start IS NOT NULL AND end IS NOT NULL")
    pick = {k: at.gtf_attribute(F.col("attributes"), k) for k in ("gene_id", "transcript_id")}
    nums = {k.lower(): at.gtf_attribute(F.col("attributes"), k).try_cast("double") for k in ("cov", "FPKM", "TPM")}
    return c.withColumns(pick | nums).withColumn("attrs", at.parse_gtf_attributes(F.col("attributes"))).drop("value", "n_columns")


def dialect(spark: SparkSession, path: str) -> str:
    """gff3 or gtf, by what comes first in the text: the version line, or the attributes of a line of nine columns; gtf if there is neither."""
    f = F.split("value", "\t")
    form = F.when(F.col("value").startswith("##gff-version"), "gff3").when(~F.col("value").startswith("#") & (F.size(f) >= 9), F.when(F.get(f, F.lit(8)).contains(' "'), "gtf").otherwise("gff3"))
    first = lines(spark, path).withColumn("form", form).filter("form IS NOT NULL").agg(F.min_by("form", F.struct("file_ord", "line_no")).alias("form")).first()
    return first["form"] or "gtf"


def transcripts(features: DataFrame, tx: Column, gene: Column) -> DataFrame:
    """seqid, strand, tx_id, gene_id, tx_ord, exons, cds, stops from features; a child of several parents goes to each (tx may be an array column)."""
    f = features.withColumn("tx_id", F.explode(tx)) if dict(features.select(tx.alias("t")).dtypes)["t"].startswith("array") else features.withColumn("tx_id", tx)
    span = F.struct("start", "end")
    part = lambda *t: F.array_sort(F.collect_list(F.when(F.col("type").isin(*t), span)))
    out = f.withColumn("gene_id", gene).filter("tx_id IS NOT NULL").groupBy("file_ord", "seqid", "strand", "tx_id").agg(
        F.max("gene_id").alias("gene_id"), F.min("line_no").alias("tx_ord"), part("exon").alias("exons"), part("CDS").alias("cds"), part("stop_codon").alias("stops")
    )
    return out.filter(F.size("exons") + F.size("cds") > 0)


def gtf_transcripts(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """transcripts() of GTF, with cov, fpkm and tpm of their transcript lines (null where there are none)."""
    f = gtf(spark, paths)
    own = lambda c: F.max(F.when(F.col("type") == "transcript", F.col(c))).alias(c)
    key = ["file_ord", "seqid", "strand", "transcript_id"]
    values = f.filter("transcript_id IS NOT NULL").groupBy(*key).agg(own("cov"), own("fpkm"), own("tpm")).withColumnRenamed("transcript_id", "tx_id")
    return transcripts(f, F.col("transcript_id"), F.col("gene_id")).join(values, ["file_ord", "seqid", "strand", "tx_id"], "left")


def gff3_transcripts(spark: SparkSession, paths: list[str] | str, strict: bool = True) -> DataFrame:
    f = gff3(spark, paths, strict)
    kids = f.filter(F.col("type").isin("exon", "CDS", "stop_codon"))
    tx = f.filter(F.col("id").isNotNull() & (F.size("parents") > 0)).select(F.col("id").alias("_t"), F.get("parents", F.lit(0)).alias("_g")).distinct()
    out = transcripts(kids, F.col("parents"), F.lit(None).cast("string")).drop("gene_id")
    return out.join(tx, out["tx_id"] == tx["_t"], "left").withColumn("gene_id", F.coalesce("_g", F.concat("tx_id", F.lit(".gene")))).drop("_t", "_g")


def orphans(spark_features: DataFrame) -> DataFrame:
    """Features whose parent is no feature."""
    ids = spark_features.filter("id IS NOT NULL").select(F.col("id").alias("_p")).distinct()
    long = spark_features.select("*", F.explode("parents").alias("_p"))
    return long.join(ids, "_p", "left_anti").drop("_p")


def hints(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Hints with mult (1 where there is none), src, pri, group and class (rna, protein, combined, other); ends in order."""
    from ..operators.hints import source_class

    c = _columns(_data(lines(spark, paths))).filter("n_columns >= 8 AND start IS NOT NULL AND end IS NOT NULL")
    a = F.coalesce("attributes", F.lit(""))
    low, high = F.least("start", "end"), F.greatest("start", "end")
    return c.select(
        "file_ord", "line_no", "seqid", "source", "type", low.alias("start"), high.alias("end"), "score", "strand",
        F.coalesce(at.attribute(a, "mult").try_cast("bigint"), F.lit(1)).alias("mult"), F.coalesce(at.attribute(a, "src"), at.attribute(a, "source")).alias("src"), at.attribute(a, "pri").try_cast("int").alias("pri"),
        F.coalesce(at.attribute(a, "grp"), at.attribute(a, "group")).alias("grp"), (F.col("n_columns") >= 9).alias("attributes_given"),
    ).withColumn("class", source_class(F.col("src")))


# Hint types that stand for exons.
EXON_HINTS = ("exonpart", "CDSpart", "ep", "exon", "CDS")


def support_hints(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """seqid, strand ('.' if there is none), start, end (in order), kind (intron or exon), class (rna, protein, combined; other counts as no support) of the hints that can support gene models: introns and exon-like types on lines of nine columns."""
    h = hints(spark, paths).filter(F.col("type").isin("intron", *EXON_HINTS) & F.col("attributes_given"))
    strand = F.coalesce(F.nullif(F.trim("strand"), F.lit("")), F.lit("."))
    return h.select("seqid", strand.alias("strand"), "start", "end", F.when(F.col("type") == "intron", "intron").otherwise("exon").alias("kind"), "class")


def intron_hints(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """contig, start, end, mult: introns summed over files and strands."""
    return hints(spark, paths).filter(F.col("type").isin("intron", "intronpart")).groupBy(F.col("seqid").alias("contig"), "start", "end").agg(F.sum("mult").alias("mult"))


def protein_hints(spark: SparkSession, paths: list[str] | str) -> tuple[DataFrame, DataFrame]:
    """Introns (contig, strand, start, end, n from the score, 1 if there is none) and codon bases (contig, pos, kind)."""
    h = hints(spark, paths)
    n = F.coalesce(F.col("score").try_cast("double").cast("bigint"), F.lit(1))
    introns = h.filter("type IN ('intron', 'intronpart')").select(F.col("seqid").alias("contig"), "strand", "start", "end", n.alias("n"))
    kind = F.when(F.col("type").startswith("start"), "start").when(F.col("type").startswith("stop"), "stop")
    codons = h.withColumn("kind", kind).filter("kind IS NOT NULL").select(F.col("seqid").alias("contig"), F.explode(F.sequence("start", "end")).alias("pos"), "kind")
    return introns, codons.distinct()


def bedgraph(spark: SparkSession, paths: list[str] | str, min_depth: float = 0.0) -> DataFrame:
    """contig, start, end, depth: 1-based closed; lines below min_depth are left out."""
    f = F.split(F.trim("value"), r"\s+")
    df = lines(spark, paths).filter("trim(value) <> '' AND NOT value RLIKE '^(#|track|browser)'")
    df = df.select("file_ord", "line_no", F.get(f, F.lit(0)).alias("contig"), (F.get(f, F.lit(1)).try_cast("bigint") + 1).alias("start"), F.get(f, F.lit(2)).try_cast("bigint").alias("end"), F.get(f, F.lit(3)).try_cast("double").alias("depth"))
    return df.filter((F.col("depth") >= min_depth) & (F.col("start") <= F.col("end")))


_TYPES = {"qseqid": "string", "sseqid": "string", "pident": "double", "evalue": "double", "bitscore": "double"}
STD = ["qseqid", "sseqid", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "evalue", "bitscore"]
LAYOUTS = {14: [*STD, "qlen", "slen"], 12: STD, 8: ["qseqid", "sseqid", "pident", "length", "evalue", "bitscore", "qlen", "slen"]}


def first_word(subject: Column) -> Column:
    """A subject's id up to its first blank, which the search program may have written as an escape (backslash with t, n or a backslash)."""
    return F.get(F.split(subject, r"\\[tn\\]|\s", 2), F.lit(0))


def tabular_hits(spark: SparkSession, paths: list[str] | str, layout: int | None = None, cut_subject: bool = False) -> DataFrame:
    """Alignment hits of 14, 12 or 8 columns (found from the first line if not given), with query, subject (cut_subject: only its first_word) and line_no; numbers that are none become null."""
    raw = lines(spark, paths).filter("trim(value) <> '' AND NOT startswith(value, '#')")
    if layout is None:
        first = raw.orderBy("file_ord", "line_no").first()
        layout = len(first["value"].split("\t")) if first else 14
    if layout not in LAYOUTS:
        raise ValueError(f"hits of {layout} columns are not known")
    f = F.split("value", "\t")
    cols = [F.get(f, F.lit(i)).try_cast(_TYPES.get(n, "bigint")).alias({"qseqid": "query", "sseqid": "subject"}.get(n, n)) for i, n in enumerate(LAYOUTS[layout])]
    out = raw.select("file_ord", "line_no", *cols)
    return out.withColumn("subject", first_word(F.col("subject"))) if cut_subject else out


def cmscan(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Non-coding hits of format 2 that are included and not overlapped by a better one; coordinates in order."""
    f = F.split(F.trim("value"), r"\s+")
    g = lambda i: F.get(f, F.lit(i))
    df = lines(spark, paths).filter("trim(value) <> '' AND NOT startswith(value, '#')").filter(F.size(f) >= 27).filter((g(18) == "!") & (g(19) != "="))
    a, b = g(9).try_cast("bigint"), g(10).try_cast("bigint")
    return df.select("file_ord", "line_no", g(1).alias("family"), g(2).alias("accession"), g(3).alias("seqid"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), g(11).alias("strand"), g(16).try_cast("double").alias("score"), g(17).try_cast("double").alias("evalue"))


def completeness(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """file_ord, single, duplicated, fragmented, missing, n, complete (percentages) of summaries in either of two forms."""
    out = lines(spark, paths).groupBy("file_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"]), "\n").alias("t"))
    num = lambda p: F.regexp_extract("t", p, 1).try_cast("double")
    pick = lambda a, b: F.coalesce(num(a), num(b))
    out = out.select(
        "file_ord", pick(r"S:([\d.]+)%", r"S:\s*([\d.]+)\s*%").alias("single"), pick(r"D:([\d.]+)%", r"D:\s*([\d.]+)\s*%").alias("duplicated"),
        (pick(r"F:([\d.]+)%", r"F:\s*([\d.]+)\s*%") + F.coalesce(num(r"\bI:\s*([\d.]+)\s*%"), F.lit(0.0))).alias("fragmented"), pick(r"M:([\d.]+)%", r"M:\s*([\d.]+)\s*%").alias("missing"), pick(r"n:(\d+)", r"N:\s*(\d+)").cast("bigint").alias("n"),
    )
    return out.withColumn("complete", F.col("single") + F.col("duplicated"))


def accuracy_stats(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """level, sensitivity, precision of the level rows of an accuracy report."""
    p = r"^\s*(Base|Exon|Intron|Intron chain|Transcript|Locus) level:\s*([\d.]+)\s*\|\s*([\d.]+)"
    df = lines(spark, paths).filter(F.regexp_like("value", F.lit(p)))
    return df.select("file_ord", "line_no", F.lower(F.regexp_extract("value", p, 1)).alias("level"), F.regexp_extract("value", p, 2).cast("double").alias("sensitivity"), F.regexp_extract("value", p, 3).cast("double").alias("precision"))


def tsv(spark: SparkSession, path: str, header: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Comment lines (line_no, value), and rows as columns of text. The first row is the header if none is given."""
    raw = lines(spark, path).filter("trim(value) <> ''")
    comments, rows = raw.filter("startswith(value, '#')").select("line_no", "value"), raw.filter("NOT startswith(value, '#')")
    if header is None:
        first = rows.orderBy("line_no").first()
        header = first["value"].split("\t") if first else []
        rows = rows.filter(F.col("line_no") != (first["line_no"] if first else -1))
    f = F.split("value", "\t")
    return comments, rows.select("line_no", *[F.get(f, F.lit(i)).alias(n) for i, n in enumerate(header)])


def term_table(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """accession, term, score, description, category of functional terms from CSV with a header; a score that is no number is 0."""
    df = spark.read.option("header", True).option("escape", "\"").csv(paths)
    col = lambda *names: F.coalesce(*[F.col(n) for n in names if n in df.columns], F.lit(None).cast("string"))
    return df.select(
        col("query_accession", "accession").alias("accession"), col("go_id", "term").alias("term"), F.coalesce(col("reliability_index", "score").try_cast("double"), F.lit(0.0)).alias("score"),
        col("go_description", "description").alias("description"), col("category").alias("category"),
    )


def family_types(spark: SparkSession, path: str) -> DataFrame:
    """accession, kind of RNA families: the first and the third column of a table, whose header line, if it has one, begins with rfam_acc."""
    rows = tsv(spark, path, ["accession", "name", "kind"])[1]
    return rows.filter("accession <> 'rfam_acc' AND kind IS NOT NULL").select("accession", "kind")


def tier_table(spark: SparkSession, path: str) -> DataFrame:
    """tools, struct_class, tier; '*' is the class for all others."""
    rows = tsv(spark, path)[1]
    return rows.select("tools", "struct_class", F.col("tier").cast("double").alias("tier"))


def tree_model(path: str) -> dict:
    """A tree ensemble from JSON, checked for its parts; it is small and stays on the driver."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    for k in ("features", "baseline", "t_locus", "t_iso", "trees"):
        if k not in model:
            raise ValueError(f"the model lacks {k}")
    return model
