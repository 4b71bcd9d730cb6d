"""Small steps between the large ones: ids, headers, selections, numbering, batches, tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import attrs as at
from ..functions.numbers import fixed
from ..functions.sequence import has_internal_stop
from .components import cut


def prefix_ids(attributes: Column, prefix: str, keys: tuple[str, ...] = ("gene_id", "transcript_id")) -> Column:
    """The ids in a GTF attribute text with a prefix."""
    return F.regexp_replace(attributes, rf'\b({"|".join(keys)}) "', rf'$1 "{prefix}')


def prefix_line_ids(attributes: Column, prefix: str) -> Column:
    """A raw GFF3 attribute text with <prefix>- in front of the values of ID and Parent, whatever blanks stand before the keys."""
    t = F.concat(F.lit(";"), attributes)
    for key in ("ID", "Parent"):
        t = F.regexp_replace(t, rf";\s*{key}=", f";{key}={prefix}-")
    return F.substring(t, F.lit(2), F.length(t))


def prefix_gff3_ids(entries: Column, prefix: str) -> Column:
    """ID and Parent values with a prefix."""
    add = lambda e: F.when(e["key"].isin("ID", "Parent"), F.struct(e["key"].alias("key"), F.transform(e["values"], lambda v: F.concat(F.lit(prefix), v)).alias("values"))).otherwise(e)
    return F.transform(entries, add)


def concat_sets(sets: dict[str, DataFrame], id_columns: list[str]) -> DataFrame:
    """Union of sets whose ids get the set's prefix."""
    out = None
    for name, df in sets.items():
        df = df.withColumns({c: F.concat(F.lit(f"{name}."), F.col(c).cast("string")) for c in id_columns})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sets")
    return out


def strict_union(frames: list[DataFrame]) -> DataFrame:
    """Union of tables that must have the same columns in the same order."""
    for f in frames[1:]:
        if f.columns != frames[0].columns:
            raise ValueError(f"columns differ: {frames[0].columns} and {f.columns}")
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def numbered(df: DataFrame, pattern: str, order: list[str], within: list[str], name: str) -> DataFrame:
    """name: pattern (such as rRNA_%d) filled with the row's number within its group."""
    w = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn(name, F.format_string(pattern, F.row_number().over(w)))


def clean_header(header: Column) -> Column:
    """The first word of a sequence header, carriage returns and tabs gone."""
    return F.regexp_extract(F.regexp_replace(header, "\r", ""), r"^([^\s]*)", 1)


def keep_species(proteins: DataFrame, species: DataFrame, key: Column) -> DataFrame:
    """Proteins whose species key is in the list (species)."""
    return proteins.withColumn("_k", key).join(species.select(F.col("species").alias("_k")).distinct(), "_k", "left_semi").drop("_k")


def aligned_enough(runs: DataFrame, least: float = 80.0) -> DataFrame:
    """Runs whose report text has an overall alignment rate of at least `least` percent."""
    rate = F.regexp_extract("report", r"([\d.]+)% overall alignment rate", 1).try_cast("double")
    return runs.withColumn("rate", rate).filter(F.col("rate") >= least)


def version_lines(lines: DataFrame) -> DataFrame:
    """Distinct lines of exactly three tab-separated fields, in order."""
    f = F.split("value", "\t")
    return lines.filter(F.size(f) == 3).select(F.get(f, F.lit(0)).alias("process"), F.get(f, F.lit(1)).alias("tool"), F.get(f, F.lit(2)).alias("version")).distinct().orderBy("process", "tool", "version")


def coding_only(features: DataFrame) -> DataFrame:
    return features.filter("type = 'CDS'")


def short_proteins(proteins: DataFrame, most: int = 100_000) -> DataFrame:
    """Proteins below `most` residues, trailing stops not counted."""
    return proteins.filter(F.length(F.regexp_replace("seq", r"\*+$", "")) < most)


def decorate(features: DataFrame, terms: DataFrame, key: str = "Ontology_term") -> DataFrame:
    """Features with the terms of their id (id, terms) added to an attribute; an error if no feature has any."""
    if terms.join(features.select("id").distinct(), "id", "left_semi").isEmpty() and not terms.isEmpty():
        raise ValueError("no term matched a feature")
    out = features.join(terms, "id", "left")
    return out.withColumn("attrs", F.when(F.col("terms").isNotNull(), at.append_values(F.col("attrs"), key, F.col("terms"))).otherwise(F.col("attrs"))).drop("terms")


def rna_counts(features: DataFrame) -> DataFrame:
    """type, subunit (of ribosomal RNA products, such as 18S), n."""
    subunit = F.nullif(F.regexp_extract("product", r"(\d+(?:\.\d+)?S)", 1), F.lit(""))
    return features.groupBy("type", F.when(F.col("type") == "rRNA", subunit).alias("subunit")).agg(F.count("*").alias("n"))


def reason_counts(report: DataFrame, column: str = "reason") -> DataFrame:
    return report.groupBy(F.coalesce(column, F.lit("kept")).alias(column)).agg(F.count("*").alias("n"))


def replaced_sequences(full: DataFrame, verdict: DataFrame, short: DataFrame) -> DataFrame:
    """cds_id, seq, source: the shortened form where the full one is judged incomplete and a shortened one exists, else the full one. full, short: cds_id, seq; verdict: cds_id, incomplete."""
    j = full.join(verdict, "cds_id", "left").join(short.select("cds_id", F.col("seq").alias("_short")), "cds_id", "left")
    use = F.coalesce(F.col("incomplete"), F.lit(False)) & F.col("_short").isNotNull()
    return j.select("cds_id", F.when(use, F.col("_short")).otherwise(F.col("seq")).alias("seq"), F.when(use, "shortened").otherwise("full").alias("source"))


def residue_batches(proteins: DataFrame, most_rows: int = 8, most_residues: int = 12_000, order: str = "id") -> DataFrame:
    """proteins (length, and a column that orders equal lengths) with batch: by rising length, groups of at most so many rows and so many residues, padded to the longest; a single longer record is a group of its own.

    Where a batch ends depends on lengths only, so it is worked out for each length from how many rows have it: one row a length reaches the driver. A row's batch then follows from its rank among the rows of its length, which is counted over ranges of the sorted table: batches are the same however many partitions there are.
    """
    if most_rows <= 0 or most_residues <= 0:
        raise ValueError("a batch must have room for a row and a residue")
    spark = proteins.sparkSession
    size = F.greatest(F.col("length").cast("bigint"), F.lit(1))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = proteins.withColumn("_size", size).repartitionByRange(parts, "_size", order).sortWithinPartitions("_size", order)
    rows = cut(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    # A row for each length and range that has it.
    here = rows.groupBy("_size", "_part").agg(F.min("_at").alias("_low"), F.count("*").alias("_n"))
    before = Window.partitionBy("_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    here = cut(here.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))), "ranges")
    plan, batch, held, room = [], 0, 0, 0
    for n, count in sorted((r["_size"], r["n"]) for r in here.groupBy("_size").agg(F.sum("_n").alias("n")).collect()):
        most = max(1, min(most_rows, most_residues // n))
        if held >= most:
            batch, held = batch + 1, 0
        room = most - held  # rows of this length that the open batch still takes
        plan.append((n, batch, room, most))
        if count <= room:
            held += count
        else:
            full, held = divmod(count - room - 1, most)
            batch, held = batch + 1 + full, held + 1
    plan = spark.createDataFrame(plan, "_size bigint, _batch bigint, _room bigint, _most bigint")
    k = F.col("_base") + F.col("_at") - F.col("_low")
    out = rows.join(here.join(plan, "_size"), ["_size", "_part"])
    return out.select(*proteins.columns, F.when(k < F.col("_room"), F.col("_batch")).otherwise(F.col("_batch") + 1 + F.floor((k - F.col("_room")) / F.col("_most"))).cast("bigint").alias("batch"))


def count_text(n: Column) -> Column:
    """A number as report text: thousands apart."""
    return F.format_number(n, 0)


def size_text(n: Column) -> Column:
    """Bytes as report text: whole up to 1024, else with one decimal in KB, MB, GB or TB."""
    units = ["B", "KB", "MB", "GB", "TB"]
    out = F.concat(fixed(n / float(1024**4), 1), F.lit(" TB"))
    for k in (3, 2, 1):
        out = F.when(n < 1024 ** (k + 1), F.concat(fixed(n / float(1024**k), 1), F.lit(f" {units[k]}"))).otherwise(out)
    return F.when(n < 1024, F.concat(n.cast("bigint").cast("string"), F.lit(" B"))).otherwise(out)


def internal_stop_share(proteins: DataFrame, most: float = 5.0) -> DataFrame:
    """One row: n proteins (seq), with_stop of them with a stop inside, percent, and warn: whether that is more than `most`."""
    one = proteins.agg(F.count("*").alias("n"), F.count(F.when(has_internal_stop(F.col("seq")), 1)).alias("with_stop"))
    return one.withColumn("percent", F.coalesce(F.try_divide(100.0 * F.col("with_stop"), F.col("n")), F.lit(0.0))).withColumn("warn", F.col("percent") > most)
