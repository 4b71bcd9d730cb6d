"""Sequences as strings; coordinates 1-based closed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# IUPAC codes and their complements.
IUPAC = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn"
COMPLEMENT = "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"
# Genetic code 1, codons in the order T, C, A, G of each base.
BASES = "TCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def piece(seq: Column, start: Column, end: Column) -> Column:
    """Bases start..end; empty if start is below 1."""
    return F.when(start < 1, F.lit("")).otherwise(F.substring(seq, start.cast("int"), (end - start + 1).cast("int")))


#: Bases of a tile: what a row of a sequence table holds when places in it are looked up.
TILE = 8192


def tiles(sequences: DataFrame) -> DataFrame:
    """id, tile, bases: pieces of TILE bases of sequences (id, seq), or sequences as they are if they are tiles already (fasta_tiles)."""
    if "tile" in sequences.columns:
        return sequences.select("id", "tile", "bases")
    n = F.ceil(F.length("seq") / F.lit(TILE)).cast("int")
    t = sequences.filter("length(seq) > 0").select("id", "seq", F.explode(F.sequence(F.lit(0), n - 1)).alias("tile"))
    return t.select("id", "tile", F.substring("seq", F.col("tile") * TILE + 1, F.lit(TILE)).alias("bases"))


def spliced_at(parts: DataFrame, sequences: DataFrame, keys: list[str]) -> DataFrame:
    """keys, text: the bases start..end of the parts (keys, seqid, start, end) of each key, put together by place, read from sequences (id, seq, or id, tile, bases). Parts meet the tiles they lie on and no whole sequence; places outside a sequence give nothing, keys none of whose places exist are missing."""
    low, high = F.greatest(F.col("start"), F.lit(1)), F.col("end")
    cover = F.sequence(F.floor((low - 1) / TILE), F.floor((high - 1) / TILE))
    p = parts.filter(high >= low).select(*keys, "seqid", low.alias("_s"), high.alias("_e"), F.explode(cover.cast("array<int>")).alias("_tile"))
    t = tiles(sequences).select(F.col("id").alias("seqid"), F.col("tile").alias("_tile"), F.col("bases").alias("_bases"))
    zero = F.col("_tile") * TILE
    at = F.greatest(F.col("_s") - zero, F.lit(1))
    own = F.substring("_bases", at.cast("int"), F.least(F.col("_e") - zero - at + 1, F.lit(TILE)).cast("int"))
    found = p.join(t, ["seqid", "_tile"]).select(*keys, F.struct("_s", "_e", "_tile", own.alias("b")).alias("_p"))
    return found.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda x: x["b"]), "").alias("text"))


def bases_at(places: DataFrame, sequences: DataFrame, at: str, n: int) -> DataFrame:
    """places (seqid, at ...) with bases: the n bases of their sequence (id, seq) from `at` on, empty where `at` lies below 1, fewer at the end. Places meet tiles and not whole contigs; those on unknown sequences are left out."""
    p = places.withColumn("_at", F.col(at).cast("bigint"))
    asked = p.filter("_at >= 1").select("seqid", "_at").distinct().select("seqid", "_at", F.col("_at").alias("start"), (F.col("_at") + n - 1).alias("end"))
    text = spliced_at(asked.withColumn("_of", F.col("seqid")), sequences, ["_of", "_at"]).withColumnsRenamed({"_of": "seqid", "text": "bases"})
    known = sequences.select(F.col("id").alias("seqid")).distinct()
    return p.join(known, "seqid", "left_semi").join(text, ["seqid", "_at"], "left").withColumn("bases", F.coalesce("bases", F.lit(""))).drop("_at")


@F.arrow_udf(StringType())
def _translated(seqs: pa.Array, unknown: pa.Array) -> pa.Array:
    """One table look-up for each codon of a batch: six bits of three bases give the amino acid."""
    code = np.full(256, 64, np.int64)
    for i, b in enumerate(BASES):
        code[ord(b)] = code[ord(b.lower())] = i
    amino = np.frombuffer(AMINO.encode(), np.uint8)
    out = []
    for seq, x in zip(seqs.to_pylist(), unknown.to_pylist(), strict=True):
        if seq is None:
            out.append(None)
            continue
        b = code[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
        b = b[: len(b) // 3 * 3].reshape(-1, 3)
        known = b.max(1, initial=0) < 64
        letters = np.full(len(b), ord(x), np.uint8)
        letters[known] = amino[b[known] @ np.array([16, 4, 1])]
        out.append(letters.tobytes().decode())
    return pa.array(out, pa.string())


def translate(seq: Column, unknown: str = "X") -> Column:
    """Amino acids of whole codons, genetic code 1; an unknown codon gives X, a tail of one or two bases nothing."""
    return _translated(seq, F.lit(unknown))


def spliced(seq: Column, segs: Column, strand: Column, phase: Column | None = None) -> Column:
    """The segments of a chain put together on their strand, without the phase's first bases."""
    joined = F.array_join(F.transform(F.array_sort(segs), lambda s: piece(seq, s["start"], s["end"])), "")
    out = F.when(strand == "-", reverse_complement(joined)).otherwise(joined)
    return out if phase is None else F.substring(out, phase.cast("int") + 1, F.length(out))


def has_internal_stop(protein: Column) -> Column:
    """A stop ('*' or '.') before the last residue, the trailing stops left out."""
    return F.regexp_like(F.regexp_replace(protein, r"\*+$", ""), F.lit(r"[*.]"))


def clean_protein(protein: Column) -> Column:
    """Trailing stops cut, inner ones as X."""
    return F.regexp_replace(F.regexp_replace(protein, r"\*+$", ""), r"[*.]", "X")


def splice_strands(seq: Column, start: Column, end: Column, pairs: tuple[str, ...] = ("gtag", "gcag", "atac")) -> Column:
    """Strands (array) for which an intron's ends are allowed dinucleotides: '+', '-', both or none."""
    ends = F.lower(F.concat(piece(seq, start, start + 1), piece(seq, end - 1, end)))
    back = F.lower(reverse_complement(ends))
    return F.filter(F.array(F.when(ends.isin(*pairs), "+"), F.when(back.isin(*pairs), "-")), lambda x: x.isNotNull())


def iupac_to_n(seq: Column) -> Column:
    return F.regexp_replace(seq, "[^ACGTNacgtn]", "N")


def prepare_residues(protein: Column) -> Column:
    """For embedding: upper case, rare residues (U, Z, O, B) as X, stops cut, one space between residues."""
    clean = F.regexp_replace(F.upper(F.regexp_replace(protein, r"[*.\s-]", "")), "[UZOB]", "X")
    return F.array_join(F.filter(F.split(clean, ""), lambda x: x != ""), " ")


def starts_with_atg(cds: Column) -> Column:
    return F.upper(F.substring(cds, 1, 3)) == "ATG"
