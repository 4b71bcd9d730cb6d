"""FASTA by byte ranges: a record of any length is read by as many tasks as it has ranges.

A range begins at a byte and looks back for the line it lies in, so that it knows whether it is inside a header; headers that begin
in a range belong to it whole, bases to the range they stand in. A first pass gives headers and lengths only, from which
each piece learns its record (the last header before it, carried over ranges) and its place there; bases are read in a second pass
and meet the places by range and number. No step holds more than PIECE bases of a record, unless whole records are asked for.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.sequence import TILE
from ..operators.components import cut

#: Bytes of a range, bases of a piece, and how far a range looks back for the start of its line: no header is longer.
RANGE = 32 << 20
PIECE = 1 << 20
HEADER = 1 << 20
CHUNK = 4 << 20
#: Short ranges, and short files, are read together by one task, up to so many bytes, once there is work for so many tasks.
TASK = 32 << 20
TASKS = 256
PIECES = "file_ord bigint, range bigint, record bigint, header_at bigint, header string, piece bigint, n bigint, bases string"
BLANKS = b" \t\r\n\x0b\x0c"


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return path.removeprefix("file://").removeprefix("file:")
    return path if "://" not in path else None


class _Bytes:
    """A file by byte offset; of a compressed one the bytes in it, one after the other."""

    def __init__(self, path: str):
        import gzip

        from pyarrow import fs

        local = _local(path)
        system, name = (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(path.replace("s3a://", "s3://"))
        self.packed = path.endswith(".gz")
        self.file = gzip.GzipFile(fileobj=system.open_input_stream(name, compression=None)) if self.packed else system.open_input_file(name)

    def at(self, offset: int, n: int) -> bytes:
        return self.file.read(n) if self.packed else self.file.read_at(n, offset)


def _inside_header(file: _Bytes, start: int) -> tuple[bool, bool]:
    """Whether `start` lies in a header line behind its first byte, and whether it is the start of a line."""
    if not start:
        return False, True
    low = max(0, start - HEADER)
    before = file.at(low, start - low)
    line = before.rfind(b"\n") + 1
    if line == len(before):
        return False, True
    return (line > 0 or low == 0) and before[line : line + 1] == b">", False


def scan_range(file: _Bytes, start: int, stop: int):
    """(record, header_at, header, piece, bases) of a range: record 0 is what goes on from before; a header comes as piece 0 of its record."""
    skipping, fresh = _inside_header(file, start)
    record, header_at, piece, text = 0, None, 0, b""
    header, own = skipping, False
    at, held = start, b""

    def said():
        return record, header_at, text.decode("utf-8", "replace").replace("\r", ""), 0, b""

    while at < stop:
        block = file.at(at, min(CHUNK, stop - at))
        if not block:
            break
        i = 0
        while i < len(block):
            if header:
                j = block.find(b"\n", i)
                text += block[i : j if j >= 0 else len(block)]
                i = j + 1 if j >= 0 else len(block)
                if j >= 0:
                    if own:
                        yield said()
                    header, fresh, text = False, True, b""
            elif fresh and block[i] == 62:
                if held:
                    yield record, header_at, None, piece + 1, held
                record, header_at, piece, text, held = record + 1, at + i, 0, b"", b""
                header, own, i = True, True, i + 1
            else:
                j = block.find(b"\n>", i)
                end = j + 1 if j >= 0 else len(block)
                held += block[i:end].translate(None, BLANKS)
                fresh, i = block[end - 1] == 10, end
                while len(held) >= PIECE:
                    piece += 1
                    yield record, header_at, None, piece, held[:PIECE]
                    held = held[PIECE:]
        at += len(block)
    if header and own:
        # The header goes on behind the range.
        while block := file.at(at, 1 << 16):
            j = block.find(b"\n")
            text += block if j < 0 else block[:j]
            at += len(block)
            if j >= 0:
                break
        yield said()
    if held:
        yield record, header_at, None, piece + 1, held


class _Ranges(InputPartition):
    """Ranges (file_ord, path, number, start, stop) of one task, in order."""

    def __init__(self, ranges: list[tuple[int, str, int, int, int]]):
        self.ranges = ranges


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.files, self.range = json.loads(options["files"]), int(options.get("range", RANGE))
        self.bases = options.get("bases", "true") == "true"

    def partitions(self):
        out, held, size = [], [], 0
        most = min(TASK, sum(length for _, _, length in self.files) // TASKS)
        for file_ord, path, length in self.files:
            packed = path.endswith(".gz")
            for k, a in enumerate([0] if packed else range(0, length, self.range)):
                n = length if packed else min(self.range, length - a)
                if held and size + n > most:
                    out.append(_Ranges(held))
                    held, size = [], 0
                held.append((file_ord, path, k, a, 1 << 62 if packed else a + n))
                size += n
        return [*out, _Ranges(held)] if held else out

    def read(self, part: _Ranges):
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.string() if f.endswith("string") else pa.int64() for f in PIECES.split(", ")]
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        file, opened = None, None
        for file_ord, path, number, start, stop in part.ranges:
            if opened != path:
                file, opened = _Bytes(path), path
            for record, header_at, header, piece, bases in scan_range(file, start, stop):
                text = bases.decode("latin-1").upper() if self.bases else None
                rows.append((file_ord, number, record, header_at, header, piece, len(bases), text))
                size += 200 + (len(bases) if self.bases else 0)
                if size > CHUNK:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()


class FastaPieces(DataSource):
    """Pieces of FASTA files; options: files (JSON of [file_ord, path, length]), range (bytes), bases (false: lengths only)."""

    @classmethod
    def name(cls) -> str:
        return "fasta_pieces"

    def schema(self) -> str:
        return PIECES

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def _files(spark: SparkSession, paths: list[str] | str) -> str:
    """Names and sizes of the files, in order of the paths given, then of their names."""
    out = []
    for k, p in enumerate([paths] if isinstance(paths, str) else paths):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p).select("path", "length").collect()
        out += [(k * 1_000_000 + i, r["path"], r["length"]) for i, r in enumerate(sorted(found), 1)]
    return json.dumps(out)


def fasta_pieces(spark: SparkSession, paths: list[str] | str, size: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """Records (file_ord, seq_ord, id, description, length), and their pieces (file_ord, seq_ord, off, bases; upper case; off counts bases from 0)."""
    spark.dataSource.register(FastaPieces)
    scan = lambda bases: spark.read.format("fasta_pieces").option("files", files).option("range", size).option("bases", bases).load()
    files = _files(spark, paths)
    # A row for each range, and for each piece: lengths, not bases; written, as five tables come from it.
    about = cut(scan("false").drop("bases"), "fasta")
    ranges = about.groupBy("file_ord", "range").agg(F.max("header_at").alias("_last"))
    before = Window.partitionBy("file_ord").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carry = ranges.select("file_ord", "range", F.last("_last", ignorenulls=True).over(before).alias("_from"))
    known = about.join(carry, ["file_ord", "range"]).withColumn("seq_ord", F.coalesce("header_at", "_from")).filter("seq_ord IS NOT NULL")
    place = Window.partitionBy("file_ord", "seq_ord").orderBy("range", "piece")
    off = F.sum("n").over(place) - F.col("n")
    pieces = known.filter("n > 0").select("file_ord", "range", "record", "piece", "seq_ord", off.alias("off"))
    head = F.trim("header")
    records = known.filter("header IS NOT NULL").select("file_ord", "seq_ord", F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(F.regexp_extract(head, r"^\S*\s*(.*)$", 1)).alias("description"))
    total = known.groupBy("file_ord", "seq_ord").agg(F.sum("n").cast("bigint").alias("length"))
    bases = scan("true").filter("n > 0").select("file_ord", "range", "record", "piece", "bases")
    return records.join(total, ["file_ord", "seq_ord"]), bases.join(pieces, ["file_ord", "range", "record", "piece"]).select("file_ord", "seq_ord", "off", "bases")


def fasta_tiles(spark: SparkSession, paths: list[str] | str, tile: int = TILE, size: int = RANGE) -> DataFrame:
    """file_ord, seq_ord, id, tile, bases: each record in tiles of so many bases, for joins by place; records without bases have none."""
    records, pieces = fasta_pieces(spark, paths, size)
    first, last = F.floor(F.col("off") / tile), F.floor((F.col("off") + F.length("bases") - 1) / tile)
    low = F.greatest(F.col("off"), F.col("tile") * tile)
    part = F.substring("bases", (low - F.col("off") + 1).cast("int"), F.least(F.lit(tile), (F.col("tile") + 1) * tile - low).cast("int"))
    cells = pieces.withColumn("tile", F.explode(F.sequence(first, last))).select("file_ord", "seq_ord", F.col("tile").cast("int").alias("tile"), low.alias("low"), part.alias("part"))
    whole = cells.groupBy("file_ord", "seq_ord", "tile").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("low", "part"))), lambda x: x["part"]), "").alias("bases"))
    return whole.join(records.select("file_ord", "seq_ord", "id"), ["file_ord", "seq_ord"]).select("file_ord", "seq_ord", "id", "tile", "bases")


def fasta(spark: SparkSession, paths: list[str] | str, wanted: DataFrame | None = None) -> DataFrame:
    """file_ord, seq_ord (the header's byte), id (first word), description, seq (upper case), length: records as rows, for proteins, transcripts and contigs of up to what a row holds; fasta_tiles has longer ones. wanted: ids to keep."""
    records, pieces = fasta_pieces(spark, paths)
    if wanted is not None:
        records = records.join(wanted.select("id").distinct(), "id", "left_semi")
    text = pieces.groupBy("file_ord", "seq_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("off", "bases"))), lambda x: x["bases"]), "").alias("seq"))
    return records.join(text, ["file_ord", "seq_ord"], "left").select("file_ord", "seq_ord", "id", "description", F.coalesce("seq", F.lit("")).alias("seq"), "length")
