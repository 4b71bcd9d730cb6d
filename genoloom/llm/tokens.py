"""BPE encoding by a table of distinct words, and decoding through the vocabulary.

Texts are split at blanks ([\\x20\\x09-\\x0D]+), which no token of the vocabulary crosses, so a text's ids are its words' ids one
after the other. The words of all texts are counted; each distinct word is encoded once and stands with its count in a table. Its
ids come back to their places in one of two ways: the most frequent words, as many as TABLE_BYTES hold, are broadcast and looked up
where the text is read; every other word goes with its text's key and its position to the table's shuffle, and the ids
found there meet the text, compressed for the way, by its key. Both ways are exact; the bound only says which is taken. In
the table 64 bits of a hash stand for a word. A word of the second way is rarer than every word of the first, so no key of its join is a hot one.

Decoding takes each id's piece from the vocabulary, whose size the tokenizer's file bounds, and joins the pieces by a blank, as
the library does for a tokenizer without a decoder.

A null or empty text, or one of blanks only, has no ids and decodes to an empty text. Special tokens in a text are taken as such, as
the library does. Repeated rows and null doc_ids stay, each with its ids; texts that are equal are looked up once. Texts of any
length are read whole. Other columns are ignored. An empty table gives an empty result. A tokenizer whose special tokens
hold blanks or take blanks beside them, or which has a decoder, is refused.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffer_of, cut, group_starts, release, table, tidy, whole_groups, words_of

#: What the broadcast words may take in a worker, counted as WORD_BYTES and the bytes of their ids.
TABLE_BYTES = 16 << 20
WORD_BYTES = 16
BLANKS = "[\\x20\\x09-\\x0D]+"
#: Steps of a doubling of the count, by which the frequent words are told apart.
STEPS = 8


def read_tokenizer(path: str) -> str:
    """The tokenizer's definition, read in the driver, so that executors need no file of that name."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    made = json.loads(text)
    if made.get("decoder") or any(t["lstrip"] or t["rstrip"] or t["single_word"] or not t["content"].split() or t["content"].split() != [t["content"]] for t in made["added_tokens"]):
        raise ValueError("words of this tokenizer cannot be encoded one by one")
    return text


def _tokenizer(made: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(made)
    own.no_truncation()
    own.no_padding()
    return own


def _width(own) -> str:
    """How an id is written: two bytes where the vocabulary allows it."""
    return "<u2" if own.get_vocab_size() <= 1 << 16 else "<i4"


def _encode(made: str):
    def encode(it):
        own = _tokenizer(made)
        kind = _width(own)
        for batch in it:
            got = own.encode_batch_fast(batch.column("word").to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array([np.asarray(e.ids, kind).tobytes() for e in got], pa.binary())], names=["word", "n", "code"])

    return encode


def word_table(docs: DataFrame, made: str) -> DataFrame:
    """word, n, code (the bytes of its ids), level: every distinct word of the texts once; level rises with n."""
    words = docs.select(F.explode(F.split("text", BLANKS)).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return cut(words.mapInArrow(_encode(made), "word string, n bigint, code binary").withColumn("level", F.floor(F.log2("n") * STEPS).cast("int")), "words")


def _frequent(words: DataFrame, most: int, kind: str):
    """The lowest level of the words that are broadcast together, and in a broadcast these words: their hashes in order, where the ids of each end, and the ids."""
    cost = F.octet_length("code") + WORD_BYTES
    held, least = 0, 1 << 30
    for r in sorted(words.groupBy("level").agg(F.sum(cost).alias("bytes")).collect(), reverse=True):
        held += r["bytes"]
        if held > most:
            break
        least = r["level"]
    few = words.filter(F.col("level") >= least).select(F.col("word").cast("binary").alias("word"), "code").toArrow()
    hashes = words_of(*buffer_of(few.column("word").to_pylist()), False)[0]
    order = np.argsort(hashes)
    codes = [few.column("code")[i].as_py() for i in order.tolist()]
    flat = np.frombuffer(b"".join(codes), kind)
    ends = np.concatenate(([0], np.cumsum([len(c) // flat.itemsize for c in codes]))).astype(np.int64)
    return least, words.sparkSession.sparkContext.broadcast((hashes[order], ends, flat))


def _looked_up(table_, texts: list[bytes]):
    """Of a block of texts: its bytes, where words begin and end, the first word of each text, and the place of each word in the table, -1 where it has none."""
    buf, starts = buffer_of(texts)
    h, begin, end, first = words_of(buf, starts, False)
    if not len(table_[0]) or not len(h):
        return buf, begin, end, first, np.full(len(h), -1)
    at = np.minimum(np.searchsorted(table_[0], h), len(table_[0]) - 1)
    return buf, begin, end, first, np.where(table_[0][at] == h, at, -1)


def _spread(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of runs that start there and have that size, one run after the other."""
    return np.repeat(starts - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _texts(it, most: int = 1 << 20):
    """Runs of rows with about `most` bytes of text (binary; null: empty)."""
    for batch in it:
        size = np.cumsum([len(t) for t in batch.column("text").fill_null(b"").to_pylist()] or [0])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            part = batch.slice(at, to - at)
            yield part, part.column("text").fill_null(b"").to_pylist()
            at = to
    tidy()


def _rest(frequent):
    """row, pos and word of every word that is not frequent."""

    def rest(it):
        for part, texts in _texts(it):
            buf, begin, end, first, at = _looked_up(frequent.value, texts)
            own = np.flatnonzero(at < 0)
            text = np.searchsorted(first, own, "right") - 1
            data = buf.tobytes()
            word = [data[a:b] for a, b in zip(begin[own].tolist(), end[own].tolist(), strict=True)]
            row = part.column("row").to_numpy()[text]
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array((own - first[text]).astype(np.int32)), pa.array(word, pa.binary()).cast(pa.string())], names=["row", "pos", "word"])

    return rest


def _gathered(it):
    """row and rest: number, lengths and codes of all its words that are not frequent, in order, compressed; the input is sorted by row and pos, and equal texts repeat it."""
    import zstandard

    small = zstandard.ZstdCompressor(level=1)
    for t in whole_groups(it, ["row"], 50_000):
        row, pos = t.column("row").to_numpy(), t.column("pos").to_numpy()
        once = np.ones(len(row), bool)
        once[1:] = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1])
        row, code = row[once], np.array(t.column("code").to_pylist(), object)[once]
        size = np.array([len(c) for c in code], "<i4")
        at = group_starts([row])
        rest = [small.compress(np.int32(b - a).tobytes() + size[a:b].tobytes() + b"".join(code[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(row[at[:-1]]), pa.array(rest, pa.binary())], names=["row", "rest"])


def _pack(it):
    """doc_id, row and text, compressed."""
    import zstandard

    small = zstandard.ZstdCompressor(level=1)
    for part, texts in _texts(it):
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array([small.compress(t) for t in texts], pa.binary())], names=["doc_id", "row", "text"])


def _filled(frequent, kind: str, packed: bool):
    """doc_id and ids of texts; what is not frequent stands beside a packed text."""

    def filled(it):
        import zstandard

        whole = zstandard.ZstdDecompressor()
        _, ends, flat = frequent.value
        for part, texts in _texts(it):
            if packed:
                texts = [whole.decompress(t) for t in texts]
            _, _, _, first, at = _looked_up(frequent.value, texts)
            known = at >= 0
            size = np.zeros(len(at), np.int64)
            size[known] = ends[at[known] + 1] - ends[at[known]]
            sizes, codes = [], []
            for own in part.column("rest").to_pylist() if packed else []:
                if own is not None:
                    own = whole.decompress(own)
                    n = int(np.frombuffer(own, "<i4", 1)[0])
                    sizes.append(np.frombuffer(own, "<i4", n, 4) // flat.itemsize)
                    codes.append(own[4 + 4 * n :])
            size[~known] = np.concatenate([np.zeros(0, np.int64), *sizes])
            to = np.concatenate(([0], np.cumsum(size)))
            ids = np.empty(int(to[-1]), kind)
            ids[_spread(to[:-1][known], size[known])] = flat[_spread(ends[at[known]], size[known])]
            ids[_spread(to[:-1][~known], size[~known])] = np.frombuffer(b"".join(codes), kind)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(to[first].astype(np.int32)), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return filled


def encode(docs: DataFrame, made: str, table_bytes: int | None = None) -> DataFrame:
    """doc_id, ids (array<int>) of every row of docs (doc_id, text), by the tokenizer whose definition is given."""
    docs = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    kind, words = _width(_tokenizer(made)), word_table(docs, made)
    release(docs.sparkSession)
    least, frequent = _frequent(words, TABLE_BYTES if table_bytes is None else table_bytes, kind)
    # A text without words has no partner: any key will do, as long as it is not one for all of them.
    row = F.when(F.octet_length("text") > 0, F.xxhash64("text", F.octet_length("text"))).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    keyed = docs.select("doc_id", row.alias("row"), F.col("text").cast("binary").alias("text"))
    other = words.filter(F.col("level") < least).select("word", "code")
    if other.isEmpty():
        return keyed.mapInArrow(_filled(frequent, kind, False), "doc_id bigint, ids array<int>")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = keyed.select("row", "text").mapInArrow(_rest(frequent), "row bigint, pos int, word string").join(other, "word").select("row", "pos", "code")
    found = cut(found.repartition(parts, "row").sortWithinPartitions("row", "pos").mapInArrow(_gathered, "row bigint, rest binary"), "rest")
    release(docs.sparkSession)
    packed = keyed.mapInArrow(_pack, "doc_id bigint, row bigint, text binary")
    return packed.join(found, "row", "left").select("doc_id", "text", "rest").mapInArrow(_filled(frequent, kind, True), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, made: str) -> DataFrame:
    """encoded (doc_id, ids) with the text that the ids decode to, special tokens too."""
    own = _tokenizer(made)
    vocabulary = [own.id_to_token(i) for i in range(own.get_vocab_size())]

    def texts(it):
        import pyarrow.compute as pc

        pieces = pa.array(vocabulary, pa.string())
        for batch in it:
            at = 0
            size = np.cumsum(pc.fill_null(batch.column("ids").value_lengths(), 0).to_numpy(zero_copy_only=False))
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + (1 << 19), "right")))
                part = batch.slice(at, to - at)
                ids = part.column("ids")
                ends = np.concatenate(([0], np.cumsum(pc.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False)))).astype(np.int32)
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pieces.take(ids.flatten())), " ")
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, text], names=["doc_id", "ids", "decoded"])
                at = to

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id bigint, ids array<int>, decoded string")


def op12_word_table_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    made = read_tokenizer(path)
    both = decode(encode(table(spark, sf_dir, "documents"), made), made)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
