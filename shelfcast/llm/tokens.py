"""Token ids as compressed binary blocks (operator 10).

Texts are encoded with a public byte-level BPE tokenizer, an end id is
appended, and the id array of each document is one zstandard frame compressed
with a dictionary shared by the whole data set, trained on a bounded,
hash-chosen sample of serialized id arrays. A short document is read by one
slice of its block, without touching its neighbours.

File format: a Parquet folder (so that any store Spark reaches can hold it and
Spark's committer keeps a retried task from leaving half a file). One row is
one block of consecutive documents in ascending doc_id order:

    part, block          range partition, and block in it; together ascending
    first                ids in the blocks of the same part before this one
    dict_sha256          hash of the dictionary the frames need
    doc_ids, n_tokens    per document of the block
    offsets              byte offset of each frame in payload, and the end
    payload              the frames, end to end

Beside it lies ``<path>_dictionary`` with the dictionary, its hash and the
width of an id in bytes.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import hash_fraction, map_rows, materialize, scratch_path

END_ID = 2
DICT_BYTES = 64 << 10
SAMPLE_DOCS = 1000           # documents whose ids train the dictionary, about
SAMPLE_BYTES = 32 << 10      # of each, what the trainer sees
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 4096
PART_BYTES = 128 << 20
LEVEL = 1
CACHE_WORDS = 1_000_000         # words that an encoder remembers
CACHE_PIECES = 200_000        # pieces of what is no plain word
CACHE_MISSES = 4_000_000      # lookups that a full cache may fail before it starts anew

# The byte-level BPE split pattern, written out for code points
# up to U+024F (letters, numbers and white space of Unicode in that range).
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \x85\xa0"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
                    rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
BEYOND = re.compile("[^\x00-ɏ]")
# Where cutting a text before every blank would cut a run of white space that is one piece.
RUNS = re.compile(rf"[{SPACES}] (?:[{SPACES}]|\Z)")
STOPS = frozenset(".,;:!?")


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte that byte-level vocabularies are written in."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Cache(dict):
    """Remembers what ``make`` gives for the keys worth it, at most ``size``.

    The first ones stay until ``CACHE_MISSES`` lookups of others have failed.
    """

    def __init__(self, make, size: int, worth):
        super().__init__()
        self.make, self.size, self.worth, self.misses = make, size, worth, 0

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if len(self) < self.size:
            if self.worth(key) and len(key) <= 32:
                self[key] = ids
        else:
            self.misses += 1
            if self.misses >= CACHE_MISSES:
                self.clear()
                self.misses = 0
        return ids


class Encoder:
    """Ids of a text as little-endian integers of ``width`` bytes.

    The byte-level split makes pieces independent, so a piece is encoded once
    by the tokenizer's model and remembered. A blank followed by something
    else always begins a piece, so a text is first cut before its blanks and
    the words, blank included, are remembered as well. Texts beyond Latin
    letters, texts that hold an added token's string, and tokenizers of
    another make are encoded whole by the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.by_piece = (split.get("type") == "ByteLevel" and split.get("use_regex", True)
                         and not split.get("add_prefix_space") and not spec.get("normalizer")
                         and spec["model"].get("type") == "BPE" and not spec["model"].get("ignore_merges"))
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.id_bytes = [i.to_bytes(self.width, "little") for i in range(size)]
        self.alphabet = byte_alphabet()
        self.pieces = Cache(self._piece, CACHE_PIECES, bool)
        self.words = Cache(self._word, CACHE_WORDS, bool)       # keyed without the blank before them

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            spelled = piece.replace(" ", self.alphabet[32])
        else:
            spelled = piece.encode("utf-8").decode("latin-1").translate(self.alphabet)
        id_bytes = self.id_bytes
        return b"".join([id_bytes[t.id] for t in self.model.tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        """Ids of a blank and ``word``: letters are one piece, with a stop they are two."""
        if word.isalpha():
            return self._piece(" " + word)
        if word[-1:] in STOPS and word[:-1].isalpha():
            return self.words[word[:-1]] + self.pieces[word[-1]]
        return self._split(" " + word)

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))

    def _beyond(self, text: str) -> bool:
        if text.isascii():
            return False
        try:
            text.encode("latin-1")              # much faster than the search
            return False
        except UnicodeEncodeError:
            return BEYOND.search(text) is not None

    def ids(self, text: str) -> bytes:
        if not self.by_piece or any(t in text for t in self.added) or self._beyond(text):
            return b"".join([self.id_bytes[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])
        if RUNS.search(text):
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))
        first, *words = text.split(" ")
        return self._split(first) + b"".join(map(self.words.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def deserialize(data: bytes, width: int) -> bytes:
    """The 32-bit form of serialized ids."""
    return data if width == 4 else np.frombuffer(data, dtype="<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, tokenizer_path: str, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A zstandard dictionary over about ``sample_docs`` hash-chosen documents; b'' if they are too few."""
    share = sample_docs / max(docs.count(), 1)
    sample = docs.filter(hash_fraction("doc_id", F.xxhash64("text"), seed=10) < share).select("text")

    def encode(rows):
        enc = encoder(tokenizer_path)
        for (text,) in rows:
            yield (enc.ids((text or b"").decode("utf-8"))[:SAMPLE_BYTES],)

    got = map_rows(sample, T.StructType([T.StructField("ids", T.BinaryType())]), encode).collect()
    samples = sorted(bytes(r.ids) for r in got if r.ids)
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:               # too little to learn from
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode ``docs (doc_id, text)`` and write them to ``path`` in ascending doc_id order.

    A null text is empty and has the end id alone. Null doc_ids come first;
    rows that repeat a doc_id stand side by side. Extra columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, tokenizer_path)
    digest = hashlib.sha256(dictionary).hexdigest()

    def compress(rows):
        enc = encoder(tokenizer_path)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        for doc_id, text in rows:
            ids = enc.ids((text or b"").decode("utf-8")) + enc.id_bytes[end_id]
            yield doc_id, len(ids) // enc.width, packer.compress(ids)

    frames = materialize(map_rows(docs, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("frame", T.BinaryType())]), compress), "frames")
    n_bytes = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / PART_BYTES))
    ordered = frames.repartitionByRange(n_parts, "doc_id").sortWithinPartitions("doc_id", "n_tokens", "frame")
    ordered.mapInArrow(_blocks(digest), BLOCK_SCHEMA).write.parquet(path)
    width = encoder(tokenizer_path).width
    spark.createDataFrame([(digest, bytearray(dictionary), width)], "dict_sha256 string, dictionary binary, width int") \
        .coalesce(1).write.parquet(f"{path}_dictionary")


BLOCK_SCHEMA = ("part int, block int, first bigint, dict_sha256 string, doc_ids array<bigint>, "
                "n_tokens array<bigint>, offsets array<bigint>, payload binary")


def _blocks(digest: str):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()),
                        ("dict_sha256", pa.string()), ("doc_ids", pa.list_(pa.int64())),
                        ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                        ("payload", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, held = [], [], [], 0

        def row():
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            values = [part, block, first, digest, ids, counts, offsets, b"".join(frames)]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema)],
                                              schema=schema)

        for batch in batches:
            for doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(doc_id)
                counts.append(n)
                frames.append(frame)
                held += len(frame)
                if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield row()
                    block, first = block + 1, first + sum(counts)
                    ids, counts, frames, held = [], [], [], 0
        if ids:
            yield row()

    return pack


def _opened(spark: SparkSession, path: str) -> tuple[bytes, str, int]:
    d = spark.read.parquet(f"{path}_dictionary").first()
    data = bytes(d["dictionary"])
    if hashlib.sha256(data).hexdigest() != d["dict_sha256"]:
        raise ValueError(f"{path}: the dictionary does not have the hash it was written with")
    return data, d["dict_sha256"], d["width"]


def _decoded(batches: Iterator[pa.RecordBatch], dictionary: bytes, digest: str, width: int) -> Iterator[list[tuple]]:
    """Per block: (part, ids before in the part, doc_id, n_tokens, 32-bit ids) of its documents."""
    unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    for batch in batches:
        for k in range(batch.num_rows):
            part, _, first, sha, ids, counts, offsets, payload = (c[k].as_py() for c in batch.columns)
            if sha != digest:
                raise ValueError(f"block written with dictionary {sha}, read with {digest}")
            texts = [deserialize(unpacker.decompress(payload[a:b]), width) for a, b in zip(offsets, offsets[1:])]
            sizes = [len(t) // 4 for t in texts]
            if sizes != counts:
                raise ValueError(f"part {part}: a frame does not hold the ids its index says")
            before = (first + np.cumsum(sizes) - sizes).tolist()
            yield [(part, b, d, n, t) for b, d, n, t in zip(before, ids, sizes, texts)]


def _map_documents(spark: SparkSession, path: str, column: str, kind: pa.DataType, value) -> DataFrame:
    """(part, before, doc_id, n_tokens, ``column``) per document, ``value`` of its ids."""
    opened = _opened(spark, path)
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        (column, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _decoded(batches, *opened):
            made = [(*r[:4], value(r[4])) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*made), schema)], schema=schema)

    sql = f"part int, before bigint, doc_id bigint, n_tokens bigint, {column} {'binary' if kind == pa.binary() else 'bigint'}"
    return spark.read.schema(BLOCK_SCHEMA).parquet(path).mapInArrow(run, sql)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(part, before, doc_id, n_tokens, ids) of every document.

    ``ids`` are little-endian unsigned 32-bit integers; ``before`` counts the
    ids of the documents before it in its part.
    """
    return _map_documents(spark, path, "ids", pa.binary(), lambda ids: ids)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of every document with this doc_id, by slicing its frames out of their blocks."""
    dictionary, _, width = _opened(spark, path)
    unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    at = F.expr(f"filter(sequence(0, size(doc_ids) - 1), i -> doc_ids[i] = {int(doc_id)})")
    found = (spark.read.schema(BLOCK_SCHEMA).parquet(path).filter(F.array_contains("doc_ids", F.lit(int(doc_id)).cast("bigint")))
             .select("payload", "offsets", F.explode(at).alias("i"))
             .select(F.expr("substring(payload, int(offsets[i]) + 1, int(offsets[i + 1] - offsets[i]))").alias("frame")))
    return [np.frombuffer(deserialize(unpacker.decompress(bytes(r.frame)), width), dtype="<u4").tolist()
            for r in found.collect()]


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    rows = _map_documents(spark, path, "ids_crc32", pa.int64(), zlib.crc32)
    totals = (spark.read.schema(BLOCK_SCHEMA).parquet(path).groupBy("part")
              .agg(F.sum(F.expr("aggregate(n_tokens, 0L, (s, x) -> s + x)")).alias("n")))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row a part
    starts = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    return rows.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("before")).cast("bigint").alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` to the shared folder and return `token_digest` of the files."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path)
    return token_digest(docs.sparkSession, path)
