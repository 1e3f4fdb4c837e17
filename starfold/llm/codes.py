"""Token ids in files of directly addressable codes.

Format: a folder of Parquet files with one row per shard: ``part`` and ``seq``
(their order is the order of documents), ``before`` (ids of the part before the
shard), ``n_docs``, ``n_tokens``, ``docs``
(ids of the shard's documents), ``known`` (0 where the id is null), ``lens`` (their numbers of tokens, 64-bit
little-endian) and ``codes``. Parquet is only the envelope that any store and
committer of Spark can take; ``codes`` holds the ids of all documents of the
shard one after the other:

- header: levels (1 byte), then for each level its number of bytes (8 bytes each);
- per level its chunk bytes: level 0 has the low 8 bits of every id, level 1 the next 8 bits of
  those ids that need them, and so on;
- per level but the last its continuation bitmap (a bit is set if the id goes on in the next level) and
  its rank directory: the set bits before each block of 512, as 32-bit integers.

Id i is read from byte i of level 0; if its bit is set, the number of set bits
before it (directory entry plus a count within one block) is its place in level
1. No block is decoded for that.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import checkpoint_dir
from .bpe import byte_letters
from .words import chunks

SHARD = 1 << 20        # ids in a shard, about; a longer document makes one of its own
BLOCK = 512            # bits for each entry of the rank directory
MEMO = 800_000         # words remembered by a task before it starts anew
END_ID = 1


def pack(ids: np.ndarray) -> bytes:
    """The codes of an array of ids from 0 to 2**32-1."""
    left, chunks, marks = ids.astype(np.uint32), [], []
    while True:
        chunks.append((left & np.uint32(255)).astype(np.uint8).tobytes())
        left = left >> np.uint32(8)
        more = left > 0
        if not more.any():
            break
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        per_block = np.bitwise_count(bits).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
        marks.append(bits.tobytes() + (np.cumsum(per_block) - per_block).astype("<u4").tobytes())
        left = left[more]
    head = bytes([len(chunks)]) + b"".join(len(c).to_bytes(8, "little") for c in chunks)
    return head + b"".join(chunks) + b"".join(marks)


class Codes:
    """Reads packed ids: any one by itself, or a run of them."""

    def __init__(self, data: bytes):
        levels = data[0]
        sizes = [int.from_bytes(data[1 + 8 * k:9 + 8 * k], "little") for k in range(levels)]
        at, self.chunks, self.bits, self.before = 1 + 8 * levels, [], [], []
        for size in sizes:
            self.chunks.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        for size in sizes[:-1]:
            blocks = -(-size // BLOCK)
            self.bits.append(np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at))
            at += blocks * BLOCK // 8
            self.before.append(np.frombuffer(data, "<u4", blocks, at))
            at += 4 * blocks

    def __len__(self) -> int:
        return len(self.chunks[0])

    def __getitem__(self, i: int) -> int:
        value = 0
        for level, chunk in enumerate(self.chunks):
            value |= int(chunk[i]) << 8 * level
            if level == len(self.bits) or not self.bits[level][i >> 3] >> (i & 7) & 1:
                break
            start = i // BLOCK * (BLOCK // 8)
            inside = int(np.bitwise_count(self.bits[level][start:i >> 3]).sum())
            inside += (int(self.bits[level][i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(self.before[level][i // BLOCK]) + inside
        return value

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids start..end-1."""
        out = self.chunks[0][start:end].astype(np.uint32)
        where = np.arange(end - start)
        for level in range(len(self.bits)):
            if start >= end:
                break
            bits = np.unpackbits(self.bits[level][start >> 3:(end + 7) >> 3], bitorder="little")[start & 7:]
            more = np.flatnonzero(bits[:end - start])
            if not len(more):
                break
            start = self._rank(level, start)
            end, where = start + len(more), where[more]
            out[where] |= self.chunks[level + 1][start:end].astype(np.uint32) << np.uint32(8 * (level + 1))
        return out

    def _rank(self, level: int, i: int) -> int:
        start = i // BLOCK * (BLOCK // 8)
        inside = int(np.bitwise_count(self.bits[level][start:i >> 3]).sum())
        inside += (int(self.bits[level][i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        return int(self.before[level][i // BLOCK]) + inside


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Ids of words by the tokenizers library, each word encoded once and remembered.

    This vocabulary drops white space, so the words of a text are encoded apart.
    Words of letters below U+0250 without combining marks need no
    normalisation but lower case, and fall into pieces by a simple pattern; the
    library's model then gets the pieces as they are. All other words go
    through the library's whole pipeline.
    """

    # How a word falls into pieces: fixed by the vocabulary. The blank is only between words here.
    PATTERN = r" |'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
    ODD = re.compile("[^\x20-\x7e\xa1-\u024f]|<\\||\u0130")

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.whole, self.plain):
            t.no_truncation()
            t.no_padding()
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary need more than two bytes")
        self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.pieces = regex.compile(self.PATTERN).findall
        # the last token of every piece, and no other, is one that ends a word
        self.last = np.zeros(1 << 16, dtype=bool)
        self.last[[i for t, i in self.whole.get_vocab().items() if t.endswith("</w>")]] = True
        self.as_letters = {b: c for b, c in enumerate(byte_letters()) if b != 32}
        self.memo: dict[bytes, bytes] = {}
        # ids stay below 2**16, so four set bytes in a row can only be the mark between words
        self.code: dict[str, bytes] = {" ": b"\xff\xff\xff\xff"}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        # lower case is right before composition only if nothing composes
        words = [(t if b"\xcc" in t or b"\xcd" in t else t.lower()).split() for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        if len(self.code) > MEMO:
            mark = self.code[" "]
            self.code.clear()
            self.code[" "] = mark
        known = self.memo.get
        new = set().union(*words).difference(self.memo)     # a set less a dictionary's keys would walk through all of these
        if new:
            self._learn(list(new))
        return [b"".join(map(known, ws)) for ws in words]

    def _learn(self, new: list[bytes]) -> None:
        text = b" ".join(new).decode()
        if self.ODD.search(text):
            odd = [w for w in new if self.ODD.search(w.decode())]
            for w, e in zip(odd, self.whole.encode_batch([w.decode() for w in odd], add_special_tokens=False)):
                self.memo[w] = np.array(e.ids, dtype="<u4").tobytes()
            new = list(set(new) - set(odd))
            text = b" ".join(new).decode()
        if not new:
            return
        pieces, code = self.pieces(text.lower()), self.code
        fresh = list(set(pieces).difference(code))   # many new words have pieces that others had before
        if fresh:
            some = " ".join(fresh).encode().decode("latin-1").translate(self.as_letters)
            ids = np.array(self.plain.encode_batch_fast([some], add_special_tokens=False)[0].ids, dtype="<u4")
            at = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            raw = ids.tobytes()
            code.update(zip(fresh, [raw[a:b] for a, b in zip([0, *at], at)]))
        self.memo.update(zip(new, b"".join(map(code.__getitem__, pieces)).split(code[" "])))


def _words(path: str) -> Words:
    """The words that this Python worker knows already: a worker serves many tasks and keeps them."""
    kept = sys.__dict__.setdefault("_starfold_words", {})
    if path not in kept:
        kept[path] = Words(path)
    return kept[path]


_SHARDS = "part int, seq long, before long, n_docs long, n_tokens long, docs binary, known binary, lens binary, codes binary"


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
          end_id: int | None = END_ID, partitions: int | None = None) -> None:
    """Encode the texts and write the ids in ascending order of the 64-bit integer ``id_col``.

    A null text is an empty one; every document gets ``end_id`` at its end, if
    given. Rows with the same id are ordered by text; null ids come first. Other columns are ignored. An empty table writes
    no shard. Documents are range-partitioned by id, so a hot source or many
    equal texts make no large partition; each partition writes its own shards.
    """
    path = path or default_vocabulary()
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    rows = rows.repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark runs the tasks side by side
        words = _words(path)
        part, seq, before, ids, coded, size = TaskContext.get().partitionId(), 0, 0, [], [], 0
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

        def shard() -> pa.RecordBatch:
            lens = np.array([len(c) // 4 for c in coded], dtype="<i8")
            row = (part, seq, before, len(ids), int(lens.sum()), np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
                   bytes(i is not None for i in ids), lens.tobytes(),
                   pack(np.frombuffer(b"".join(coded), dtype="<u4")))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [c.split()[0] for c in _SHARDS.split(", ")])

        for batch in batches:
            for a, b in chunks(batch.column(1), 1 << 20):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                for i, code in zip(batch.column(0).slice(a, b - a).to_pylist(), words.encode(texts)):
                    code += end
                    ids.append(i)
                    coded.append(code)
                    size += len(code) // 4
                    if size >= SHARD:
                        yield shard()
                        seq, before, ids, coded, size = seq + 1, before + size, [], [], 0
        if ids:
            yield shard()

    rows.mapInArrow(run, _SHARDS).write.mode("error").parquet(folder)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder with ``start``, the number of ids before each.

    Partition totals are summed in one task and sent to all: one row for each
    partition of the writer, whatever the number of shards and ids.
    """
    rows = spark.read.schema(_SHARDS).parquet(folder)
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


_READ = ("lens", "docs", "known", "codes", "start")


def _ids(docs: bytes, known: bytes) -> pa.Array:
    return pa.array(np.frombuffer(docs, "<i8"), mask=np.frombuffer(known, np.uint8) == 0)


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document in the files: id, ``start``, ``n_tokens`` and ``ids`` (array of long)."""
    def run(batches):
        for batch in batches:
            for lens, docs, known, codes, start in zip(*(batch.column(c).to_pylist() for c in _READ)):
                n, code = np.frombuffer(lens, "<i8"), Codes(codes)
                at = np.concatenate([[0], np.cumsum(n)])
                values = pa.LargeListArray.from_arrays(at, code.slice(0, len(code)).astype(np.int64)).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([_ids(docs, known), pa.array(start + at[:-1]), pa.array(n), values],
                                                 [id_col, "start", "n_tokens", "ids"])
    return shards(spark, folder).select(*_READ).mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids array<long>")


def digest(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document in the files: id, ``start``, ``n_tokens``, ``ids_crc32`` of its ids as 32-bit integers."""
    def run(batches):
        for batch in batches:
            for lens, docs, known, codes, start in zip(*(batch.column(c).to_pylist() for c in _READ)):
                n, code = np.frombuffer(lens, "<i8"), Codes(codes)
                at = np.concatenate([[0], np.cumsum(n)])
                ids = memoryview(code.slice(0, len(code)).astype("<u4").tobytes())
                crc = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([_ids(docs, known), pa.array(start + at[:-1]), pa.array(n),
                                                  pa.array(crc, pa.int64())], [id_col, "start", "n_tokens", "ids_crc32"])
    return shards(spark, folder).select(*_READ).mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def fresh_folder(spark: SparkSession) -> str:
    """A new place below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/codes-{uuid.uuid4().hex}"
