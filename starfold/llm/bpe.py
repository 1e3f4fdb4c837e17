"""Byte-level BPE encoding and decoding.

A word is merged in a contiguous array: its parts lie next to each other with
the rank of each adjacent pair beside them. Again and again the lowest rank is
found by a scan, the boundary between its two parts is deleted, and only the
ranks of the new part with its neighbours are looked up. Words are short, so
scans beat a heap; many words are kept as the rows of one array and go
through these steps together. A piece above ``LONG`` bytes (a run without any
break) does the same on its own with a heap of ranks instead of scans; the
merges are the same.

The Python part is small: split a text into words, look the new ones up, join
the ids. Spark partitions the texts; nothing is gathered.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

LONG = 64             # bytes of a piece above which a heap is used
MEMO = 300_000        # words remembered by a task before it starts anew
NONE = 1 << 30        # rank of a pair that doesn't merge
# How a text falls into words: fixed by the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file: itself where printable, else from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Encoder:
    """A vocabulary with its merges, ready to encode lists of words and to decode ids."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        vocab = spec["model"]["vocab"]
        self.bytes_of = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.byte_id = np.array([vocab[c] for c in letters], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made
        self.rank_of = dict(zip(key.tolist(), range(len(key))))
        self.words = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers; all words are ``LONG`` bytes at most."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w), []).append(i)
        for size, rows in by_size.items():
            for first in range(0, len(rows), 20_000):
                some = rows[first:first + 20_000]
                raw = np.frombuffer(b"".join([words[i] for i in some]), dtype=np.uint8).reshape(len(some), size)
                for i, ids in zip(some, self._merge_block(self.byte_id[raw])):
                    out[i] = ids
        return out

    def _merge_block(self, parts: np.ndarray) -> list[bytes]:
        rows, width = parts.shape
        length = np.full(rows, width)
        ranks = np.full((rows, width), NONE, dtype=np.int64)     # of the pair that starts at a part; none at the last
        if width > 1:
            ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        live, column = np.arange(rows), np.arange(width)
        while len(live):
            at = ranks[live].argmin(axis=1)
            low = ranks[live, at]
            live, at, low = live[low < NONE], at[low < NONE], low[low < NONE]
            if not len(live):
                break
            here = parts[live]
            here[np.arange(len(live)), at] = self.made[low]
            keep = np.minimum(column + (column > at[:, None]), width - 1)     # without the part after the merged one
            here = np.take_along_axis(here, keep, axis=1)
            beside = np.take_along_axis(ranks[live], keep, axis=1)
            length[live] -= 1
            row, last = np.arange(len(live)), length[live] - 1
            beside[column >= last[:, None]] = NONE
            right = np.flatnonzero(at < last)
            beside[right, at[right]] = self.rank(here[right, at[right]], here[right, at[right] + 1])
            left = row[at > 0]
            beside[left, at[left] - 1] = self.rank(here[left, at[left] - 1], here[left, at[left]])
            parts[live], ranks[live] = here, beside
        out = parts.astype("<u4")
        return [out[i, :n].tobytes() for i, n in enumerate(length.tolist())]

    def merge_long(self, word: bytes) -> bytes:
        """The same merges for one long piece, with a heap over (rank, place) and links to the neighbours."""
        part = self.byte_id[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.rank_of.get(part[i] << 32 | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if part[i] >= 0 else n
            if j >= n or self.rank_of.get(part[i] << 32 | part[j]) != r:
                continue                                         # one of the two has been merged meanwhile
            part[i], part[j], after[i] = int(self.made[r]), -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (q := self.rank_of.get(part[a] << 32 | part[b])) is not None:
                    heapq.heappush(heap, (q, a))
        return np.array([p for p in part if p >= 0], dtype="<u4").tobytes()

    def encode_batch(self, texts: list[str], memo: dict[str, bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers. ``memo`` holds words met before."""
        split = []
        for text in texts:
            pieces = self.cut(text) if self.cut and "<|" in text else [text]
            split.append([w for k, p in enumerate(pieces) for w in ([self.special[p]] if k % 2 else self.words(p))])
        if len(memo) > MEMO:
            memo.clear()
        new = list({w for ws in split for w in ws if w not in memo and isinstance(w, str)})
        raw = [w.encode("utf-8", "replace") for w in new]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG]
        for i, ids in zip(short, self.merge_many([raw[i] for i in short])):
            memo[new[i]] = ids
        for w, b in zip(new, raw):
            if len(b) > LONG:
                memo[w] = self.merge_long(b)
        for i in self.special.values():
            memo[i] = np.array([i], dtype="<u4").tobytes()
        return [b"".join([memo[w] for w in ws]) for ws in split]

    def decode(self, ids: bytes) -> str:
        return b"".join([self.bytes_of[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def _portions(texts: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", path: str | None = None, decoded: str | None = None) -> DataFrame:
    """All columns of ``docs`` and ``out``: the ids as little-endian 32-bit integers in a binary column.

    A null text is encoded as an empty one: no ids. Special tokens written out
    in a text become their id. Repeated rows are encoded each. ``decoded`` names a
    column for the text decoded from the ids, if wanted. A column of ``docs``
    with the name of an output is replaced. The vocabulary file is read once
    by each task, from ``path`` or the installed one.
    """
    path = path or default_vocabulary()
    kept = [c for c in docs.columns if c not in (out, decoded)]
    schema = docs.select(*kept).schema.add(out, "binary")
    if decoded:
        schema = schema.add(decoded, "string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, memo = Encoder(path), {}
        for frame in frames:
            texts = ["" if t is None else t for t in frame[text_col]]
            for a, b in _portions(texts):
                part = frame.iloc[a:b][kept].copy()
                ids = encoder.encode_batch(texts[a:b], memo)
                part[out] = ids
                if decoded:
                    part[decoded] = [encoder.decode(i) for i in ids]
                yield part

    return docs.mapInPandas(run, schema)


def decode(coded: DataFrame, ids_col: str = "ids", out: str = "text", path: str | None = None) -> DataFrame:
    """All columns of ``coded`` and ``out``, the text of the ids in ``ids_col``; null ids give an empty text.

    Bytes that don't form UTF-8 become U+FFFD. An id outside the vocabulary is an error.
    """
    path = path or default_vocabulary()
    kept = [c for c in coded.columns if c != out]
    schema = coded.select(*kept).schema.add(out, "string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for frame in frames:
            frame = frame[kept].copy()
            frame[out] = [encoder.decode(b"" if i is None else bytes(i)) for i in frame[ids_col]]
            yield frame

    return coded.mapInPandas(run, schema)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, all taken from the encoded ids."""
    both = encode(docs.select(id_col, text_col), text_col, "_ids", path, decoded="_decoded")
    return both.select(id_col, F.floor(F.length("_ids") / 4).cast("long").alias("n_tokens"), F.sha2("_ids", 256).alias("ids_sha256"),
                       F.sha2("_decoded", 256).alias("decoded_sha256"))
