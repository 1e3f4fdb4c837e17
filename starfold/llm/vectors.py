"""Vector codes: parts of integer vectors replaced by the nearest entries of learned codebooks.

A vector is cut into equal parts, and each part position has a codebook of its
own. To find the nearest entries of many parts at once, a task sorts the
distinct parts it holds: in that order they are the leaves of a lexicographic
trie, whose inner nodes are common prefixes of components. A depth-first walk
carries at every node the squared distances to all entries over the components
so far, so parts with a common prefix share that work; a leaf takes the least.
For learning, a leaf adds itself to the sum of its entry, times the number of
vectors that have it.

Vectors never move: a round is a scan whose tasks give partial sums of a
codebook's size, and equal vectors meet in a task's trie only, so copies cost
nothing. Integers all the way: results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LEAVES = 2048                    # leaves of the trie that are walked at a time
MOST = float(1 << 19)            # components from here on would overflow the 64-bit sums


def usable(vector: Column, parts: int = PARTS) -> Column:
    """Not null, all components finite (and below ``MOST`` in size), length a positive multiple of ``parts``."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0) & fine, F.lit(False))


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * value) as 64-bit integers."""
    return np.floor(values.astype(np.float64) * scale).astype(np.int64)


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, index of each row's, number of each) of an integer matrix."""
    order = np.lexsort(parts.T[::-1])
    ranked = parts[order]
    first = np.ones(len(parts), dtype=bool)
    first[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    back = np.empty(len(parts), dtype=np.int64)
    back[order] = np.cumsum(first) - 1
    at = np.flatnonzero(first)
    return ranked[at], back, np.diff(np.append(at, len(parts)))


def nearest(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of each of the sorted distinct ``leaves``; ties go to the lower index.

    The trie isn't built: in sorted order a leaf shares the nodes above it with
    the leaf before it, up to the first component that differs. The walk goes
    through ``LEAVES`` leaves at a time and keeps the path to the last one, so
    that the next portion goes on from there.
    """
    m, width = leaves.shape
    index, distance = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    path: list[np.ndarray] = []                                   # distances at the nodes above the last leaf
    for start in range(0, m, LEAVES):
        block = leaves[start:start + LEAVES]
        new = np.ones(block.shape, dtype=bool)                    # whether a leaf begins a node at a depth
        before = block[:-1] if start == 0 else leaves[start - 1:start + len(block) - 1]
        new[len(block) - len(before):] = np.logical_or.accumulate(block[len(block) - len(before):] != before, axis=1)
        above, node = np.zeros((1, len(entries)), dtype=np.int64), np.zeros(len(block), dtype=np.int64)
        down = []
        for depth in range(width):
            fresh = np.flatnonzero(new[:, depth])
            sums = above[node[fresh]] + (block[fresh, depth, None] - entries[None, :, depth]) ** 2
            if not new[0, depth]:
                sums = np.concatenate([path[depth][None], sums])
            node = np.cumsum(new[:, depth]) - int(new[0, depth])
            above = sums
            down.append(sums[-1])
        path = down
        at = np.argmin(above, axis=1)[node]
        index[start:start + len(block)] = at
        distance[start:start + len(block)] = above[node, at]
    return index, distance


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """(vector, part, component) integers of a list column without nulls."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return whole(values).reshape(len(column), parts, -1)


def _sum_up(codebooks: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sum of the parts at each used entry, over a whole task."""
    parts, entries, width = codebooks.shape
    total, count = np.zeros((parts, entries, width), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
    for batch in batches:
        if batch.num_rows:
            vectors = _matrix(batch.column(0), parts)
            for p in range(parts):
                leaves, _, times = distinct_parts(vectors[:, p])
                at, _ = nearest(leaves, codebooks[p])
                np.add.at(total[p], at, leaves * times[:, None])
                np.add.at(count[p], at, times)
    used = np.flatnonzero(count.reshape(-1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count.reshape(-1)[used]),
                                      pa.array(list(total.reshape(-1, width)[used]), pa.list_(pa.int64()))], ["slot", "n", "s"])


def kept(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS) -> DataFrame:
    """Rows with a usable vector."""
    return vectors.where(usable(F.col(vec_col), parts))


def learn(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks as an array (part, entry, component); None if no vector is usable.

    They start as the parts of the vectors with the smallest ids (nulls last,
    equal ids by vector); with fewer vectors there are fewer entries. The
    length of the first vector is that of the codebooks; vectors of another
    length are no part of this. Each round, entries become the floor of the
    mean of the parts nearest to them; an unused one stays. The driver sees
    codebooks only.
    """
    rows = kept(vectors, id_col, vec_col, parts).select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    first = rows.orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    size = len(first[0].v)
    books = whole(np.array([r.v for r in first if len(r.v) == size])).reshape(-1, parts, size // parts).transpose(1, 0, 2).copy()
    vector = rows.where(F.size("v") == size).select("v")
    for _ in range(rounds):
        current, width = books.copy(), books.shape[2]
        partial = vector.mapInArrow(lambda it: _sum_up(current, it), "slot int, n long, s array<long>")
        sums = partial.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(k))).alias(f"s{k}") for k in range(width)])
        for r in sums.collect():                                  # at most parts * entries rows
            books[r.slot // books.shape[1], r.slot % books.shape[1]] = [r[f"s{k}"] // r.n for k in range(width)]
    return books


def encode(vectors: DataFrame, codebooks: np.ndarray | None, keep: list[str], id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``keep`` columns of the usable vectors, their ``code`` (two hex digits for each part) and ``error`` (squared distances, summed).

    Kept columns called code or error are replaced. Rows whose vector is null,
    holds null or non-finite components, or has another length than the
    codebooks are left out. No more than 256 entries.
    """
    keep = [c for c in keep if c not in ("code", "error")]
    schema = vectors.select(*keep).schema.add("code", "string").add("error", "long")
    if codebooks is None:
        return vectors.sparkSession.createDataFrame([], schema)
    parts, _, width = codebooks.shape
    rows = kept(vectors, id_col, vec_col, parts).where(F.size(vec_col) == parts * width).select(*keep, F.col(vec_col).cast("array<double>").alias("_vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = _matrix(batch.column(len(keep)), parts)
            codes, error = np.empty((len(vec), parts), dtype=np.uint8), np.zeros(len(vec), dtype=np.int64)
            for p in range(parts):
                leaves, back, _ = distinct_parts(vec[:, p])
                at, far = nearest(leaves, codebooks[p])
                codes[:, p] = at[back]
                error += far[back]
            text = codes.tobytes().hex()
            code = [text[k:k + 2 * parts] for k in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(code), pa.array(error)], [*keep, "code", "error"])

    return rows.mapInArrow(run, schema)


def decode(codes: list[str], codebooks: np.ndarray) -> np.ndarray:
    """The vectors (integers) that codes stand for."""
    at = np.array([list(bytes.fromhex(c)) for c in codes], dtype=np.int64).reshape(len(codes), codebooks.shape[0])
    return codebooks[np.arange(codebooks.shape[0])[None, :], at].reshape(len(codes), -1)


def codebook_text(codebooks: np.ndarray) -> str:
    """All components in decimal by part, entry and place, comma-joined."""
    return ",".join(map(str, codebooks.reshape(-1).tolist()))


def codebook_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(codebook_text(codebooks).encode()).hexdigest()


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over equal labels (nulls are one label).

    Sums are combined before the shuffle; the join leaves it to the engine to
    send a small table of sums to the rows or to split a hot label.
    """
    sums = coded.groupBy(label_col).agg(F.sum("error").alias("label_error")).withColumnRenamed(label_col, "_label")
    return coded.drop("label_error").join(sums, F.col(label_col).eqNullSafe(F.col("_label"))).drop("_label")
