"""Words, shingles and character windows of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21  # bytes of text handled at a time; a longer text makes a chunk of its own
SMALL = 1 << 19  # the same where every character gets several 64-bit numbers
_ODD = np.uint64(0x9E3779B97F4A7C15)


def chunks(column: pa.ChunkedArray | pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """(first row, end row) of runs of texts with about ``limit`` bytes; whole texts always."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    block = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < len(sizes):
        end = max(start + 1, int(np.searchsorted(block, block[start] + limit, side="right")) - 1)
        yield start, end
        start = end


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finishing step of splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    b, done = np.uint64(base), 1
    step = np.array([b], dtype=np.uint64)
    with np.errstate(over="ignore"):
        while done < n:
            take = min(done, n - done)
            out[done:done + take] = out[:take] * step[0]
            step = step * step
            done *= 2
    return out[:n]


def word_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes other than blank and \\t..\\r; a run stops at a text's end."""
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = ends[(ends > 0) & (ends < len(data))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each span of bytes, from two running sums that are cut at the span.

    Spans are handled in runs of about ``block`` bytes, so that the working
    arrays stay small however long a text is.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + block, side="right")))
        base_at, end_at = starts[first], ends[last - 1]
        out[first:last] = _hash_block(data[base_at:end_at], starts[first:last] - base_at, ends[first:last] - base_at)
        first = last
    return out


def _hash_block(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        spread = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)[data]
        for base in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
            run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread * powers(len(data), base), dtype=np.uint64)])
            back = powers(len(data), pow(base, -1, 1 << 64))
            out = mix(out * _ODD + (run[ends] - run[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return out


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its len+1 offsets; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]] if len(at) else raw[:0], at - (at[0] if len(at) else 0)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``width``-word runs, A-Z lower-cased.

    A text with fewer words gives one hash of its whole word sequence; a null
    text or one without words gives none.
    """
    data, at = byte_column(column)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    starts, ends = word_spans(data, at)
    h = word_hashes(data, starts, ends)
    bounds = np.searchsorted(starts, at)
    with np.errstate(over="ignore"):
        run = np.zeros(max(len(h) - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            run = mix(run * _ODD + h[k:k + len(run)])
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                s = np.sort(run[a:b - width + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif b > a:
                v = np.uint64(b - a)
                for x in h[a:b]:
                    v = mix(np.array([v * _ODD + x]))[0]
                out.append(np.array([v], dtype=np.uint64))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


_LETTER: list[np.ndarray] = []


def letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(1 << 16)]))
    out = _LETTER[0][np.minimum(points, (1 << 16) - 1)]
    high = np.flatnonzero(points >= 1 << 16)
    if len(high):
        u, inv = np.unique(points[high], return_inverse=True)
        out[high] = np.array([chr(c).isalpha() for c in u.tolist()])[inv]
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one separator 0 before each and one at the end; position of each text's separator."""
    joined = "\0" + "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    return points, at


def windows(points: np.ndarray, is_letter: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every run of n code points inside a word; its first and last may be the word's edge."""
    if len(points) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    symbol = np.where(is_letter, points, np.uint32(0)).astype(np.uint64)
    inner = is_letter[1:len(points) - n + 2].copy()
    for k in range(2, n - 1):
        inner &= is_letter[k:len(points) - n + 1 + k]
    at = np.flatnonzero(inner)
    h = np.full(len(at), n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ symbol[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return at, h


def add_columns(docs, text_col: str, keep: list[str], added: list[tuple[str, str]], make):
    """``keep`` columns of ``docs`` and the columns ``added`` as (name, type).

    ``make()`` runs once in each task and gives a function from a list of texts
    to one list or array for each added column. A null text comes as "". Kept
    columns with the name of an added one are left out.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    keep = [c for c in keep if c not in dict(added)]
    schema = docs.select(*keep).schema
    for name, kind in added:
        schema = schema.add(name, DataType.fromDDL(kind))
    inner = "_text"
    while inner in keep:
        inner += "_"
    src = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(inner))
    kinds = {name: to_arrow_type(schema[name].dataType) for name, _ in added}

    def run(batches):
        fn = make()
        for batch in batches:
            texts = batch.column(len(keep))
            for a, b in chunks(texts, SMALL):
                values = fn(texts.slice(a, b - a).to_pylist())
                arrays = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(v, kinds[n]) for v, (n, _) in zip(values, added))],
                                                 [*keep, *(name for name, _ in added)])

    return src.mapInArrow(run, schema)
