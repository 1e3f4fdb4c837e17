"""Fill-in-the-middle texts, assembled by a secondary sort.

A text is cut into units (a word with the blanks before it; blanks at the end
are a unit of their own). Two hashed places among the units split it into
prefix, middle and suffix, which a model is to see in the order prefix,
suffix, middle (psm) or suffix, prefix, middle (spm), each after its sentinel.

No task holds an output text. The scan emits pieces of at most ``CHUNK`` units,
keyed by document and place in the output; ``repartitionAndSortWithinPartitions``
brings them together in that order, and whoever reads them goes through a
document piece by piece: into a file, or into a digest. To restore the texts,
the output is read in the same way, its sentinels say which section a piece
belongs to, and the pieces are sorted again by section. They are where they
belong already, so the second sort moves nothing between tasks.

Plain texts are their own output; they go as a header without pieces.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession, functions as F

from .words import word_spans

CHUNK = 1024            # units in a piece
TASK_BYTES = 64 << 20   # bytes of text that a task of the sort is meant for
_HEADER = -1            # place of a document's header: before all its pieces
_SECTION = 1 << 40      # places are section * _SECTION + number when a text is restored


@dataclass(frozen=True)
class Plan:
    """How texts are dealt: hash seed, share of texts that are cut, share of spm among them, sentinels."""

    seed: int = 42
    cut_percent: int = 50
    spm_percent: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def numbers(self, doc_id) -> list[int]:
        h = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return [int(h[8 * k:8 * k + 8], 16) for k in range(4)]

    def order(self, form: str) -> tuple[tuple[int, bytes], ...]:
        """(section, sentinel) in output order; sections count prefix, middle, suffix from 0."""
        p, m, s = ((k, x.encode()) for k, x in enumerate((self.prefix, self.middle, self.suffix)))
        return (p, s, m) if form == "psm" else (s, p, m)


def unit_ends(data: bytes) -> np.ndarray:
    """End of every unit, in bytes of UTF-8."""
    _, ends = word_spans(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    last = int(ends[-1]) if len(ends) else 0
    return np.append(ends, len(data)) if last < len(data) else ends


def _chars(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))


def _home(key: tuple[str, int]) -> int:
    """Where a document's pieces meet."""
    return zlib.crc32(key[0].encode())


def _emit(plan: Plan, part: int, rows: Iterator) -> Iterator:
    """Header and pieces of each row's output.

    A row's key is made of id, content, partition and a number among equal rows
    of the partition: rows that only differ in the last are interchangeable, so
    a task that runs again emits the same pieces.
    """
    copies: Counter = Counter()
    marks = [x.encode() for x in (plan.prefix, plan.suffix, plan.middle)]
    for doc_id, text in rows:
        data = text.encode("utf-8", "surrogatepass")
        whole = hashlib.sha256(data).hexdigest()
        name = f"{doc_id}/{whole[:32]}/{part}"
        key = f"{name}/{copies[name]}"
        copies[name] += 1
        ends = unit_ends(data)
        n = len(ends)
        h1, h2, h3, h4 = plan.numbers(doc_id)
        if not data or h3 % 100 >= plan.cut_percent or any(x in data for x in marks):
            yield (key, _HEADER), (doc_id, n, "plain", None, None, data)
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        at = np.concatenate([[0], ends])
        form = "spm" if h4 % 100 < plan.spm_percent else "psm"
        sections = ((0, a), (a, b), (b, n))
        yield (key, _HEADER), (doc_id, n, form, _chars(data[:at[a]]), _chars(data[at[a]:at[b]]), None)
        place = 0
        for section, mark in plan.order(form):
            first, last = sections[section]
            for u in range(first, max(last, first + 1), CHUNK):
                piece = data[at[u]:at[min(u + CHUNK, last)]]
                yield (key, place), mark + piece if u == first else piece
                place += 1


def arranged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> RDD:
    """((key, place), value) sorted by key and place: a header (place -1), then the output in pieces.

    The header is (id, units, form, characters of prefix and middle, text of a
    plain document). A null text is an empty one; a null id hashes as an empty
    id. Every row is a document of its own, also with an id or content that
    another row has. Other columns are ignored. One text's pieces are read by
    one task, as a digest or a file needs them, but never held there at once.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # no adaptive plan will mend the number of partitions of an RDD, so it follows the texts
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    pieces = rows.rdd.mapPartitionsWithIndex(lambda part, it: _emit(plan, part, it))
    return pieces.repartitionAndSortWithinPartitions(n, _home)


class _Sections:
    """Splits an output, given piece by piece, at its sentinels into (section, bytes)."""

    def __init__(self, plan: Plan, form: str):
        self.todo = list(plan.order(form))
        self.section, self.rest = None, b""

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        data = self.rest + piece
        while self.todo and (at := data.find(self.todo[0][1])) >= 0:
            if at:
                yield self.section, data[:at]
            self.section, mark = self.todo.pop(0)
            data = data[at + len(mark):]
        keep = len(self.todo[0][1]) - 1 if self.todo else 0       # a sentinel may go on in the next piece
        done = max(len(data) - keep, 0)
        if done:
            yield self.section, data[:done]
        self.rest = data[done:]

    def end(self) -> Iterator[tuple[int, bytes]]:
        if self.rest:
            yield self.section, self.rest


def _reorder(plan: Plan, pieces: Iterator) -> Iterator:
    """From pieces in output order, headers with the output's digest and pieces keyed by section and number."""
    key = header = digest = split = None
    number = 0

    def close():
        for section, data in split.end():
            yield (key, section * _SECTION + number), data
        yield (key, _HEADER), (*header[:5], digest.hexdigest(), None)

    for (k, place), value in pieces:
        if place == _HEADER:
            if key is not None and split is not None:
                yield from close()
            key, header, number = k, value, 0
            if value[2] == "plain":
                split = None
                yield (k, _HEADER), (*value[:5], hashlib.sha256(value[5]).hexdigest(), value[5])
            else:
                split, digest = _Sections(plan, value[2]), hashlib.sha256()
            continue
        digest.update(value)
        for section, data in split.feed(value):
            yield (key, section * _SECTION + number), data
            number += 1
    if key is not None and split is not None:
        yield from close()


def restored(outputs: RDD, plan: Plan = Plan()) -> RDD:
    """((key, place), value) sorted by key and place: header with the output's digest, then the text in pieces, from ``arranged``.

    Only the form and the output are read. A plain text is in its header.
    """
    again = outputs.mapPartitions(lambda it: _reorder(plan, it), preservesPartitioning=True)
    return again.repartitionAndSortWithinPartitions(outputs.getNumPartitions(), _home)


def _gathered(pieces: Iterator, start, step, finish) -> Iterator:
    """One result for each document of sorted pieces."""
    header = state = None
    for (_, place), value in pieces:
        if place == _HEADER:
            if header is not None:
                yield finish(header, state)
            header, state = value, start()
        else:
            state = step(state, value)
    if header is not None:
        yield finish(header, state)


def _update(digest, piece: bytes):
    digest.update(piece)
    return digest


def _id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def _frame(spark: SparkSession, rows: RDD, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """One row per document: id, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output_sha256``, ``restored_sha256``.

    Both digests are taken from streams of pieces: the output, and the text
    that is restored from output and form. Characters are null for plain texts.
    """
    def finish(header, state):
        *info, output, text = header
        if text is not None:
            state.update(text)
        return (*info, output, state.hexdigest())

    rows = restored(arranged(docs, id_col, text_col, plan), plan).mapPartitions(lambda it: _gathered(it, hashlib.sha256, _update, finish))
    return _frame(docs.sparkSession, rows, f"`{id_col}` {_id_type(docs, id_col)}, n long, form string, prefix_chars long, middle_chars long, "
                                           "output_sha256 string, restored_sha256 string")


def outputs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """One row per document: id, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text."""
    def finish(header, state):
        *info, text = header
        return (*info, (b"".join(state) if text is None else text).decode("utf-8", "surrogatepass"))

    rows = arranged(docs, id_col, text_col, plan).mapPartitions(lambda it: _gathered(it, list, _append, finish))
    return _frame(docs.sparkSession, rows, f"`{id_col}` {_id_type(docs, id_col)}, n long, form string, prefix_chars long, middle_chars long, output string")


def _append(pieces: list[bytes], piece: bytes) -> list[bytes]:
    pieces.append(piece)
    return pieces


def restore(output: str, form: str, plan: Plan = Plan()) -> str:
    """The text of one output."""
    if form == "plain":
        return output
    split = _Sections(plan, form)
    found = [*split.feed(output.encode("utf-8", "surrogatepass")), *split.end()]
    return b"".join(x for _, x in sorted(found, key=lambda f: f[0])).decode("utf-8", "surrogatepass")
