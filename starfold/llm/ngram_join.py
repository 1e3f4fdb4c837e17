"""N-gram Jaccard join by grouped prefixes.

Two documents link when their sets of distinct word shingles have a Jaccard
index of at least ``percent``/100. The job runs in these steps:

1. One row per document: size of its set and a fingerprint of the set. Equal
   sets are one *class* from here on.
2. Document frequency of every shingle, over hash buckets of packed arrays.
   A shingle of one class only can't be common to two, so it goes no further.
   Very frequent shingles (more than about 1/300 of all documents for
   certain, from counts over all documents) skip the buckets: the list of them
   with their ranks goes to every task.
3. Per class the shingles that others have too, rarest first. A class that
   shares less than the threshold drops out; the others get the prefix that
   any partner must touch, and the shorter lead of it that any partner of its
   size or larger must touch.
4. Classes with identical prefix and size form one *group*. Groups meet by
   prefix shingle that is in the lead of one: the smallest group is paired with the others
   (never all with all), groups paired with the same one form a *circle*.
5. A circle is expanded to its members and verified. Jaccard distance is a
   metric: with the distances to one pivot member, its links follow at once,
   members linked to it are in one component, and only members whose distance
   to the pivot is between the threshold and twice the threshold can link to
   both sides, so the circle falls into smaller ones that are handled the
   same way (those members with the linked ones; all but the linked ones).
   Circles above ``CIRCLE`` shingles or ``WORK`` (members times shingles) are
   split so by joins, or where a pivot leaves more than half of one together,
   dealt to pairs of blocks; the others are verified in one task each, where
   members with the same shared shingles count as one, the smaller of a pair
   looks for the other by its lead, pairs of one component are passed over, and
   a member with many candidates counts what it shares with all of them at once. No link between two classes is lost, and copies or near
   copies are never expanded into all pairs.
6. Connected components of the links, carried back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .links import components
from .words import chunks, mix, shingle_sets

CIRCLE = 4_000_000      # shingles of a circle verified in one task; larger circles are split by joins first
WORK = 4_000_000_000    # members times shingles of such a circle: about what is added up if all are candidates of all
FEW = 16                # candidates up to which a member is compared with each by itself
BUCKET = 1_500_000      # shingles in a bucket, about
COUNTERS = 200_000      # shingle counters that a task keeps while it looks for very frequent ones
HOT_SHARE = 4000        # a shingle counted in 1/4000 of the documents is very frequent; so at most
                        # 4000 times the mean set size of them, which bounds the list every task gets


def _fingerprint(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix(s).sum(dtype=np.uint64) + np.uint64(len(s)) * np.uint64(0x9E3779B97F4A7C15)
        return int(mix(np.array([total]))[0].view(np.int64))


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        for a, b in chunks(batch.column(1)):
            yield batch.column(0).slice(a, b - a), shingle_sets(batch.column(1).slice(a, b - a), width)


def _describe(docs: DataFrame, width: int) -> DataFrame:
    """Rows of documents (id, n, fp) and rows of frequent shingles (tok, times) of each task."""
    schema = f"id {docs.schema[0].dataType.simpleString()}, n long, fp long, tok long, times long"
    kind = docs.schema[0].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        id_type = to_arrow_type(kind)
        toks, times, fps = np.zeros(0, np.uint64), np.zeros(0, np.int64), set()
        for ids, sets in _sets(batches, width):
            prints = np.array([_fingerprint(s) if len(s) else 0 for s in sets], dtype=np.int64)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            nothing = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([ids.cast(id_type), pa.array(n), pa.array(prints), nothing, nothing],
                                             ["id", "n", "fp", "tok", "times"])
            new = [s >> np.uint64(16) for s, p in zip(sets, prints.tolist()) if p not in fps and not fps.add(p)]
            if new:
                u, inv = np.unique(np.concatenate([toks, *new]), return_inverse=True)
                counts = np.bincount(inv, weights=np.concatenate([times, np.ones(sum(map(len, new)))]), minlength=len(u))
                toks, times, floor = u, counts.astype(np.int64), 1
                while len(toks) > COUNTERS:      # the counters of the rarest go; a count can only be too low
                    toks, times, floor = toks[times > floor], times[times > floor] - 1, 1
        keep = times > 1
        nothing = pa.nulls(int(keep.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.nulls(int(keep.sum()), id_type), nothing, nothing, pa.array(toks[keep].view(np.int64)),
                                          pa.array(times[keep])], ["id", "n", "fp", "tok", "times"])

    return docs.mapInArrow(run, schema)


_PACKED = "key int, fps binary, sizes binary, lens binary, toks binary, ranks binary"


def _packed(key: int, fps, lens, toks, ranks=None, sizes=None) -> tuple:
    """A row of ``_PACKED``: classes, how many shingles of each, the shingles in six bytes each, their ranks."""
    six = np.ascontiguousarray(toks.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
    return (key, fps.astype(np.int64).tobytes(), b"" if sizes is None else sizes.astype(np.int32).tobytes(),
            lens.astype(np.int32).tobytes(), six.tobytes(), b"" if ranks is None else ranks.astype(np.uint8).tobytes())


def _batch(rows: list[tuple], schema: str = _PACKED) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}
    kinds = [types[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _unpack(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Per shingle its class, the shingle and its rank."""
    def col(name, kind):
        return np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind)
    toks = np.zeros((int(col("lens", np.int32).sum()), 8), np.uint8)
    toks[:, :6] = col("toks", np.uint8).reshape(-1, 6)
    return np.repeat(col("fps", np.int64), col("lens", np.int32)), toks.view("<u8").reshape(-1), col("ranks", np.uint8)


def _rank(times: np.ndarray) -> np.ndarray:
    """Place in the order of shingles, rare ones first; any order is right if all documents share it."""
    return np.minimum(4 * np.log2(np.maximum(times, 1)), 255).astype(np.uint8)


def _deal(docs: DataFrame, width: int, buckets: int, hot: tuple[bytes, bytes]) -> DataFrame:
    """Shingles dealt by hash to buckets 0..buckets-1; per class its size and very frequent shingles to -1-home."""
    def run(batches):
        frequent, ranks, seen = np.frombuffer(hot[0], dtype=np.uint64), np.frombuffer(hot[1], dtype=np.uint8), set()
        for _, sets in _sets(batches, width):
            rows, new, fps, size = [], [], [], []
            for s in sets:
                if len(s):
                    p = _fingerprint(s)
                    if p not in seen:
                        seen.add(p)
                        new.append(s >> np.uint64(16))
                        size.append(len(s))
                        fps.append(p)
            if not new:
                continue
            fps, n = np.array(fps, dtype=np.int64), np.array(size, dtype=np.int64)
            toks, own = np.concatenate(new), np.repeat(np.arange(len(n)), n)
            at = np.minimum(np.searchsorted(frequent, toks), max(len(frequent) - 1, 0))
            often = frequent[at] == toks if len(frequent) else np.zeros(len(toks), bool)
            key = np.where(often, 0, (toks >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)
            home = (fps.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(key[~often], kind="stable")
            t, o, k = toks[~often][order], own[~often][order], key[~often][order]
            edge = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]]) if len(k) else np.zeros(1, int)
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                docs_here, lens = np.unique(o[a:b], return_counts=True)
                rows.append(_packed(int(k[a]), fps[docs_here], lens, t[a:b]))
            lens = np.bincount(own[often], minlength=len(n))
            spans = np.concatenate([[0], np.cumsum(lens)])
            order = np.argsort(home, kind="stable")
            h, r = toks[often], ranks[at[often]] if len(frequent) else ranks
            for g in np.unique(home).tolist():
                mine = order[np.searchsorted(home[order], g):np.searchsorted(home[order], g, side="right")]
                which = np.concatenate([np.arange(spans[i], spans[i + 1]) for i in mine.tolist()])
                rows.append(_packed(-1 - g, fps[mine], lens[mine], h[which], r[which], n[mine]))
            yield _batch(rows)
    return docs.mapInArrow(run, _PACKED)


def _count(buckets: int):
    """Per bucket: shingles of two classes or more, with a rank that grows with their number, dealt to their classes' homes."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table.set_column(0, "key", pa.array([-1 - key[0].as_py()] * len(table), pa.int32()))
        fps, toks, _ = _unpack(table)
        order = np.lexsort((fps, toks))
        fps, toks = fps[order], toks[order]
        keep = np.ones(len(toks), bool)     # tasks that met the same class each gave its shingles
        keep[1:] = (toks[1:] != toks[:-1]) | (fps[1:] != fps[:-1])
        fps, toks = fps[keep], toks[keep]
        edge = np.flatnonzero(np.concatenate([[True], toks[1:] != toks[:-1]])) if len(toks) else np.zeros(0, int)
        times = np.diff(np.concatenate([edge, [len(toks)]]))
        rank = np.repeat(_rank(times), times)
        many = np.repeat(times > 1, times)
        fps, toks, rank = fps[many], toks[many], rank[many]
        home = (fps.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((fps, home))
        rows, home = [], home[order]
        for g in np.unique(home).tolist():
            mine = order[np.searchsorted(home, g):np.searchsorted(home, g, side="right")]
            start = np.flatnonzero(np.concatenate([[True], fps[mine][1:] != fps[mine][:-1]]))
            rows.append(_packed(g, fps[mine][start], np.diff(np.concatenate([start, [len(mine)]])), toks[mine], rank[mine]))
        return pa.Table.from_batches([_batch(rows)])
    return run


_CLASSES = "fp long, n long, toks binary, grp long, prefix binary, lead int"


def _choose(percent: int):
    """Per home: the classes that share enough, with their shared shingles, prefix and group."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sized = [i for i, x in enumerate(table["sizes"].to_pylist()) if x]
        known = np.frombuffer(b"".join(table["fps"].take(sized).to_pylist()), np.int64)
        size_of = dict(zip(known.tolist(), np.frombuffer(b"".join(table["sizes"].take(sized).to_pylist()), np.int32).tolist()))
        fps, toks, ranks = _unpack(table)
        order = np.lexsort((toks, ranks, fps))
        fps, toks, ranks = fps[order], toks[order], ranks[order]
        keep = np.ones(len(toks), bool)
        keep[1:] = (toks[1:] != toks[:-1]) | (fps[1:] != fps[:-1])
        fps, toks = fps[keep], toks[keep]
        start = np.flatnonzero(np.concatenate([[True], fps[1:] != fps[:-1]])) if len(fps) else np.zeros(0, int)
        rows = []
        for a, b in zip(start.tolist(), [*start[1:].tolist(), len(fps)]):
            n = size_of[int(fps[a])]
            need = -(-percent * n // 100)
            if b - a >= need:
                prefix = toks[a:b][:max(0, n - need + 1 - (n - (b - a)))]
                with np.errstate(over="ignore"):
                    group = mix(np.array([mix(prefix * np.uint64(3) + np.arange(len(prefix), dtype=np.uint64)).sum(dtype=np.uint64) + np.uint64(n)]))
                # with a partner of its size or larger, more must be common: the first common shingle is in the lead
                lead = max(0, b - a + 1 + (-2 * percent * n // (100 + percent)))
                rows.append((int(fps[a]), n, np.sort(toks[a:b]).tobytes(), int(group.view(np.int64)[0]), prefix.tobytes(), lead))
        return pa.Table.from_batches([_batch(rows, _CLASSES)])
    return run


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted arrays of distinct numbers."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


class _Common:
    """Counts what a member shares with all others at once; shingles with the same members are one list with a weight."""

    def __init__(self, sets: list[np.ndarray]):
        _, tok = np.unique(np.concatenate(sets), return_inverse=True)
        own = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
        own = own[np.argsort(tok, kind="stable")]            # members rise within a shingle
        start = np.concatenate([[0], np.cumsum(np.bincount(tok))])
        mark = np.add.reduceat(mix(own.astype(np.uint64) + np.uint64(1)), start[:-1])
        _, first, self.weight = np.unique(mark, return_index=True, return_counts=True)
        self.lists = [own[start[t]:start[t + 1]] for t in first.tolist()]
        which = np.repeat(np.arange(len(self.lists)), [len(x) for x in self.lists])
        who = np.concatenate(self.lists)
        self.of = which[np.argsort(who, kind="stable")]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(sets)))])
        self.total = np.zeros(len(sets), np.int32)

    def with_later(self, p: int) -> np.ndarray:
        """How many shingles each member after ``p`` shares with it."""
        self.total[p:] = 0
        for k in self.of[self.at[p]:self.at[p + 1]].tolist():
            later = self.lists[k]
            later = later[int(np.searchsorted(later, np.int32(p), side="right")):]
            self.total[later] += self.weight[k]
        return self.total


def _verify(percent: int):
    """Links of a circle; pairs that earlier links already put in one component are passed over.

    Members of one size with the same shared shingles have the same index with
    each other and with any third, so one of them stands for all. The smaller
    of a pair looks for the other by the shingles of its lead. What is shared
    with more than ``FEW`` candidates is counted for all of them at once.
    """
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("fp", "ascending")])
        alike: dict[tuple, int] = {}
        of = [alike.setdefault(x, len(alike)) for x in zip(*(table[c].to_pylist() for c in ("n", "side", "toks")))]
        members: list[list[int]] = [[] for _ in alike]
        row: list[int] = [0] * len(alike)
        for i, (r, fp) in enumerate(zip(of, table["fp"].to_pylist())):
            if not members[r]:
                row[r] = i
            members[r].append(fp)
        table = table.take(row)
        n, side, leads = (np.array(table[c].to_pylist(), dtype=np.int64) for c in ("n", "side", "lead"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table["toks"].to_pylist()]
        prefixes = [np.frombuffer(x, dtype=np.uint64).tolist() for x in table["prefix"].to_pylist()]
        holders: dict[int, list[int]] = {}
        for i, x in enumerate(prefixes):
            for tok in x:
                holders.setdefault(tok, []).append(i)
        # shingles of the same members make one list
        number: dict[tuple, int] = {}
        list_of = {tok: number.setdefault(tuple(m), len(number)) for tok, m in holders.items() if len(m) > 1}
        lists = [np.array(m, dtype=np.int64) for m in number]
        open_list = [True] * len(lists)
        del holders, number
        links, root, common = [], np.arange(len(n)), None
        inside = [[i] for i in range(len(n))]        # of each component, under its root

        for r, (m, s) in enumerate(zip(members, sets)):
            if len(m) > 1 and 100 * len(s) >= percent * (2 * n[r] - len(s)):
                links += [(m[0], x) for x in m[1:]]
                members[r] = m[:1]

        for p in range(len(n)):
            most, shared = 100 * n[p] // percent, None
            for k in {list_of[tok] for tok in prefixes[p][:leads[p]] if tok in list_of}:
                if not open_list[k]:
                    continue
                other = lists[k]
                other = other[root[other] != root[p]]
                if not len(other):
                    open_list[k] = False
                    continue
                # sizes rise, so partners as large or larger come after
                other = other[(other > p) & (n[other] <= most) & ((side[other] == 2) | (side[other] != side[p]))]
                if shared is None and len(other) > FEW:
                    common = common or _Common(sets)
                    shared = common.with_later(p)
                if shared is not None:
                    both = shared[other].astype(np.int64)
                    other = other[100 * both >= percent * (n[p] + n[other] - both)]
                for m in other.tolist():
                    if root[m] == root[p]:
                        continue
                    both = overlap(sets[p], sets[m]) if shared is None else int(shared[m])
                    if 100 * both >= percent * (n[p] + n[m] - both):
                        links += [(members[p][0], x) for x in members[m]] + [(x, members[m][0]) for x in members[p][1:]]
                        members[p], members[m] = members[p][:1], members[m][:1]     # all are in the component now
                        a, b = int(root[p]), int(root[m])
                        if len(inside[a]) < len(inside[b]):
                            a, b = b, a
                        root[inside[b]] = a
                        inside[a] += inside[b]
                        inside[b] = []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})
    return run


def _measure(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(pivot, fp, zone): 0 linked, 1 within twice the distance of a link, 2 beyond."""
    both = (pairs.join(classes.select(F.col("fp").alias("pivot"), F.col("n").alias("n_p"), F.col("toks").alias("toks_p")), "pivot")
            .join(classes.select("fp", "n", "toks"), "fp"))

    def measure(batches):
        for b in batches:
            common = [overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                      for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(4), pa.array(common, pa.int64())],
                                             ["pivot", "fp", "sizes", "both"])

    found = both.select("pivot", "fp", "toks_p", "toks", (F.col("n_p") + F.col("n")).alias("sizes"))
    found = found.mapInArrow(measure, "pivot long, fp long, sizes long, both long")
    union = F.col("sizes") - F.col("both")
    return found.select("pivot", "fp", F.when(F.col("both") * 100 >= union * percent, 0)
                        .when(1 - F.col("both") / union <= 2 * (1 - percent / 100) + 1e-9, 1).otherwise(2).alias("zone"))


# What becomes of a member by (side, zone): the circles it enters, as (which, side). Sides 0 and 1 must meet each
# other only, side 2 meets all. Any two members that could still link meet in exactly one of the new circles.
_MOVES = [(2, 0, 1, 0), (2, 1, 1, 1), (2, 1, 2, 2), (2, 2, 2, 2),
          (0, 0, 1, 0), (1, 1, 1, 1), (0, 1, 3, 0), (1, 0, 3, 1), (0, 1, 2, 0), (0, 2, 2, 0), (1, 1, 2, 1), (1, 2, 2, 1)]


def _block_pairs(circles: DataFrame, most: int, work: int) -> DataFrame:
    """Circles dealt to blocks by hash, so that two have about ``most`` shingles and ``work`` at most; every two
    blocks make a circle, and each its own."""
    blocks = F.ceil(2 * F.greatest(F.col("shingles") / most, F.sqrt(F.col("shingles") / work * F.col("members")))).cast("long")
    dealt = circles.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("fp"), "blocks"))
    met = dealt.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    # two sides: a block of one meets every block of the other; one side: the lower block is side 0, the upper side 1
    low, high = F.least("own", "met"), F.greatest("own", "met")
    low = F.when(F.col("side") == 2, low).when(F.col("side") == 0, F.col("own")).otherwise(F.col("met"))
    high = F.when(F.col("side") == 2, high).when(F.col("side") == 0, F.col("met")).otherwise(F.col("own"))
    side = F.when(F.col("side") < 2, F.col("side")).when(F.col("own") == F.col("met"), 2).when(F.col("own") < F.col("met"), 0).otherwise(1)
    return met.select(F.xxhash64("circle", low, high, F.lit("blocks")).alias("circle"), "fp", side.cast("int").alias("side"))


def _split_large(circles: DataFrame, classes: DataFrame, percent: int, most: int, work: int) -> tuple[list[DataFrame], DataFrame]:
    """Links found while circles above ``most`` shingles or above ``work`` are split, and the circles that remain.

    A pivot splits a circle as long as each part has at most half of the
    members; a larger part is dealt to pairs of blocks at once. So the rounds
    are few, and no circle that remains is large.
    """
    links, small = [], []
    moves = circles.sparkSession.createDataFrame(_MOVES, "side int, zone int, which int, next int")
    circles = circles.withColumn("before", F.lit(None).cast("long"))
    while True:
        size = circles.groupBy("circle").agg(
            F.count(F.lit(1)).alias("members"), F.max("side").alias("kind"), F.min("side").alias("other"),
            F.min(F.when(F.col("side") > 0, F.col("fp"))).alias("pivot"), F.sum("n").alias("shingles"))
        size = size.where("members > 1 AND (kind = 2 OR kind <> other)").drop("kind", "other")
        circles = cut(circles.join(size, "circle"))
        fits = (F.col("shingles") <= most) & (F.col("shingles").cast("double") * F.col("members") <= work)
        small.append(circles.where(fits).select("circle", "fp", "side"))
        large = circles.where(~fits)
        if large.isEmpty():
            break
        small.append(_block_pairs(large.where("2 * members > before"), most, work))
        large = large.where("before IS NULL OR 2 * members <= before").where("fp <> pivot")
        found = cut(_measure(large.select("pivot", "fp").distinct(), classes, percent))
        links.append(found.where("zone = 0").select(F.col("pivot").alias("a"), F.col("fp").alias("b")))
        zones = large.join(found, ["pivot", "fp"]).join(F.broadcast(moves), ["side", "zone"])     # twelve rows
        circles = zones.select(F.xxhash64("circle", "which").alias("circle"), "fp", "n", F.col("next").alias("side"),
                               F.col("members").alias("before"))
    rest = small[0]
    for s in small[1:]:
        rest = rest.union(s)
    return links, rest


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
                    circle: int = CIRCLE, work: int = WORK) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``.

    A-Z are lower-cased; words are runs of characters other than blank and
    \\t..\\r. The set of a text holds its distinct ``width``-word shingles; with
    fewer words the whole sequence is the only element; null texts and texts
    without a word have an empty set, link to nothing and are their own
    component. ``component_id`` is the smallest id reachable by links. Repeated
    rows give a row each; a null id never becomes a component's id unless the
    component has no other. Other columns of ``docs`` are ignored. Shingles
    are compared by 48 bits of a 64-bit hash, sets by size and a 64-bit hash.
    """
    spark = docs.sparkSession
    pair = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    described = cut(_describe(pair, width))
    rows = described.where("n IS NOT NULL").select("id", "n", "fp")
    total = rows.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("toks")).first()
    frequent = (described.where("tok IS NOT NULL").groupBy("tok").agg(F.sum("times").alias("times"))
                .where(F.col("times") >= 64 + total.docs // HOT_SHARE).toPandas())
    toks = frequent["tok"].to_numpy(dtype=np.int64).view(np.uint64)
    hot = tuple(x[np.argsort(toks)].tobytes() for x in (toks, _rank(frequent["times"].to_numpy(dtype=np.int64))))
    buckets = int(max(8, -(-total.toks // BUCKET)))
    dealt = _deal(pair, width, buckets, hot)
    counted = dealt.groupBy("key").applyInArrow(_count(buckets), _PACKED)
    classes = cut(counted.groupBy("key").applyInArrow(_choose(percent), _CLASSES))

    groups = classes.groupBy("grp").agg(F.first("prefix").alias("prefix"), F.first("lead").alias("lead"))

    def listed(batches):
        for b in batches:
            for g, p, lead in zip(*(c.to_pylist() for c in b.columns)):
                toks = np.frombuffer(p, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(toks), g, np.int64)), pa.array(toks), pa.array(np.arange(len(toks)) < lead)],
                                                 ["grp", "tok", "leads"])

    # a shingle in nobody's lead is no link's first common one
    index = cut(groups.mapInArrow(listed, "grp long, tok long, leads boolean"))
    first = index.groupBy("tok").agg(F.min("grp").alias("circle"), F.count(F.lit(1)).alias("groups"), F.max("leads").alias("leads"))
    first = first.where("groups > 1 AND leads").select("tok", "circle")
    meet = index.join(first, "tok").select("circle", "grp").distinct()
    alone = classes.where("lead > 0").groupBy("grp").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select(F.col("grp").alias("circle"), "grp")
    circles = meet.union(alone).distinct().join(classes.select("grp", "fp", "n"), "grp").select("circle", "fp", "n", F.lit(2).alias("side"))

    links, circles = _split_large(circles, classes, percent, circle, work)
    small = circles.join(classes.select("fp", "n", "toks", "prefix", "lead"), "fp").groupBy("circle").applyInArrow(_verify(percent), "a long, b long")
    for found in links:
        small = small.union(found)
    roots = cut(components(small))
    # cut, so that the joins below have plain inputs and the engine may split the rows of a large group
    rooted = cut(rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("id", "n", F.when(F.col("n") > 0, F.coalesce("root", "fp")).alias("root")))
    first_id = cut(rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least")))
    return (rooted.join(first_id, "root", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id")))
