"""Toxicity by noisy-channel deobfuscation.

Writers hide words: other characters for letters (1d10t), spaces or dots
between letters (i d i o t), letters repeated (idiooot). A token that looks so
becomes a lattice of characters: a sign may be itself or one of the letters it
looks like, a run of one letter may be one, two or all of them, a gap between
single letters may be nothing. A Viterbi search finds the path that a
character trigram model of the corpus and the channel's costs like best, and
the text is scored as written and with the restored tokens.

The score looks for runs of four to six characters inside words (word edges
count) that mark toxic documents: of the runs that several labelled toxic
documents have, those that are much rarer in labelled clean ones. A word weighs
as its strongest run, by a lower bound of the log ratio of the two rates; the
sum of the weights, the strongest and the length of the text go into a logistic
regression, which gives the probability. It is fitted on weights that leave
out the document's own counts.

The language model counts the trigrams of all documents. Labelled rows for the
runs and the regression are a bounded sample.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .words import SMALL, add_columns, chunks, code_points, letters, windows

SIZES = (4, 5, 6)
FIT_TOXIC, FIT_CLEAN = 2000, 6000      # labelled rows of either kind in the sample, about
LEAST_SHARE = 0.005                    # of the toxic sample that a run must be in, three documents at least; so
                                       # at most 200 times the mean number of runs of a document are kept
LEAST_WEIGHT = 1.5                     # of a run that marks
MOST_COUNTED = 5                       # occurrences of a run counted in one document
LOOKS_LIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SYMBOLS = "abcdefghijklmnopqrstuvwxyzàáâäçèéêëíîïñóôöùúûüß"
RADIX = len(SYMBOLS) + 2               # 0: word edge, last: any other letter
LONGEST = 48                           # characters of a token whose result is remembered; longer ones are searched each time
OTHER_COST, RUN_COST, GAP_COST = 1.5, 0.5, 0.5      # of a sign read as a letter, a run shortened, a gap dropped
KEPT_COST = 4.0                        # of a sign kept inside a word


def _symbol_table() -> np.ndarray:
    table = np.full(1 << 16, RADIX - 1, dtype=np.int64)
    for i, c in enumerate(SYMBOLS):
        table[ord(c)] = i + 1
    return table


def count_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of character trigrams of all texts, RADIX**3 at most, summed over the tasks by a shuffle."""
    def run(batches):
        table, total = _symbol_table(), np.zeros(RADIX ** 3, dtype=np.int64)
        for batch in batches:
            for a, b in chunks(batch.column(0), SMALL):
                points, _ = code_points([t.lower() for t in batch.column(0).slice(a, b - a).to_pylist()])
                s = np.where(letters(points), table[np.minimum(points, (1 << 16) - 1)], 0)
                total += np.bincount((s[:-2] * RADIX + s[1:-1]) * RADIX + s[2:], minlength=RADIX ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["tri", "n"])

    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    sums = texts.mapInArrow(run, "tri long, n long").groupBy("tri").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(RADIX ** 3)
    out[sums["tri"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=float)
    return out


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two), interpolated with the bigram and the even distribution."""
    tri = counts.reshape(RADIX, RADIX, RADIX)
    bi = tri.sum(axis=0)
    p2 = (bi + 1.0) / (bi.sum(axis=1, keepdims=True) + RADIX)
    return np.log((tri + 20.0 * p2[None, :, :]) / (tri.sum(axis=2, keepdims=True) + 20.0)).astype(np.float32)


_SIGNS = re.escape("".join(LOOKS_LIKE))
GAPS = " .-_*"
END_MARKS = "!"                        # signs that end a sentence: at the end of a token they cost nothing to keep
_UNIT, _GAP = rf"(?:[^\W\d_]|[{_SIGNS}])", rf"[{re.escape(GAPS)}]{{1,2}}"
# A whole token of letters and signs, both in it; or of letters with one three times in a row; or single letters or signs
# set apart. Each is tried from the start of a token only, so that the search is linear.
_SUSPECT = re.compile(rf"(?<!{_UNIT})(?:[^\W\d_]++[{_SIGNS}]|[{_SIGNS}]++[^\W\d_])(?:[^\W\d_]++|[{_SIGNS}]++)*+"
                      rf"|(?<!{_UNIT})[^\W\d_]*?([^\W\d_])\1\1[^\W\d_]*+"
                      rf"|(?<![^\W\d_]){_UNIT}(?:{_GAP}{_UNIT}){{3,}}(?![{_SIGNS}]*+[^\W\d_])")


class Decoder:
    """Viterbi search over character lattices."""

    def __init__(self, model: np.ndarray):
        self.p, self.table, self.memo = model.ravel().tolist(), {c: i + 1 for i, c in enumerate(SYMBOLS)}, {}

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """Places of a token, each with its alternatives (text, cost). Equal places are one list."""
        out, i, known = [], 0, {}
        spaced = re.fullmatch(r"\S(?:[ .\-_*]{1,2}\S)+", token) is not None
        while i < len(token):
            c, j = token[i], i + 1
            while j < len(token) and token[j] == c:
                j += 1
            n = j - i
            if (c, n) not in known or j == len(token):
                if spaced and c in " .-_*":
                    some = [("", GAP_COST)]
                elif c in LOOKS_LIKE:
                    ends = c in END_MARKS and 0 < i and j == len(token)
                    some = [(c * n, -KEPT_COST * n if ends else 0.0)]
                    for x in LOOKS_LIKE[c]:
                        some += [(x * n, OTHER_COST * n)] + ([(x, OTHER_COST * n + RUN_COST)] if n > 1 else [])
                elif n >= 3:
                    some = [(c * n, 0.0), (c, RUN_COST), (c * 2, RUN_COST)]
                else:
                    some = [(c * n, 0.0)]
                known[c, n] = some
            out.append(known[c, n])
            i = j
        return out

    def restore(self, token: str) -> str:
        if len(token) > LONGEST:
            return self._search(token)
        if token not in self.memo:
            if len(self.memo) > 100_000:
                self.memo.clear()
            self.memo[token] = self._search(token)
        return self.memo[token]

    def _read(self, a: int, b: int, text: str) -> tuple[int, int, float]:
        """The last two symbols and the log probability after ``text``, which repeats one character."""
        if not text:
            return a, b, 0.0
        z = self.table.get(text[0], RADIX - 1 if text[0].isalpha() else 0)
        s, n = self.p[(a * RADIX + b) * RADIX + z], len(text)
        if n > 1:
            s, a, b = s + self.p[(b * RADIX + z) * RADIX + z] + (n - 2) * self.p[(z * RADIX + z) * RADIX + z], z, z
        else:
            a, b = b, z
        return a, b, s if z else s - KEPT_COST * n

    def _search(self, token: str) -> str:
        """The best path through all places. Each place keeps for each state the state before and the choice; where
        only one state is left, the text up to there is settled and the pointers go."""
        keys, scores, out, back = [(0, 0)], [0.0], [], []

        def settle(state: int):
            path = []
            for place, pointers in reversed(back):
                path.append(place[pointers[2 * state + 1]][0])
                state = pointers[2 * state]
            out.extend(reversed(path))
            back.clear()

        for place in self.lattice(token):
            after: dict[tuple[int, int], int] = {}
            new, pointers = [], bytearray()
            for i, ((a, b), score) in enumerate(zip(keys, scores)):
                for k, (more, cost) in enumerate(place):
                    x, y, s = self._read(a, b, more)
                    s += score - cost
                    at = after.setdefault((x, y), len(new))
                    if at == len(new):
                        new.append(s)
                        pointers += bytes((i, k))
                    elif s > new[at]:
                        new[at], pointers[2 * at], pointers[2 * at + 1] = s, i, k
            keys, scores = list(after), new
            back.append((place, bytes(pointers)))
            if len(keys) == 1:
                settle(0)
        settle(max(range(len(keys)), key=lambda i: scores[i] + self.p[(keys[i][0] * RADIX + keys[i][1]) * RADIX]))
        return "".join(out)


def _marked(which) -> np.ndarray:
    return np.array([which(chr(c)) for c in range(1 << 16)])


_TABLES: list[np.ndarray] = []


def _hints(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Texts that may match ``_SUSPECT``, and none that does is left out: a letter beside a sign, three equal letters,
    or two single letters or signs in a row with gaps around both. Letters are those of the pattern; characters
    above 16 bits all count as such."""
    if not _TABLES:
        _TABLES.extend([_marked(lambda c: c.isalnum() and not c.isdecimal()), _marked(LOOKS_LIKE.__contains__), _marked(GAPS.__contains__)])
    low = np.minimum(points, (1 << 16) - 1)
    letter, sign, gap = (t[low] for t in _TABLES)
    letter |= points >= 1 << 16
    found = [np.flatnonzero((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])),
             np.flatnonzero(letter[:-2] & (points[:-2] == points[1:-1]) & (points[:-2] == points[2:]))]
    unit = letter | sign
    single = np.zeros(len(points) + 3, dtype=bool)
    single[1:len(points) - 1] = unit[1:-1] & gap[:-2] & gap[2:]
    one = np.flatnonzero(single)
    found.append(one[single[one + 2] | (single[one + 3] & gap[np.minimum(one + 2, len(points) - 1)])])
    return np.unique(np.searchsorted(at, np.concatenate(found), side="right") - 1)


def restored(text: str, decoder: Decoder) -> str:
    """The tokens of a lower-cased text that the search changes, as restored and set apart; empty if there is none."""
    tokens = [m.group() for m in _SUSPECT.finditer(text)]
    return "\n".join(r for t in tokens if (r := decoder.restore(t)) != t)


@dataclass
class Model:
    runs: np.ndarray          # hashes of marking runs, sorted
    weights: np.ndarray       # of each
    regression: np.ndarray    # coefficients of the features, offset last
    trigrams: np.ndarray      # log probabilities


class Hashed:
    """Runs of texts: ``own`` text, ``word`` it is in, ``hash``; and the number of words of each text."""

    def __init__(self, texts: list[str]):
        self.points, self.at = code_points(texts)
        self.letter = letters(self.points)
        first = self.letter.copy()
        first[1:] &= ~self.letter[:-1]
        number = np.cumsum(first)
        self.n_words = np.diff(number[self.at])
        own, word, hashes = [], [], []
        for n in SIZES:
            place, h = windows(self.points, self.letter, n)
            own.append(np.searchsorted(self.at, place, side="right") - 1)
            word.append(number[place + 1] if len(place) else place)
            hashes.append(h)
        self.own, self.word, self.hash = np.concatenate(own), np.concatenate(word), np.concatenate(hashes)


def _occurrences(own: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count up to MOST_COUNTED) of each run in each text, by hash."""
    order = np.lexsort((own, h))
    own, h = own[order], h[order]
    edge = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])])) if len(h) else np.zeros(0, np.int64)
    return own[edge], h[edge], np.minimum(np.diff(np.concatenate([edge, [len(h)]])), MOST_COUNTED)


class Evidence:
    """Features of texts from weighted runs. ``spare`` may give weights from the run's place and the text's own count."""

    def __init__(self, runs: np.ndarray, weights: np.ndarray, decoder: Decoder, spare=None):
        self.runs, self.weights, self.decoder, self.spare = runs, weights, decoder, spare
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(runs >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, x: Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, word, weight) of the marked words."""
        some = np.flatnonzero(self.sieve[(x.hash >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.runs, x.hash[some]), max(len(self.runs) - 1, 0))
        some, at = (some[hit], at[hit]) if len(self.runs) and (hit := self.runs[at] == x.hash[some]).any() else (some[:0], at[:0])
        own, word, weight = x.own[some], x.word[some], self.weights[at]
        if self.spare is not None and len(some):
            text, run, counts = _occurrences(own, at)
            key = text * len(self.runs) + run
            order = np.argsort(key)
            weight = self.spare(at, counts[order][np.searchsorted(key[order], own * len(self.runs) + at)])
        order = np.lexsort((-weight, word))
        own, word, weight = own[order], word[order], weight[order]
        best = np.ones(len(word), bool)
        best[1:] = word[1:] != word[:-1]
        best &= weight >= LEAST_WEIGHT
        return own[best], word[best], weight[best]

    def features(self, texts: list[str]) -> np.ndarray:
        lowered = [t.lower() for t in texts]
        x = Hashed(lowered)
        own, _, weight = self.hits(x)
        extra = [(i, r) for i in _hints(x.points, x.at).tolist() if i < len(texts) and (r := restored(lowered[i], self.decoder))]
        if extra:
            more, _, found = self.hits(Hashed([r for _, r in extra]))
            own = np.concatenate([own, np.array([i for i, _ in extra], dtype=np.int64)[more]])
            weight = np.concatenate([weight, found])
        total, top = np.bincount(own, weights=weight, minlength=len(texts))[:len(texts)], np.zeros(len(texts))
        np.maximum.at(top, own, weight)
        n = np.maximum(x.n_words[:len(texts)], 1)
        return np.stack([total / 10, np.log1p(total), top, np.log1p(100 * total / n), np.log(n), n / 1000, np.ones(len(texts))], axis=1)


FEATURES = 7


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_toxic: int = FIT_TOXIC, fit_clean: int = FIT_CLEAN) -> Model:
    """Fit on about ``fit_toxic`` and ``fit_clean`` of the labelled rows, picked by a hash of the id.

    A document labelled more than once is toxic if any label says so; null
    labels and ids count for nothing; labels without a document neither. If
    one kind of label is missing every score is near 0 or 1 with the other
    kind, near 0 without labels. The trigram model counts all documents.
    """
    trigrams = log_probabilities(count_trigrams(docs, text_col))
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where("_id IS NOT NULL AND y IS NOT NULL")
    marks = marks.groupBy("_id").agg(F.max("y").alias("y"))
    total = {int(r.y > 0): r.n for r in marks.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    constant = np.zeros(FEATURES)
    constant[-1] = 40.0 if set(total) == {1} else -40.0
    if len(total) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), constant, trigrams)
    part = F.when(F.col("y") > 0, fit_toxic / total[1]).otherwise(fit_clean / total[0])
    chosen = marks.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < part * float(1 << 30))
    # the sample is bounded by the two parameters, so it may be broadcast and kept
    sample = cut(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where("_text IS NOT NULL")
                 .join(F.broadcast(chosen), "_id").select("_text", (F.col("y") > 0).cast("int").alias("y")))

    def counted(only: np.ndarray | None):
        """Per task: runs with their documents and occurrences; a row without a run has the documents and words."""
        def run(batches):
            found, docs_of, times, n, words = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0
            for batch in batches:
                for a, b in chunks(batch.column(0), SMALL):
                    x = Hashed([t.lower() for t in batch.column(0).slice(a, b - a).to_pylist()])
                    n, words = n + b - a, words + int(x.n_words.sum())
                    own, h = x.own, x.hash
                    if only is not None:
                        at = np.minimum(np.searchsorted(only, h), len(only) - 1)
                        own, h = own[only[at] == h], h[only[at] == h]
                    _, h, c = _occurrences(own, h)
                    u, inv = np.unique(np.concatenate([found, h]), return_inverse=True)
                    docs_of = np.bincount(inv, weights=np.concatenate([docs_of, np.ones(len(h))]), minlength=len(u)).astype(np.int64)
                    times = np.bincount(inv, weights=np.concatenate([times, c]), minlength=len(u)).astype(np.int64)
                    found = u
            yield pa.RecordBatch.from_arrays([pa.array([*found.view(np.int64).tolist(), None], pa.int64()), pa.array([*docs_of.tolist(), n], pa.int64()),
                                              pa.array([*times.tolist(), words], pa.int64())], ["run", "docs", "times"])
        return run

    def sums(y: int, only: np.ndarray | None) -> DataFrame:
        counts = sample.where(f"y = {y}").select("_text").mapInArrow(counted(only), "run long, docs long, times long")
        return cut(counts.groupBy("run").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times")))

    toxic = sums(1, None)
    whole = toxic.where("run IS NULL").first()
    least = max(3, int(LEAST_SHARE * (whole.docs if whole else 0)))
    some = toxic.where(F.col("run").isNotNull() & (F.col("docs") >= least)).toPandas()
    runs = some["run"].to_numpy(dtype=np.int64).view(np.uint64)
    o1 = some["times"].to_numpy(dtype=float)[np.argsort(runs)]
    runs, o0 = np.sort(runs), np.zeros(len(runs))
    if not len(runs):
        return Model(runs, o0, constant * 0 + np.eye(FEATURES)[-1] * np.log(total[1] / total[0]), trigrams)
    clean = sums(0, runs)
    rest, clean = clean.where("run IS NULL").first(), clean.where("run IS NOT NULL").toPandas()
    o0[np.searchsorted(runs, clean["run"].to_numpy(dtype=np.int64).view(np.uint64))] = clean["times"].to_numpy(dtype=float)
    w1, w0 = max(float(whole.times), 1.0), max(float(rest.times if rest else 0), 1.0)

    def weigh(a, b):
        a, b = np.maximum(a, 0), np.maximum(b, 0)
        return np.log((a + 0.5) / w1) - np.log((b + 0.5) / w0) - np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))

    weights = weigh(o1, o0)
    good = weights >= LEAST_WEIGHT
    runs, weights, o1, o0 = runs[good], weights[good], o1[good], o0[good]

    def features(y: int):
        spare = (lambda at, own: weigh(o1[at] - own, o0[at])) if y else (lambda at, own: weigh(o1[at], o0[at] - own))
        rows = add_columns(sample.where(f"y = {y}"), "_text", [], [("x", "array<double>")],
                           lambda: lambda texts: (list(Evidence(runs, weights, Decoder(trigrams), spare).features(texts)),)).toPandas()
        return np.array(rows["x"].tolist(), dtype=float).reshape(-1, FEATURES)

    x = [features(0), features(1)]
    share = np.array([total[0] / max(len(x[0]), 1), total[1] / max(len(x[1]), 1)])
    return Model(runs, weights, _logistic(x[0], x[1], share), trigrams)


def _logistic(clean: np.ndarray, toxic: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Coefficients by Newton's method with a small penalty; the two kinds weigh as in all labels."""
    a, y = np.concatenate([clean, toxic]), np.repeat([0.0, 1.0], [len(clean), len(toxic)])
    weight = share[y.astype(int)]
    weight = weight / weight.sum() * len(y)
    w, penalty = np.zeros(FEATURES), np.eye(FEATURES) * 0.1
    penalty[-1, -1] = 0.01
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        grad = a.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((a * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + penalty, grad)
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all if None), ``score`` (0..1), ``predicted`` (1 from 0.5 on).

    A null or empty text has no evidence and gets the score of none. Columns of
    ``docs`` with the names of the two are replaced.
    """
    def make():
        evidence = Evidence(model.runs, model.weights, Decoder(model.trigrams))

        def run(texts):
            p = 1 / (1 + np.exp(-np.clip(evidence.features(texts) @ model.regression, -40, 40)))
            return p, (p >= 0.5).astype(np.int32)
        return run

    return add_columns(docs, text_col, docs.columns if keep is None else keep, [("score", "double"), ("predicted", "int")], make)
