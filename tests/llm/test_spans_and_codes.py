"""Personal data, vector codes and fill-in-the-middle texts against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, SCHEMA
from starfold.llm import infill, personal, vectors


# --- personal data ------------------------------------------------------------

def luhn(digits):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(int(c) for c in reversed(digits))) % 10 == 0


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def card(rng, n=16):
    head = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(head + c for c in "0123456789" if luhn(head + c))


def sentence(rng, n=12):
    return " ".join(rng.choice("the of and at in houses over river blue quiet over morning that with".split()) for _ in range(n))


def corpus(n=400):
    rng = random.Random(5)
    out = []
    for i in range(n):
        email = f"{rng.choice(['anna', 'jo.hn', 'k_w'])}{i}@mail{i % 7}.example.com"
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        phone = f"+1 ({rng.randrange(200, 900)}) 555-{rng.randrange(10000):04d}"
        said = rng.choice([email, ip, card(rng), phone])
        out.append((i, f"{sentence(rng)}. {said} {sentence(rng)} at noon. Then {sentence(rng)}."))
    return out


def test_base_spans_are_those_of_the_patterns(spark):
    rng = random.Random(3)
    odd = ["a@b.c@d.e_x@y.org", "300.1.2.3.4.5.6.7", "1.2.3.4.5.6.7.8", "001.002.003.0000004", "1.2.3", "+1 234 567 8901+49 (30) 1234-5678.", "4111 1111-1111 1111",
           "4111  1111 1111 1111", card(rng) + " " + card(rng), "x" * 2000, "9" * 2000, "a@b" + ".c" * 2000, "+1" + " " * 2000, "1." * 2000,
           "🙂é a.b@c.de 🙂 10.0.0.1", "1 " * 2000, ":" * 2000, "@" * 2000, "a@" * 2000, "é@b.cd", "(at) [dot] " * 500, "300." * 2000]
    odd += ["".join(rng.choice("ab1290.@+- ()é\n") for _ in range(rng.randrange(1, 400))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(odd)]
    long = [(9000 + i, t * 20_000) for i, t in enumerate(["x" * 10, "9" * 10, "1.", "a@", ":", "300.", "a@b.cd "])]        # too long for the patterns as they stand
    got = {r.doc_id: r for r in personal.digest(spark.createDataFrame(rows + long, "doc_id long, text string").repartition(8)).collect()}
    assert (got[9002].n_ip, got[9006].n_email, got[9000].spans, got[9005].n_ip) == (5000, 20_000, "", 0)
    for i, t in rows:
        want = base_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), t[:80]
        assert [got[i][f"n_{k}"] for k in personal.KINDS] == [sum(s[0] == k for s in want) for k in personal.KINDS]
        assert set(want) <= {(k, int(a), int(b)) for k, a, b in (s.split(":") for s in got[i].spans.split(",") if s)}


def test_disguised_spans_are_added_and_prose_is_not(spark):
    rng = random.Random(8)
    hidden = [("email", "anna7 (at) mail3.example.com"), ("email", "joe[at]host.org"), ("email", "mia.k at mail2 dot example dot com"), ("ip", "17[.]88[.]3[.]201"), ("ip", "17 . 88 . 3 . 201"),
              ("card", f"{card(rng)} {card(rng)}"), ("card", re.sub(r"(....)(?=.)", r"\1.", card(rng))), ("phone", "tel: (415) 555-1234")]
    broken = "".join(str((int(c) + (i == 15)) % 10) for i, c in enumerate(card(rng)))
    clean = ["We met at noon. Then we left at night. And so on.", f"the count {broken} of the day", f'token = "{"b4a1c" * 4}{broken}ff"', "versions 3.900.1.2 and 999.1.1.1", "a total of 1200 3400 5600 in 2024-05-12",
             "look at this.Then go", "pages 100-200, 300-4000"]
    rows = corpus() + [(1000 + i, f"{sentence(rng)} {s} {sentence(rng)}") for i, (_, s) in enumerate(hidden)] + [(2000 + i, t) for i, t in enumerate(clean)]
    got = {r.doc_id: r for r in personal.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    for i, (kind, s) in enumerate(hidden):
        found = [x.split(":") for x in got[1000 + i].spans.split(",") if x]
        assert found, s
        covered = set()
        for k, a, b in found:
            assert k == kind
            covered |= set(range(int(a), int(b)))
        digits = {j for j, c in enumerate(text[1000 + i]) if c.isdigit()}
        assert kind == "email" or digits <= covered, s
    assert [t for i, t in enumerate(clean) if got[2000 + i].spans] == []
    assert all(got[i].n_added == 0 for i in range(400))


def test_personal_awkward_rows(spark, awkward, empty):
    rows = personal.find(awkward, keep=["doc_id", "score", "n"]).collect()
    assert len(rows) == len(AWKWARD) and {r.score for r in rows} == {"clash"}
    assert personal.find(empty, keep=["doc_id"]).count() == 0
    assert personal.digest(spark.createDataFrame([(1, None), (None, ""), (2, "no data here")], "doc_id long, text string")).where("spans <> ''").count() == 0


def test_redaction_and_likelier_of_overlapping(spark):
    found = personal.find(spark.createDataFrame([("write to a.b@c.de or 10.0.0.1, +1 234 567 8901",)], "text string").withColumn("t", F.col("text")))
    assert found.select(personal.redact(F.col("t"), F.col("spans"))).first()[0] == "write to [email] or [ip], [phone]"
    span = "struct<kind:int,start:int,end:int,span:string,left:string,right:string>"
    scanned = spark.sql(f"SELECT struct(1 AS i) AS keep, CAST(array(named_struct('kind', 0, 'start', 5, 'end', 9, 'span', 'a', 'left', '', 'right', '')) AS array<{span}>) AS base, "
                        f"CAST(array(named_struct('kind', 2, 'start', 0, 'end', 6, 'span', '1', 'left', '', 'right', ''), named_struct('kind', 2, 'start', 20, 'end', 30, 'span', '1', 'left', '', 'right', ''), "
                        f"named_struct('kind', 3, 'start', 25, 'end', 40, 'span', '1', 'left', '', 'right', '')) AS array<{span}>) AS proposed")
    model = personal.Model([0.0, (0, 2, 1.0, 2.0)], (1.0, 0.0), {2: 0.5, 3: 0.5})
    assert [(x.kind, x.start) for x in personal.select(scanned, model).first().spans] == [(0, 5), (3, 25)]


def test_boosted_trees_learn_and_calibrate():
    rng = np.random.default_rng(1)
    f = rng.integers(0, 6, (4000, 5))
    label = (((f[:, 0] > 2) & (f[:, 1] < 3)) | (f[:, 2] == 5)).astype(float)
    noisy = np.where(rng.random(4000) < 0.05, 1 - label, label)
    n = np.ones(4000)
    trees = personal.boost(f[:3000], noisy[:3000], n[:3000])
    margin = sum(personal._margin(t, f) for t in trees)
    assert ((margin > 0) == (label == 1)).mean() > 0.97
    a, b = personal.calibrate(margin[3000:], noisy[3000:], n[3000:])
    p = personal._logistic(a * margin + b)
    assert abs(p[3000:].mean() - noisy[3000:].mean()) < 0.02
    t = personal.threshold(p[3000:], noisy[3000:], n[3000:], 0.9)
    assert noisy[3000:][p[3000:] >= t].mean() >= 0.9
    assert personal.threshold(np.array([0.9, 0.8]), np.array([0.0, 0.0]), np.ones(2)) == 2.0


# --- vector codes ---------------------------------------------------------------

def test_trie_walk_is_nearest(monkeypatch):
    rng = np.random.default_rng(2)
    for leaves in (3, 2048):
        monkeypatch.setattr(vectors, "LEAVES", leaves)
        for width in (1, 2, 4):
            parts = rng.integers(-6, 6, (500, width))
            entries = rng.integers(-6, 6, (17, width))
            rows, back, times = vectors.distinct_parts(parts)
            assert (rows[back] == parts).all() and times.sum() == 500 and len(np.unique(parts, axis=0)) == len(rows)
            at, far = vectors.nearest(rows, entries)
            d = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
            assert (at == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and len(v) and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    cut = [[tuple(int(np.floor(256 * x)) for x in np.array(v, dtype=float)[p * len(v) // parts:(p + 1) * len(v) // parts]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def find(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[find(p, c[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p] == k]
                if mine:
                    books[p][k] = tuple(sum(col) // len(mine) for col in zip(*mine))
    last = [[find(p, c[p]) for p in range(parts)] for c in cut]
    return {i: ("".join(f"{k:02x}" for _, k in x), sum(d for d, _ in x)) for (i, _, _), x in zip(kept, last)}, books


@pytest.mark.parametrize("width", [16, 48])
def test_codes_match_plain_python(spark, width):
    rng = random.Random(width)
    hot = [rng.uniform(-1, 1) for _ in range(width)]
    rows = [(i, hot if i % 3 == 0 else [float(np.float32(rng.gauss(0, 0.4))) for _ in range(width)], None if i % 5 == 0 else i % 2) for i in range(150)]
    rows += [(200, None, 1), (201, [None] + hot[1:], 1), (202, [float("nan")] + hot[1:], 0), (203, [float("inf")] + hot[1:], 0), (204, [], 0), (205, hot[:-1], 0), (206, hot + hot, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5).withColumn("code", F.lit("clash"))
    books = vectors.learn(df)
    want, entries = plain_codes(rows)
    assert [[tuple(e) for e in b] for b in books.tolist()] == entries
    coded = vectors.encode(df, books, ["vec_id", "label", "code"])
    assert {r.vec_id: (r.code, r.error) for r in coded.collect()} == want
    sums = {}
    for i, v, lab in rows:
        if i in want:
            sums[lab] = sums.get(lab, 0) + want[i][1]
    got = vectors.with_label_error(coded).collect()
    assert len(got) == len(want) and all(r.label_error == sums[r.label] for r in got)
    some = list(want)[:5]
    back = vectors.decode([want[i][0] for i in some], books)
    whole = np.floor(256 * np.array([rows[i][1] for i in some])).astype(np.int64)
    assert ((back - whole) ** 2).sum(axis=1).tolist() == [want[i][1] for i in some]


def test_codes_of_few_repeated_and_no_vectors(spark):
    kind = "vec_id long, embedding array<float>, label int"
    none = spark.createDataFrame([(1, None, 0)], kind)
    assert vectors.learn(none) is None and vectors.encode(none, None, ["vec_id"]).columns == ["vec_id", "code", "error"] and vectors.encode(none, None, ["vec_id"]).count() == 0
    twice = spark.createDataFrame([(1, [0.5] * 16, 0), (1, [0.5] * 16, 0), (None, [-0.5] * 16, None)], kind)
    books = vectors.learn(twice)
    assert books.shape == (16, 3, 1) and sorted((r.vec_id or 0, r.code, r.error) for r in vectors.encode(twice, books, ["vec_id"]).collect()) == [
        (0, "02" * 16, 0), (1, "00" * 16, 0), (1, "00" * 16, 0)]


# --- fill-in-the-middle ------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("chunk", [1, 3, 1024])
def test_fill_in_middle_matches_plain_python(spark, monkeypatch, chunk):
    monkeypatch.setattr(infill, "CHUNK", chunk)
    rng = random.Random(4)
    texts = ["", " ", "one", " \n", "a b ", "<P", "x <S> y", "<" * 50, "<S <M <P S> M>" * 3, "é 🙂 　 \x1c \x85 b"]
    texts += ["".join(rng.choice("ab <SPM>é🙂\n\t") for _ in range(rng.randrange(0, 200))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(7, None), (None, "no id at all"), (None, "no id at all"), (5, "the same id"), (5, "the same id"), (9, "w " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).withColumn("form", F.lit("clash"))
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(((i, n, form, p, m, sha(out), sha(t or "")) for i, t in rows for n, form, p, m, out in [plain_infill(i, t)]), key=key)
    assert sorted((tuple(r) for r in infill.digest(df).collect()), key=key) == want
    whole = sorted(((i, *plain_infill(i, t)) for i, t in rows), key=key)
    got = infill.outputs(df).collect()
    assert sorted((tuple(r) for r in got), key=key) == whole
    back = sorted(((r.doc_id, infill.restore(r.output, r.form)) for r in got), key=key)
    assert back == sorted(((i, t or "") for i, t in rows), key=key)


def test_fill_in_middle_awkward_rows(spark, awkward, empty):
    rows = infill.digest(awkward).collect()
    assert sorted((r.restored_sha256 for r in rows)) == sorted(sha(r[1] or "") for r in AWKWARD)
    assert infill.digest(empty).count() == 0 and len(SCHEMA.split(",")) == 5
    assert infill.outputs(awkward, plan=infill.Plan(seed=1, cut_percent=100)).where("form <> 'plain'").count() == sum(1 for r in AWKWARD if r[1])


def test_second_sort_moves_nothing(spark):
    pieces = infill.arranged(spark.createDataFrame([(i, f"some words of {i}") for i in range(50)], "doc_id long, text string"))
    again = infill.restored(pieces)
    assert again.partitioner == pieces.partitioner and again.toDebugString().decode().count("ShuffledRDD") == 1
