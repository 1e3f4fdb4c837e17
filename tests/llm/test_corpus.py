"""Joins, mixing, scans and learned filters against plain Python, and the pipeline as a whole."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import AWKWARD
from pyspark.sql import functions as F

import corpus_pipeline
from starfold.llm import langid, licenses, links, mixing, ngram_join, toxicity
from starfold.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_classes(rows, percent=80):
    sets, inv = {}, defaultdict(list)
    for i, x in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in x or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        for s in sets[i]:
            inv[s].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in inv[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed=1):
    """Families of near copies with edits around the threshold, chains, shared passages and very common words."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [rnd.choice(vocabulary) for _ in range(25)]
    texts = []
    for _ in range(14):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 90))]
        for _ in range(rnd.randint(1, 14)):
            t = list(base)
            for _ in range(rnd.randint(0, 3)):
                t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                t = t[:-2] + passage
            base = t if rnd.random() < 0.5 else base
            texts.append(" ".join(t))
    texts += ["", None, "a b", "A B", "a  b\tc", "a a a a a a a a", *texts[:5], "of the " * 60]
    return list(enumerate(texts))


@pytest.mark.parametrize("circle", [4_000_000, 150])
def test_join_classes_equal_brute_force(spark, circle):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df, circle=circle).collect()}
    assert got == brute_classes(rows)


def templates(n, common, own, shared, seed=2):
    """Documents of one boilerplate, each with words of its own and a passage that two have."""
    rnd = random.Random(seed)
    base, out = [f"b{k}" for k in range(common)], []
    for i in range(n):
        passage = [f"p{i // 2}x{k}" for k in range(shared)]
        out.append(" ".join(base + passage + [f"o{i}x{k}" for k in range(own + rnd.randint(0, 3))]))
    return list(enumerate(out))


@pytest.mark.parametrize("circle", [4_000_000, 1000])
def test_join_of_templates_equals_brute_force_without_all_pairs(spark, monkeypatch, circle):
    rows = templates(60, 104, 20, 0) + [(1000 + i, t) for i, t in templates(60, 104, 8, 12, 3)] + [(2000 + i, t) for i, t in templates(40, 104, 6, 0, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df, circle=circle).collect()}
    assert got == brute_classes(rows)


def test_templates_are_not_compared_all_with_all(spark):
    df = spark.createDataFrame(templates(300, 104, 20, 0), "doc_id long, text string")
    circles = []
    real = ngram_join._split_large
    try:
        ngram_join._split_large = lambda c, *rest: (circles.append(c.count()), real(c, *rest))[1]
        ngram_join.jaccard_classes(df).count()
    finally:
        ngram_join._split_large = real
    assert circles == [0]


def test_blocks_meet_in_every_pair_once(spark):
    rows = [(1, k, 2) for k in range(40)] + [(2, k, k % 2) for k in range(30)]
    df = spark.createDataFrame(rows, "circle long, fp long, side int").withColumns({"shingles": F.lit(400), "members": F.lit(1)})
    parts, met = defaultdict(list), Counter()
    for r in ngram_join._block_pairs(df, 150, 1 << 40).collect():
        parts[r.circle].append((r.fp, r.side))
    for part in parts.values():
        met.update((min(a, b), max(a, b)) for k, (a, s) in enumerate(part) for b, z in part[:k] if s == 2 or s != z)
    want = Counter((a, b) for b in range(40) for a in range(b)) + Counter((a, b) for b in range(30) for a in range(b) if a % 2 != b % 2)
    assert met == want


@pytest.mark.parametrize("few", [0, 3, 1000])
def test_counting_at_once_equals_comparing_one_by_one(spark, monkeypatch, few):
    rows = near_copies(7) + [(5000 + i, t) for i, t in templates(50, 104, 8, 12, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ngram_join, "FEW", few)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df, circle=400 if few else 4_000_000, work=20_000).collect()}
    assert got == brute_classes(rows)


def test_thousands_of_unlike_members_of_one_circle():
    import pyarrow as pa

    rnd, lead, count = np.random.default_rng(4), np.arange(1, 4, dtype=np.uint64), 8000
    sets = [np.sort(np.concatenate([lead, rnd.choice(np.arange(10, 40_000, dtype=np.uint64), 9, replace=False)])) for _ in range(count)]
    sets[4000:4005] = [sets[17]] * 4 + [np.sort(np.concatenate([sets[18][:11], np.array([50_000], np.uint64)]))]
    table = pa.table({"fp": np.arange(count), "n": np.full(count, 12), "side": np.full(count, 2), "toks": [x.tobytes() for x in sets],
                      "prefix": [lead.tobytes()] * count, "lead": np.full(count, 2)})
    out = ngram_join._verify(80)((), table)
    assert set(zip(out["a"].to_pylist(), out["b"].to_pylist())) == {(17, 4000 + k) for k in range(4)} | {(18, 4004)}


def test_join_with_frequent_shingles_listed(spark, monkeypatch):
    rows = near_copies(3)
    real, seen = ngram_join._deal, []

    def deal(docs, width, buckets, hot):
        # every third shingle of the first text counts as very frequent
        s = np.sort(ngram_join.shingle_sets(__import__("pyarrow").array([rows[0][1]]), width)[0] >> np.uint64(16))[::3]
        seen.append(len(s))
        return real(docs, width, buckets, (s.tobytes(), np.full(len(s), 77, np.uint8).tobytes()))

    monkeypatch.setattr(ngram_join, "_deal", deal)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df).collect()}
    assert seen[0] > 3 and got == brute_classes(rows)


def test_join_on_awkward_rows(awkward, empty):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(awkward).collect())
    assert got[5, got_n(got, 5), 1] == 2 and got[2, 0, 2] == got[3, 0, 3] == got[4, 0, 4] == 1
    assert got[6, 1, 6] == got[7, 1, 6] == 1 and got[8, 1, 8] == 1 and sum(got.values()) == len(AWKWARD)
    assert ngram_join.jaccard_classes(empty).count() == 0


def got_n(got, doc):
    return next(n for d, n, _ in got if d == doc)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 301), (301, 300), (None, 3)]
    got = {r.node: r.root for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 300: 300, 301: 300}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_targets(sizes, weights, share=1.5, most=2.0):
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(weights[s] for s in sizes if s not in full)
        t = {s: most * sizes[s] if s in full else left * weights[s] / free for s in sizes}
        more = {s for s in sizes if s not in full and t[s] >= most * sizes[s]}
        if not more:
            return t
        full |= more


def test_mix_meets_its_targets(spark):
    rnd = random.Random(4)
    rows = [(i, "w " * rnd.randint(0, 40), rnd.choice(["a", "B", "c", "é", None, "hot", "hot", "hot", "hot", "hot"])) for i in range(400)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.line_up(df).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.line_up(df.repartition(3)).collect()), key=str)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = brute_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
    for s in sizes:
        assert int(want[s] + 1e-9) == taken[s]


def test_curriculum_follows_its_schedule(spark):
    rows = [(i, "w " * 10, s) for i in range(300) for s in ("early", "even")]
    df = spark.createDataFrame([(k, t, s) for k, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    steps = {"early": [(0.0, 3.0), (0.25, 1.0), (0.75, 0.0)]}
    weights = spark.createDataFrame([("early", 1.0), ("even", 1.25)], "source string, weight double")
    lined = mixing.line_up(df, weights=weights, schedules=steps, share=0.8)
    out = mixing.in_training_order(mixing.schedule(lined, steps)).collect()
    pos = [r.position for r in out]
    assert pos == sorted(pos) and sum(r.taken for r in out) in range(4798, 4801)
    early = np.array([r.position for r in out if r.source == "early"])
    # 3 * 0.25 of 1.25 in the first quarter, 1 * 0.5 of 1.25 until three quarters, nothing after
    assert abs((early < 0.25).mean() - 0.6) < 0.02 and early.max() <= 0.75
    even = np.array([r.position for r in out if r.source == "even"])
    assert abs((even < 0.25).mean() - 0.25) < 0.02


def test_mix_on_awkward_rows(awkward, empty):
    out = mixing.line_up(awkward).collect()
    assert len(out) == len(AWKWARD) and sum(r.taken for r in out) > 0
    assert mixing.line_up(empty).count() == 0 and mixing.schedule(mixing.line_up(empty)).count() == 0


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b):
            old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_alignment_is_in_order_and_near_the_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(200):
        b = [f"u{k}" for k in rnd.sample(range(40), rnd.randint(1, 25))]
        a = [x for x in b if rnd.random() < 0.85]
        for _ in range(rnd.randint(0, 6)):
            a.insert(rnd.randint(0, len(a)), f"n{rnd.randint(0, 5)}")
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) == longest_common(a, b)          # words are unique, so anchors find all


def test_notices_are_found_where_they_are(spark, awkward, empty):
    rnd = random.Random(1)
    junk = lambda n: " ".join(rnd.choice(["the", "of", "license", "a", "and", "software", "zeta"]) for _ in range(n))
    mit, gpl = licenses.NOTICES["MIT"], licenses.NOTICES["GPL-3.0-notice"]
    worn = " ".join(w for k, w in enumerate(mit.split()) if k % 12)
    rows = [(1, f"{junk(50)}\n{gpl}\n{junk(50)}"), (2, f"{junk(3000)} {mit.upper()} {junk(3000)}"), (3, junk(500)), (4, worn),
            (5, f"{gpl} {gpl}\n{junk(10)} {gpl}"), (6, None)]
    out = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r.doc_id, r.license): r for r in out}
    assert found[1, "GPL-3.0-notice"].coverage == 1 and rows[0][1][found[1, "GPL-3.0-notice"].start:found[1, "GPL-3.0-notice"].end] == gpl.rstrip(".")
    r = found[2, "MIT"]
    assert r.coverage > 0.99 and abs(r.end - r.start - len(mit)) < 40
    assert 0.85 < found[4, "MIT"].coverage < 1
    assert sum(x.doc_id == 5 for x in out) == 3 and not any(x.doc_id in (3, 6) for x in out)
    assert licenses.find_licenses(awkward).count() == 0 and licenses.find_licenses(empty).count() == 0


def test_notices_with_exactly_the_least_coverage_are_found():
    split = {k: licenses.words(v)[0] for k, v in licenses.NOTICES.items()}
    for name, notice in split.items():
        for gone in range(len(notice)):
            need = -(-4 * len(notice) // 5)
            left = [w for k, w in enumerate(notice) if (k - gone) % len(notice) >= len(notice) - need]
            assert len(left) == need and name in {n for n, *_ in licenses.scan("zeta " + " ".join(left), split)}
    assert [n for n, *_ in licenses.scan("Published under the MIT License. Licensed under CC-BY NC 4.0", split)] == ["MIT-notice"]


@pytest.mark.parametrize("shift", range(12))
def test_loose_copies_in_long_stretches_are_found(shift):
    notice = [f"u{k}" for k in range(20)]
    loose = [w for k, w in enumerate(notice[2:18]) for w in ([w, "zeta"] if k % 2 else [w])][:-1]
    loose[1:1] = ["zeta"] * 6                     # 16 words within 29, the width is 30
    text = notice * 3 + ["zeta"] * shift + loose + ["zeta"] * 3 + notice * 2
    finds = licenses.scan(" ".join(text), {"n": notice})
    assert len(finds) == 6 and [c for _, c, *_ in finds] == [1, 1, 1, 0.8, 1, 1]


def toxic_corpus(spark, n=600):
    rnd = random.Random(9)
    syllables = ["ta", "ren", "li", "so", "mon", "ker", "del", "ane", "ori", "est", "un", "pa"]
    bad = ["wretchling", "snivelgob", "mudbrain"]
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(30, 120))]
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_and_sees_through_disguise(spark, awkward):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    y = {r.doc_id: r.toxic for r in labels.collect()}
    out = toxicity.score(docs, model).collect()
    held = [r for r in out if r.doc_id % 5 == 0]
    assert np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.95
    hidden = ["wr3tchl1ng ta ren snive1g0b li so mudbra1n " + "taren liso " * 20, "w r e t c h l i n g " + "mon ker " * 20 + "s.n.i.v.e.l.g.o.b mudbraaaain",
              "tamon kerdel 1000 m2 r2d2 so1 " + "taren liso " * 20]
    got = toxicity.score(spark.createDataFrame(list(enumerate(hidden)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.predicted for r in got] == [1, 1, 0]
    out = toxicity.score(awkward, model).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out) and "n_words" in out[0]


def test_toxicity_without_labels(spark, empty):
    docs, labels = toxic_corpus(spark, 30)
    for some, p in ((labels.where("false"), 0), (labels.where("toxic = 1"), 1), (labels.where("toxic = 0"), 0)):
        assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, some)).collect()} == {p}
    twice = labels.union(labels).union(spark.createDataFrame([(1, None), (None, 1)], labels.schema))
    model = toxicity.fit(docs, twice)
    assert toxicity.score(empty, model).count() == 0 and toxicity.fit(empty, labels) is not None


def test_viterbi_takes_the_best_path():
    rnd = np.random.default_rng(0)
    p = np.log(rnd.dirichlet(np.ones(toxicity.RADIX), (toxicity.RADIX, toxicity.RADIX))).astype(np.float32)
    d = toxicity.Decoder(p)

    def cost(choice):
        a, b, s = 0, 0, 0.0
        for text, c in choice:
            s -= c
            for x in text:
                z = d.table.get(x, toxicity.RADIX - 1 if x.isalpha() else 0)
                s += float(p[a, b, z]) - (0.0 if z else 4.0)
                a, b = b, z
        return s + float(p[a, b, 0])

    import itertools
    for token in ("1d10t", "h3ll0", "a4aaa5", "$1", "t00oo1"):
        every = list(itertools.product(*d.lattice(token)))
        best = max(every, key=cost)
        assert abs(cost(best) - max(cost(c) for c in every if "".join(t for t, _ in c) == d.restore(token))) < 1e-4


def word_model(word):
    """A trigram model that has seen one word only."""
    s = [0, *(toxicity.SYMBOLS.index(c) + 1 for c in word), 0, 0]
    counts = np.zeros((toxicity.RADIX,) * 3)
    for a, b, c in zip([0, *s], s, s[1:]):
        counts[a, b, c] += 1000
    return toxicity.log_probabilities(counts.ravel())


@pytest.mark.parametrize("gap", [" ", ".", "  ", ". "])
@pytest.mark.parametrize("n", [25, 60, 5000])
def test_tokens_of_any_length_are_restored_as_one(gap, n):
    d, word = toxicity.Decoder(word_model("snivel")), ("snivelgob" * n)[:n]
    assert toxicity.restored(gap.join(word), d) == word
    # choices far apart and back pointers over the whole token
    assert d.restore("sn1vel" * n) == "snivel" * n
    assert "snivel" in d.restore(gap.join("x" * 70 + "sn1vel"))


def test_the_gate_lets_through_all_that_the_pattern_matches():
    rnd = random.Random(5)
    texts = ["s. n. i. v. e. l.", "s  n  i  v  e  l", "1 d 1 0 t", "a$$", "idio7", "hat3", "x\u00b25", "so long!", "mudbraaain", "\U0001d41a1", "a b c d", "", "a", "0 .. "]
    texts += ["".join(rnd.choice("aab10!$.. -_*\u00e9\u00b22\0") for _ in range(rnd.randint(1, 14))) for _ in range(20000)]
    points, at = toxicity.code_points(texts)
    passed = set(toxicity._hints(points, at).tolist())
    matched = {i for i, t in enumerate(texts) if toxicity._SUSPECT.search(t)}
    assert set(range(11)) <= matched <= passed and not {11, 12} & passed


def test_words_disguised_at_their_end_are_restored():
    for token, word in (("idio7", "idiot"), ("hat3", "hate"), ("a$$", "ass"), ("s. n. i. v. 3. l", "snivel"), ("5n1v3  l", "snive")):
        assert toxicity.restored(f"so {token} so", toxicity.Decoder(word_model(word))).split("\n") == [word]
    # an exclamation mark is no letter, and what is as written counts once
    assert toxicity.restored("snivel! snivel!!", toxicity.Decoder(word_model("snivel"))) == ""


def test_language_id_learns_and_rejects(spark, awkward, empty):
    rnd = random.Random(3)
    words = {"aa": ["bada", "gode", "mibu"], "bb": ["xirk", "zolt", "vrekk"], "cc": ["éluë", "ñoçe", "àmî"]}
    rows = [(i, " ".join(rnd.choice(words[k]) for _ in range(rnd.randint(3, 40))), k) for i, k in enumerate(list(words) * 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df.where("doc_id % 4 <> 1"))
    out = langid.predict(df.where("doc_id % 4 = 1"), model, keep=["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.98 and np.mean([r.rejected for r in out]) < 0.02
    got = {r.doc_id: r for r in langid.predict(awkward, model).collect()}
    assert len(got) == len({r[0] for r in AWKWARD}) and all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (2, 3, 4))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(empty, model).count() == 0 and langid.fit(empty) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}
    one = langid.fit(df.where("lang = 'aa'"))
    assert {r.lang_pred for r in langid.predict(df, one).collect()} == {"aa"}


def test_copies_do_not_fill_the_language_sample(spark, monkeypatch):
    hot = [(f"the same old text {k}", "en") for k in range(3)]
    rows = [(f"word{k} and some other words {k * 7}", "en") for k in range(200)] + [(f"mot{k} et quelques autres mots {k * 5}", "fr") for k in range(200)]
    df = spark.createDataFrame(rows + hot * 3000, "text string, lang string").repartition(4)
    seen = []
    monkeypatch.setattr(langid, "train", lambda bags, labels, languages: seen.append(labels))
    langid.fit(df, fit_rows=100_000)
    assert 395 <= len(seen[0]) <= 403 and abs(np.bincount(seen[0])[0] - 203) <= 4
    langid.fit(df, fit_rows=100)
    assert 60 <= len(seen[1]) <= 140


def test_every_operator_has_one_query_and_oracles_have_queries():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_oracles(spark):
    import duckdb
    data, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, data)
        rel = con.execute(sql)
        at = [[d[0] for d in rel.description].index(c) for c in df.columns]
        assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in rel.fetchall())


def test_pipeline(spark):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    frames = {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = frames[name] = stage(spark, rows, data).cache()
        if name != "bpe_encoding":
            assert rows.columns == corpus_pipeline.COLUMNS
    ids = {n: {r.doc_id for r in f.select("doc_id").collect()} for n, f in frames.items()}
    assert ids["language_id"] <= ids["toxicity"] < {r.doc_id for r in docs.collect()}
    before = [(r.doc_id, r.text) for r in frames["language_id"].select("doc_id", "text").collect()]
    want = brute_classes(before)
    assert ids["ngram_jaccard_join"] == {c for _, c in want.values()} and frames["ngram_jaccard_join"].count() == len(ids["ngram_jaccard_join"])
    mixed = frames["source_mixing"].select("doc_id", F.regexp_count("text", F.lit(mixing.WORD)).alias("n")).groupBy("doc_id").agg(F.sum("n").alias("n")).collect()
    line = {r.doc_id: r.taken for r in mixing.line_up(frames["ngram_jaccard_join"]).collect()}
    assert {r.doc_id: r.n for r in mixed} == {d: n for d, n in line.items() if n}
    assert frames["bpe_encoding"].count() == frames["source_mixing"].count()
    assert corpus_pipeline.run(spark, data).count() == frames["bpe_encoding"].count()


def test_pipeline_stages_on_awkward_rows(spark, awkward, empty, tmp_path):
    labels = [(1, 1), (5, 1), (6, 0), (7, 0), (8, None), (None, 1)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.count() == len(out.collect()) <= 2 * len(AWKWARD)
    kept = corpus_pipeline.drop_near_duplicates(spark, awkward, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 3, 4, 6, 8, 9, 10]


def test_positions_invert_the_integrated_schedule(spark):
    from pyspark.sql import functions as F
    from starfold.llm import mixing
    kind = "array<struct<start:double,weight:double>>"
    cases = [([(0.0, 2.0), (0.25, 0.0), (0.5, 1.0)], 0), ([(0.0, 1.0)], 1), ([(0.0, 0.0), (0.5, 0.0)], 2), ([(0.0, float("nan")), (0.5, 1.0)], 3), ([(0.0, -1.0), (0.2, 1.0), (0.6, 3.0)], 4), ([], 5), (None, 6)]
    df = spark.createDataFrame(cases, f"schedule {kind}, k int").withColumn("u", F.explode(F.array(*[F.lit(x / 20) for x in range(21)])))

    def plain(steps, u):
        ends = [a for a, _ in steps[1:]] + [1.0]
        parts = [(a, w if w > 0 else 0.0, (w if w > 0 else 0.0) * (b - a)) for (a, w), b in zip(steps, ends)]
        total, done, out = sum(p[2] for p in parts), 0.0, None
        for a, w, area in parts:
            if area > 0 and u * total >= done:
                out = a + (u * total - done) / w
            done += area
        return None if out is None else min(out, 1.0)

    for r in df.select("k", "u", mixing.time_of_share(F.col("schedule"), F.col("u")).alias("t")).collect():
        want = plain(cases[r.k][0] or [], r.u)
        assert (r.t is None) == (want is None) and (want is None or abs(r.t - want) < 1e-12)
    assert {r.k for r in df.select("k", mixing.time_of_share(F.col("schedule"), F.col("u")).alias("t")).where("t IS NULL").collect()} == {2, 5, 6}


def test_curriculum_is_range_sorted(spark, awkward, empty):
    from pyspark.sql import functions as F
    from starfold.llm import mixing
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"))
    rows = mixing.curriculum(mixing.line_up(docs)).collect()
    times = [r.position for r in rows if r.position is not None]
    assert len(rows) == 300 and times == sorted(times) and all(0 <= t <= 1 for t in times) and all((r.position is None) == (r.taken == 0) for r in rows)
    # a source whose schedule is early is ahead of an even one, a late one behind
    ahead = {k: [r.place / r.target - r.position for r in rows if r.position is not None and r.source == f"s{k}"] for k in range(3)}
    assert min(ahead[0]) >= 0 < max(ahead[0]) and max(map(abs, ahead[1])) < 1e-12 and max(ahead[2]) <= 0 > min(ahead[2])
    assert mixing.curriculum(mixing.line_up(awkward)).count() == awkward.count() and mixing.curriculum(mixing.line_up(empty)).count() == 0


def test_near_duplicates_with_repeated_and_missing_ids(spark, tmp_path):
    def text(name, *changed):
        return " ".join(f"{name}{i}" for i in range(60)) + "".join(f" {c}" for c in changed)

    rows = [(3, text("z")), (3, text("a")), (4, text("z", "end")),             # two texts under one id; one has a near copy
            (-7, text("m")), (7, text("m", "end")),                            # ids below zero come first
            (9, text("q")), (None, text("q", "end")),                          # a near copy without an id
            (None, text("c")), (None, text("c", "end")), (None, text("c")),    # a group without ids
            (5, text("e")), (5, text("e")), (5, text("e", "end")), (6, None), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()]
    plain = [(i, t) for i, t in kept if i not in (None, 5)]
    assert sorted(plain, key=str) == sorted([(3, text("z")), (3, text("a")), (-7, text("m")), (9, text("q")), (6, None)], key=str)
    assert [t in (text("e"), text("e", "end")) for i, t in kept if i == 5] == [True]
    assert [t in (text("c"), text("c", "end")) for i, t in kept if i is None] == [True]
