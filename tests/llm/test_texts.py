"""Tokens, codes, chats, fingerprints and quality against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import AWKWARD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starfold.llm import bpe, chat, codes, fingerprint as fpr, quality


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_by_text(n=60, seed=2):
    rnd = random.Random(seed)
    pool = [*"aAbBeEéÉ '’sStTnN01²½ªº.,!?%$#_-̄́ıßẞΣσςǅ\x1c\x85\xa0 \n\t中文🙂", "the ", "and ", "'ll", "<|endoftext|>", "J̌", "İ"]
    return ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 120))) for _ in range(n)] + [r[1] or "" for r in AWKWARD]


def test_bpe_equals_the_library_and_round_trips(spark):
    texts = rows_by_text()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t = Tokenizer.from_file(bpe.default_vocabulary())
    for r in bpe.digest(df).collect():
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_long_and_short_pieces_merge_alike():
    e = bpe.Encoder(bpe.default_vocabulary())
    rnd = random.Random(4)
    for _ in range(300):
        w = "".join(rnd.choice("thenationsbl") for _ in range(rnd.randint(1, 60))).encode()
        assert e.merge_long(w) == e.merge_many([w])[0]


def test_bpe_on_awkward_rows(awkward, empty):
    out = bpe.decode(bpe.encode(awkward), out="back").select("doc_id", "text", "back", "score", F.length("ids").alias("n")).collect()
    assert len(out) == len(AWKWARD) and all(r.back == (r.text or "") and r.score == "clash" for r in out)
    assert {r.n for r in out if r.doc_id in (2, 3)} == {0}
    assert bpe.digest(empty).count() == 0


def test_codes_give_every_id_by_itself():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        for top in (2, 300, 70_000, 1 << 32):
            ids = rnd.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            c = codes.Codes(codes.pack(ids))
            assert len(c) == n and (c.slice(0, n) == ids).all()
            for i in rnd.integers(0, n, min(n, 40)):
                assert c[int(i)] == ids[i]
            a, b = sorted(rnd.integers(0, n + 1, 2).tolist())
            assert (c.slice(a, b) == ids[a:b]).all()


def test_codes_files_read_back(spark, monkeypatch):
    monkeypatch.setattr(codes, "SHARD", 500)
    texts = rows_by_text(80, 7)
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    folder = codes.fresh_folder(spark)
    codes.write(df, folder, partitions=4)
    t = Tokenizer.from_file(codes.default_vocabulary())
    got, whole, start = {r.doc_id: r for r in codes.digest(spark, folder).collect()}, {r.doc_id: r for r in codes.read(spark, folder).collect()}, 0
    assert codes.shards(spark, folder).count() > 8
    for i, x in enumerate(texts):
        ids = t.encode(x, add_special_tokens=False).ids + [1]
        r = got[3 * i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert whole[3 * i].ids == ids and whole[3 * i].start == start
        start += len(ids)


def test_codes_on_awkward_rows(spark, awkward, empty):
    folder = codes.fresh_folder(spark)
    codes.write(awkward, folder)
    out = codes.digest(spark, folder).collect()
    assert len(out) == len(AWKWARD) and {r.n_tokens for r in out if r.doc_id in (2, 3, 4)} == {1}
    folder = codes.fresh_folder(spark)
    codes.write(empty, folder)
    assert codes.digest(spark, folder).count() == 0


def test_chat_reads_back_exactly(spark):
    odd = ["", None, "a<|end|>b", "\\", "\\\\<|", "<\\|turn|>", "<", "|", "<|body|>\\", "\\<\\|", "x\n<|role|>y"]
    rnd = random.Random(3)
    turns = [(c, t, rnd.choice(["user", "assistant", "sys<|body|>tem", None]), rnd.choice(odd)) for c in range(40) for t in range(rnd.randint(1, 9))]
    turns += [(99, 1, "user", "same"), (99, 1, "user", "same"), (99, 1, "assistant", "tie"), (None, 0, "user", "no key")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.digest(formatted).collect()}
    text = {r.conv_id: r.formatted for r in formatted.collect()}
    spans: dict = {}
    for r in chat.loss_spans(formatted).collect():
        spans.setdefault(r.conv_id, []).append((r.start, r.end))
    for c in {t[0] for t in turns}:
        mine = sorted((t[1], t[2] or "", t[3] or "") for t in turns if t[0] == c)
        loss = "".join(x for _, r, x in mine if r == "assistant")
        flat = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        g = got[c]
        assert (g.n_turns, g.loss_chars, g.formatted_chars) == (len(mine), len(loss), len(text[c]))
        assert g.turns_sha256 == hashlib.sha256(flat.encode()).hexdigest() and g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        cut = "".join(text[c][a:b] for a, b in sorted(spans.get(c, [])))
        assert len(cut) >= len(loss) and (len(cut) == len(loss) or "\\" in cut)
        assert text[c].count("<|role|>") == sum(1 for i, x in enumerate(mine) if i == 0 or mine[i - 1][1] != x[1])
    assert chat.digest(chat.format_conversations(df.where("conv_id = -5"))).count() == 0


def test_fingerprints_of_neighbours(spark, awkward, empty):
    rnd = random.Random(5)
    lines = [" ".join(rnd.choice("abcdefghij") * 3 for _ in range(6)) + "." for _ in range(400)]
    texts = ["\n".join(rnd.sample(lines, rnd.randint(1, 30))) for _ in range(40)] + [None, "", "one"]
    df = spark.createDataFrame([(i * 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in fpr.compare_with_next(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        m = len(t) // 2
        e = t[:len(t) - m] + nxt[:m]
        r = got[7 * i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (Counter(t.split("\n")) == Counter(e.split("\n")))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    long = [got[7 * i] for i, t in enumerate(texts[:40]) if t and len(t) > 300]
    assert sum(r.near_edited for r in long) > 2 * sum(r.near_next for r in long)
    out = fpr.compare_with_next(awkward).collect()
    assert len(out) == len(AWKWARD) and len({r.fingerprint for r in out if r.doc_id in (1, 5)}) == 1
    assert fpr.compare_with_next(empty).count() == 0 and fpr.compare_with_next(df.limit(1)).count() == 1


def test_texts_without_punctuation_are_compared_in_part(spark):
    rnd = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(30):
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(60)]
        other = list(words)
        at = rnd.randrange(60)
        if k % 3 == 0:
            other[at] = "changed"
        elif k % 3 == 1:
            other.insert(at, "inserted")
        else:
            del other[at]
        rows += [" ".join(words), " ".join(other)]
    han = "".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(200))
    rows += [han, han[:90] + "\u6587" + han[91:]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.near_next for r in fpr.compare_with_next(df).collect()}
    alike, unlike = [got[i] for i in range(0, 62, 2)], [got[i] for i in range(1, 61, 2)]
    assert min(alike) >= 0.75 and sum(alike) / len(alike) >= 0.85 and max(unlike) < 0.5


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([(1, "a, b\nc"), (2, "d.\ne"), (3, "e\na, b\nd.\nc"), (4, "c\na, b")], "doc_id long, text string")
    f = {r.doc_id: r for r in fpr.fingerprint_lanes(df, ["doc_id"], "text").collect()}
    one = spark.createDataFrame([tuple(f[1])[1:] + tuple(f[2])[1:] + tuple(f[3])[1:]], [f"{p}{n}" for p in "abc" for n in fpr.NAMES])
    a, b, c = ({n: F.col(f"{p}{n}") for n in fpr.NAMES} for p in "abc")
    r = one.select((fpr.encode(fpr.insert(a, b)) == fpr.encode(c)).alias("sum"), (fpr.encode(fpr.delete(c, b)) == fpr.encode(a)).alias("rest")).first()
    assert r.sum and r.rest
    assert tuple(f[4])[1:] == tuple(f[1])[1:]


def test_quality_figures(spark, awkward, empty):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["a", "b", "c#", "d\n", "\t", "e$%", "f"]) for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    texts += [r[1] or "" for r in AWKWARD]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.figures(df).collect():
        x = texts[r.doc_id]
        w = WORD.findall(x)
        lines = [v for v in x.split("\n") if WORD.search(v)]
        tri = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(hit))
    out = quality.judge(quality.figures(awkward)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.quality <= 1 for r in out)
    assert quality.judge(quality.figures(empty)).count() == 0


def test_estimation_finds_the_rules_accuracies():
    rnd = random.Random(8)
    right, counts = [0.95, 0.9, 0.8, 0.7, 0.85], Counter()
    truth = []
    for _ in range(20_000):
        good = rnd.random() < 0.7
        votes = tuple(0 if rnd.random() < 0.3 else (1 if (rnd.random() < p) == good else -1) for p in right)
        counts[votes] += 1
        truth.append((good, votes))
    prior, table = quality.estimate(sorted(counts.items()))
    assert abs(prior - 0.7) < 0.05
    for p, t in zip(right, table):
        assert abs(t[1][0] - p) < 0.05 and abs(t[-1][1] - p) < 0.06
    hits = sum((quality.posterior(v, prior, table) >= 0.5) == g for g, v in truth)
    assert hits > 0.9 * len(truth)


@pytest.mark.parametrize("n", [1, 2])
def test_a_few_votes_do_no_harm(n):
    prior, table = quality.estimate([((1, 0), n)])
    assert 0 < prior < 1 and quality.posterior((1, 0), prior, table) > 0.5
