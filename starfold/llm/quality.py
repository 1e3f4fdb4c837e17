"""Quality rules by weak supervision.

Rules look at simple figures of a text and vote that it is good (1), vote that
it is bad (-1) or abstain (0). No rule decides alone: expectation-maximisation
estimates from the votes of all documents how often each rule that votes is
right for good and for bad texts, and every text gets the posterior probability
of being good. An abstention says nothing. The votes of k rules have at most 3**k
patterns; the estimation works on the number of documents with each pattern, so
it costs the same at any size of the corpus.

DataFrame functions only; the patterns and their counts are all that reaches
the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import pin

SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"


def figures(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but the text if None) and the figures of each text.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a
    word that equal an earlier line), ``n_repeat_words`` (words in three-word
    windows found twice or more in the text, the first included), ``n_lines``
    (lines with a word), ``n_ends`` (lines that end with punctuation) and
    ``n_letters`` (word characters that are letters). Words are runs of
    characters other than blank and \\t..\\r. A null or empty text has 0 in all.
    Columns with the names of figures are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ends", "n_letters"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names and c != text_col]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # the kept columns travel in a struct, so that no name can clash with the steps below
    rows = docs.select(F.struct(*keep, F.lit(0).alias("_")).alias("_keep"), text.alias("_t"))
    words = F.array_remove(F.split("_t", SPACE + "+"), "")
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = pin(rows.select("_keep", "_t", F.transform(words, lambda w: F.xxhash64(w)).alias("_h"), F.length(F.array_join(words, "")).alias("_wc"),
                           lines.alias("_lines")), "_t", "_h", "_wc", "_lines")
    n = F.size("_h")
    # three-word windows; a text without repeats, which is the usual one, stops at the set of them
    spots = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(spots, lambda i: F.xxhash64(F.get(F.col("_h"), i), F.get(F.col("_h"), i + 1), F.get(F.col("_h"), i + 2)))
    rows = pin(rows.withColumn("_w", windows), "_w")
    placed = F.array_sort(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_p", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), placed))
    rows = pin(rows, "_p")
    again = F.filter(F.col("_p"), lambda x, i: ((i > 0) & (F.get(F.col("_p"), i - 1)["h"] == x["h"]))
                     | ((i < F.size("_p") - 1) & (F.get(F.col("_p"), i + 1)["h"] == x["h"])))
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.sequence(x["i"], x["i"] + 2)))))
    return rows.select(
        *[F.col("_keep")[c].alias(c) for c in keep], n.cast("long").alias("n_words"), F.col("_wc").cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_p").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"[.!?:;\"')\]]\s*$"))).cast("long").alias("n_ends"),
        F.regexp_count("_t", F.lit(r"\p{L}")).cast("long").alias("n_letters"))


def default_rules() -> dict[str, Column]:
    """Votes of each rule, from the figures of ``figures``."""
    words, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    mean = F.col("word_chars") / F.greatest(words, F.lit(1))
    return {
        "length": vote((words >= 100) & (words <= 100_000), words < 50),
        "word_length": vote((mean >= 3) & (mean <= 10), (mean < 2) | (mean > 14)),
        "symbols": vote(F.col("n_symbols") * 100 <= words, F.col("n_symbols") * 10 > words),
        "symbol_share": vote(F.col("n_symbols") * 500 <= chars, F.col("n_symbols") * 20 > chars),
        "repeated_lines": vote(F.col("n_dup_lines") * 20 <= F.col("n_lines"), F.col("n_dup_lines") * 10 > F.col("n_lines") * 3),
        "repeated_words": vote(F.col("n_repeat_words") * 20 <= words, F.col("n_repeat_words") * 10 > words * 3),
        "line_ends": vote(share("n_ends", "n_lines") >= 0.5, share("n_ends", "n_lines") < 0.1),
        "letters": vote(F.col("n_letters") / chars >= 0.9, F.col("n_letters") / chars < 0.8),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """(share of good texts, for each rule {vote: (P(vote | good), P(vote | bad))}, given that it votes) by expectation-maximisation.

    ``patterns`` holds each combination of votes and its number of texts. It
    starts from the belief that a rule that votes is right four times of five;
    a prior belief worth one text of fifty (and ten more) of either kind holds it there
    where the votes say little, and keeps all probabilities off 0 and 1.
    """
    total = sum(n for _, n in patterns)
    k = len(patterns[0][0]) if patterns else 0
    belief = 10 + total / 50
    prior, table = 0.8, [{1: (0.8, 0.2), -1: (0.2, 0.8), 0: (1.0, 1.0)} for _ in range(k)]
    for _ in range(rounds):
        good, sums = 0.0, [{v: [0.0, 0.0] for v in (-1, 0, 1)} for _ in range(k)]
        for p, n in patterns:
            q = posterior(p, prior, table)
            good += n * q
            for j, v in enumerate(p):
                sums[j][v][0] += n * q
                sums[j][v][1] += n * (1 - q)
        new = []
        for s in sums:
            right, wrong = ((s[1][c] + (0.8, 0.2)[c] * belief) / (s[1][c] + s[-1][c] + belief) for c in (0, 1))
            if right < wrong:           # a rule is never taken for the opposite of what it says
                right = wrong = (s[1][0] + s[1][1] + belief / 2) / (s[1][0] + s[1][1] + s[-1][0] + s[-1][1] + belief)
            new.append({1: (right, wrong), -1: (1 - right, 1 - wrong), 0: (1.0, 1.0)})
        moved = max((abs(new[j][1][c] - table[j][1][c]) for j in range(k) for c in (0, 1)), default=0.0)
        prior, table = (good + 0.8 * belief) / (total + belief), new
        if moved < 1e-9:
            break
    return prior, table


def posterior(votes: tuple[int, ...], prior: float, table: list[dict[int, tuple[float, float]]]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(math.log(t[v][0] / t[v][1]) for t, v in zip(table, votes))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def judge(figured: DataFrame, rules: dict[str, Column] | None = None, threshold: float = 0.5) -> DataFrame:
    """``figured`` with ``votes`` (array of -1, 0, 1), ``quality`` (posterior, 0..1) and ``good`` (quality >= threshold).

    A vote of null counts as an abstention. No rows give no rows. Columns with
    the names of the three are replaced.
    """
    rules = default_rules() if rules is None else rules
    votes = F.array(*[F.coalesce(v, F.lit(0)).cast("int") for v in rules.values()])
    voted = figured.drop("votes", "quality", "good").withColumn("votes", votes)
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()      # at most 3**rules rows
    prior, table = estimate([(tuple(r.votes), r.n) for r in counted])
    odds = F.lit(math.log(prior / (1 - prior)))
    for j, t in enumerate(table):
        vote = F.get(F.col("votes"), F.lit(j))
        weight = {v: math.log(g / b) for v, (g, b) in t.items()}
        odds = odds + F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0])
    quality = 1 / (1 + F.exp(-odds))
    return voted.withColumn("quality", quality).withColumn("good", F.col("quality") >= threshold)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
