"""Document fingerprints: a homomorphic multiset hash of the paragraphs.

Every paragraph (a line of the text) is hashed to a wide vector of 64-bit
integers, and a document's fingerprint is the sum of its paragraphs' vectors,
lane by lane modulo 2**64. So the order of paragraphs doesn't matter, equal
multisets have equal fingerprints, and a paragraph is inserted or deleted by
adding or subtracting its vector (``insert``, ``delete``).

Of the lanes, ``STRONG`` hold uniform hashes of the paragraph: two documents with
different multisets agree in all of them with a chance of 2**-256. The others
measure likeness. They are split into two fields of 32 bits; a paragraph's
field is the number of its clauses whose hash has the field's bit set. Clauses
end at punctuation of any script. A clause of more than ``LONG_CLAUSE``
characters also ends at blanks behind a word that ends in one of certain letters
or digits (in any letter of a script other than ASCII's), so a paragraph without
punctuation falls into runs of a few words; a changed, inserted or missing word
moves no other run's borders. Han texts without blanks
are cut in the same way behind some of their characters, other scripts without
blanks at punctuation only. Twice the field less the number of clauses is a sum of
random signs, so the squared difference of two documents over all fields
estimates in how many clauses they differ.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

STRONG = 4
SOFT = 32                      # lanes for likeness, two fields each
FIELDS = 2 * SOFT
_BLANK = r"[\x20\x09-\x0D]"
_CLAUSE = rf"[.,;:!?|[\p{{Po}}&&[^\x00-\x7F]]]+{_BLANK}*"
LONG_CLAUSE = 120              # characters; a longer clause is cut into runs of a few words
_RUN = (rf"(?<=[bdhjlmnprtvxyzBDHJLMNPRTVXYZ0-4[^\x00-\x7F]]){_BLANK}+"
        r"|(?<=[\u3040-\u30FF\u4E00-\u5FFF])(?=[\u4E00-\u9FFF])")


def _clauses(paragraph: Column) -> Column:
    parts = F.array_remove(F.split(paragraph, _CLAUSE), "")
    runs = F.flatten(F.transform(parts, lambda c: F.when(F.length(c) > LONG_CLAUSE, F.split(c, _RUN)).otherwise(F.array(c))))
    return F.when(F.length(paragraph) > LONG_CLAUSE, F.array_remove(runs, "")).otherwise(parts)


def _lanes(paragraph: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), paragraph) for seed in range(STRONG)]


def _fields(bits: Column, lane: int) -> Column:
    """Two bits of a hash, each in a field of 32 bits of its own."""
    low = F.shiftrightunsigned(bits, 2 * lane).bitwiseAND(F.lit(1).cast("long"))
    return low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(bits, 2 * lane + 1).bitwiseAND(F.lit(1).cast("long")), 32))


def _sum(c: Column) -> Column:
    """Sum modulo 2**64, also under ANSI mode, where a plain sum of longs would raise an error: high and low halves apart."""
    low, high = F.sum(c.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(c, 32))
    return F.struct(low.alias("low"), high.alias("high"))


def _wrap(s: Column) -> Column:
    high = s["high"] + F.shiftright(s["low"], 32)
    return F.shiftleft(high, 32).bitwiseOR(s["low"].bitwiseAND(F.lit(0xFFFFFFFF)))


NAMES = [f"s{i}" for i in range(STRONG)] + [f"f{i}" for i in range(SOFT)] + ["clauses"]


def fingerprint_lanes(texts: DataFrame, keys: list[str], text_col: str, count_empty: bool = True) -> DataFrame:
    """One row for each key: the lanes ``NAMES`` of its text; ``clauses`` is the number of clauses.

    Keys must be unique. A null text is an empty one. Every text has at least
    one paragraph (an empty one if the text is empty), which counts as any other.
    """
    lines = texts.select(*keys, F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("_p"))
    lines = lines.select(*keys, "_p", F.posexplode_outer(_clauses(F.col("_p"))).alias("_i", "_c"))
    # the paragraph's own lanes count once, at its first clause (or at the only row of a paragraph without any)
    first = F.coalesce(F.col("_i"), F.lit(0)) == 0
    bits = F.xxhash64(F.lit(STRONG), "_c")
    rows = lines.select(*keys, F.when(first, F.col("_p")).alias("_p"), F.when(F.col("_c").isNotNull(), bits).alias("_b"))
    rows = rows.select(*keys, "_b", *[F.when(F.col("_p").isNotNull(), lane).otherwise(F.lit(0).cast("long")).alias(f"s{i}")
                                      for i, lane in enumerate(_lanes(F.col("_p")))])
    soft = [F.coalesce(F.sum(_fields(F.col("_b"), i)), F.lit(0)).cast("long").alias(f"f{i}") for i in range(SOFT)]
    summed = rows.groupBy(*keys).agg(*[_sum(F.col(f"s{i}")).alias(f"s{i}") for i in range(STRONG)], *soft, F.count("_b").alias("clauses"))
    return summed.select(*keys, *[_wrap(F.col(f"s{i}")).alias(f"s{i}") for i in range(STRONG)], *NAMES[STRONG:])


def encode(lanes: dict[str, Column]) -> Column:
    """The fingerprint as text: all lanes in hex, 16 digits each, so 'equal' is equality of strings."""
    return F.concat(*[F.lpad(F.lower(F.hex(lanes[n])), 16, "0") for n in NAMES])


def _add(a: Column, b: Column, sign: int) -> Column:
    """a + b or a - b modulo 2**64, in halves, so that no step overflows."""
    mask = F.lit(0xFFFFFFFF)
    low = a.bitwiseAND(mask) + sign * b.bitwiseAND(mask)
    high = F.shiftright(a, 32) + sign * F.shiftright(b, 32) + F.shiftright(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(mask))


def insert(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Lanes of a document with the paragraphs of both."""
    return {n: _add(a[n], b[n], 1) for n in NAMES}


def delete(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Lanes of ``a`` without the paragraphs of ``b``."""
    return {n: _add(a[n], b[n], -1) for n in NAMES}


def likeness(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """0 to 1: estimated share of clauses that two documents have in common (Jaccard index of multisets).

    1 for equal fingerprints; estimates from 64 signs vary by about a tenth
    for unlike documents and less the more alike they are.
    """
    distance = F.lit(0.0)
    for i in range(SOFT):
        for k in range(2):
            x, y = (F.shiftrightunsigned(d[f"f{i}"], 32 * k).bitwiseAND(F.lit(0xFFFFFFFF)) for d in (a, b))
            distance = distance + F.pow(((2 * x - a["clauses"]) - (2 * y - b["clauses"])).cast("double"), 2)
    apart = distance / FIELDS                                         # clauses in one of the two only
    together = (a["clauses"] + b["clauses"]).cast("double")
    return F.when(_equal(a, b), 1.0).when(together == 0, 0.0).otherwise(F.greatest((together - apart) / (together + apart), F.lit(0.0)))


def _equal(a: dict[str, Column], b: dict[str, Column]) -> Column:
    out = F.lit(True)
    for n in NAMES:
        out = out & (a[n] == b[n])
    return out


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_part, _row, id, text, _guest, _next): rows in ascending id order within range partitions, each with the next row's text.

    Ties go by text. Rows are range-partitioned by id, so equal ids and hot
    values of other columns make no large task. The first row of each
    partition is added to the end of the partition before as a guest, so that
    the last row has a next one too; the first of all is the guest of the last.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, F.col("id"), F.xxhash64("text")).withColumn("_part", F.spark_partition_id())
    firsts = ranged.groupBy("_part").agg(F.min(F.struct(F.col("id").isNotNull().alias("k"), "id", "text")).alias("f"))
    order = Window.orderBy("_part")                                   # one row per partition
    home = F.coalesce(F.lag("_part").over(order), F.max("_part").over(Window.partitionBy()))
    guests = firsts.withColumn("_home", home).select(F.col("f.id").alias("id"), F.col("f.text").alias("text"), F.col("_home").alias("_part"), F.lit(True).alias("_guest"))
    both = ranged.withColumn("_guest", F.lit(False)).unionByName(guests)
    w = Window.partitionBy("_part").orderBy("_guest", F.col("id").asc_nulls_first(), "text")
    return both.withColumn("_row", F.row_number().over(w)).withColumn("_next", F.lead("text").over(w))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint against that of an edited text and of the next document.

    The edited text has the last floor(n/2) code points replaced by the first
    as many (or all) of the next text in ascending id order; after the last
    comes the first. A null text is an empty one. Rows with the same id follow
    each other by text, and each gives a row. A null id comes first. A single
    document is its own next. An empty table gives no rows. Other columns are
    ignored.
    """
    rows = with_next(docs, id_col, text_col)
    n = F.length("text")
    edited = F.concat(F.substr("text", F.lit(1), n - F.floor(n / 2).cast("int")),
                      F.substr(F.coalesce("_next", F.lit("")), F.lit(1), F.floor(n / 2).cast("int")))
    rows = rows.select("_part", "_row", "id", "_guest", n.cast("long").alias("n_chars"), "text", F.when(~F.col("_guest"), edited).otherwise("").alias("edited"))
    info = F.struct("id", "_guest", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"))
    texts = rows.select("_part", "_row", info.alias("_info"), F.posexplode(F.array("text", "edited")).alias("_which", "_text"))
    lanes = fingerprint_lanes(texts, ["_part", "_row", "_which", "_info"], "_text")
    packed = F.struct(*NAMES)
    sides = lanes.groupBy("_part", "_row").agg(F.first("_info").alias("_info"), F.max(F.when(F.col("_which") == 0, packed)).alias("own"),
                                               F.max(F.when(F.col("_which") == 1, packed)).alias("edit"))
    w = Window.partitionBy("_part").orderBy("_row")
    sides = sides.withColumn("next", F.lead("own").over(w)).where("NOT _info._guest")
    of = lambda c: {x: F.col(f"{c}.{x}") for x in NAMES}
    return sides.select(F.col("_info.id").alias(id_col), "_info.n_chars", F.col("_info.sha").alias("edited_sha256"),
                        encode(of("own")).alias("fingerprint"), encode(of("edit")).alias("edited_fingerprint"),
                        likeness(of("own"), of("edit")).alias("near_edited"), likeness(of("own"), of("next")).alias("near_next"))
