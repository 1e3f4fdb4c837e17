"""Chat formatting with Spark expressions only, and reading the format back.

The template is text with three control strings:

- ``<|role|>`` NAME ``<|body|>`` opens a block of one role,
- ``<|turn|>`` separates the turns of adjacent rows with the same role, which share a block,
- ``<|end|>`` closes the block.

Every control string starts with ``<|``. Inside role names and texts each
``<|`` is written ``<\\|`` and each ``\\`` is written ``\\\\``, so no text can
contain a control string and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ROLE, BODY, TURN, END = "<|role|>", "<|body|>", "<|turn|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    """Undo ``escape``: between doubled backslashes a single one only stands in ``<\\|``."""
    pieces = F.split(c, "\\\\\\\\")
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|"))), "\\")


def format_conversations(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: its key and ``formatted``.

    Turns are sorted by ``order``; ties go by role, then text; repeated rows are
    turns of their own. A null text or role counts as empty; a null order comes
    first; rows with a null key form one conversation. Adjacent turns of one
    role share a block. Other columns are ignored. A conversation becomes one
    string, so it is also the largest piece of work in one task.
    """
    rows = turns.select(
        F.col(key).alias("_k"),
        F.struct(F.col(order).alias("o"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("r"),
                 F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).alias("_t"))
    sorted_turns = rows.groupBy("_k").agg(F.sort_array(F.collect_list("_t")).alias("_s"))
    # each turn with the mark before it: a new block where the role changes, a turn mark where it stays
    marked = F.transform("_s", lambda x, i: F.concat(
        F.when((i > 0) & (F.get(F.col("_s"), i - 1)["r"] == x["r"]), F.lit(TURN))
        .otherwise(F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(ROLE), escape(x["r"]), F.lit(BODY))),
        escape(x["t"])))
    whole = F.concat(F.array_join(marked, ""), F.lit(END))
    return sorted_turns.select(F.col("_k").alias(key), whole.alias("formatted"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    blocks = F.split(formatted, "<\\|end\\|>")
    blocks = F.slice(blocks, F.lit(1), F.greatest(F.size(blocks) - 1, F.lit(0)))          # nothing follows the last end mark

    def turns(block: Column) -> Column:
        parts = F.split(block, "<\\|body\\|>", 2)
        name = unescape(F.replace(F.get(parts, F.lit(0)), F.lit(ROLE), F.lit("")))
        return F.transform(F.split(F.get(parts, F.lit(1)), "<\\|turn\\|>"),
                           lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(turns: Column, role: str = "assistant") -> Column:
    """All text under the loss mask: the texts of one role, in order, with nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == role), lambda t: t["text"]), "")


def loss_spans(formatted: DataFrame, key: str = "conv_id", role: str = "assistant") -> DataFrame:
    """(key, start, end): code points of the formatted string that carry the loss, one row per turn of the role.

    Marks carry none; escapes inside a text do. A trainer maps the spans to
    tokens by their offsets. Keys must be unique, as ``format_conversations``
    returns them.
    """
    turns = (formatted.select(key, F.posexplode(F.split("formatted", "(?<=<\\|(end|turn|body)\\|>)")).alias("_at", "_piece"))
             .where("_piece <> ''"))
    at = Window.partitionBy(key).orderBy("_at")
    size, mark = F.length("_piece"), F.regexp_extract("_piece", "<\\|(end|turn)\\|>$", 0)
    turns = turns.withColumn("_end", F.sum(size).over(at)).withColumn(
        "_role", F.last(F.when(F.col("_piece").endswith(BODY), F.col("_piece")), ignorenulls=True).over(at))
    mine = F.concat(F.lit(ROLE), escape(F.lit(role)), F.lit(BODY))
    return (turns.where((mark != "") & (F.col("_role") == mine))
            .select(key, (F.col("_end") - size).cast("long").alias("start"), (F.col("_end") - F.length(mark)).cast("long").alias("end")))


def digest(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Counts and hashes read back from the formatted strings alone."""
    read = formatted.select(key, "formatted", parse(F.col("formatted")).alias("_turns"))
    flat = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("_turns"))
    return read.select(
        key, F.size("_turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
