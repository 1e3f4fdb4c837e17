"""Personal data: proposals scored by boosted trees beside certain patterns.

Two kinds of spans are found in a text. *Base* spans match a strict pattern
and its check (an address with a sign and a domain, four parts of at most 255,
13 to 19 digits passing the Luhn test, a plus sign with 9 to 15 digits); they
are always kept. Beside them, generators of high recall propose spans that may
overlap: spelled-out signs and dots, addresses with other letters, defanged
and IPv6 addresses, card numbers in other groupings or inside longer chains,
telephone numbers without a plus sign. Boosted trees score a proposal by its
format and its context, scores are calibrated to probabilities, and each kind
has the lowest threshold that keeps the wanted precision; the likelier of
overlapping proposals stays.

The trees need no labels. Examples come from the corpus: base spans in their
contexts and the same spans in disguise are positive, broken ones (a digit
changed, a part too large, a number inside a longer one, prose around "at") and
proposals of the corpus that a check refutes are negative. The sample is
bounded by ``FIT_SPANS`` distinct spans of a kind; what reaches the driver are
counts of feature patterns. Without base spans of a kind nothing is added to it.

DataFrame functions only. A text is read once; spans and short contexts go on.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut, pin

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
FIT_SPANS = 3000        # distinct base spans, and as many refuted proposals, of each kind to learn from
CONTEXT = 24            # characters on either side of a span
LONGEST = 160           # characters a proposal may have
PRECISION = 0.97        # wanted share of right ones among added spans
ROUNDS, DEPTH, RATE = 40, 3, 0.3
_BLOCK = 512

# Patterns of the base spans. Runs are taken whole (possessive) and begin where the last match ended or at the
# run's first character, which finds the same spans without going back.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    EMAIL: rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    CARD: r"(?<![0-9]|[0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    PHONE: r"\+[0-9](?:[\x20().-]*+[0-9]){8,14}+(?![\x20().-]*+[0-9])",
}
_GATES = {EMAIL: "@", IP: r"[0-9]\.[0-9]+\.[0-9]", CARD: r"[0-9](?:[\x20-]?[0-9]){12}", PHONE: r"\+[0-9]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_PARTS_FIT = rf"^{_PART}(?:[^0-9]+{_PART}){{3}}$"

_OPEN, _CLOSE = r"[(\[{<]\x20?", r"\x20?[)\]}>]"
_AT = rf"(?:\x20{{0,2}}[@＠]\x20{{0,2}}|\x20{{0,2}}{_OPEN}(?:at|AT|@){_CLOSE}\x20{{0,2}}|\x20(?:at|AT)\x20)"
_DOT = rf"(?:\x20?\.\x20?|\x20{{0,2}}{_OPEN}(?:dot|DOT|\.){_CLOSE}\x20{{0,2}}|\x20(?:dot|DOT)\x20)"
_NAME, _LABEL = r"[\p{L}\p{N}._%+-]{1,64}+", r"[\p{L}\p{N}-]{1,63}+"
_BYTE_DOT = rf"(?:\x20?\.\x20?|\x20?{_OPEN}(?:dot|DOT|\.){_CLOSE}\x20?|\x20(?:dot|DOT)\x20)"
_GAP = r"[\x20\xA0._/-]{1,2}"


@dataclass(frozen=True)
class Generator:
    """A proposal begins where ``head`` matches and is what ``whole`` matches from there; only the head is used up, so proposals overlap."""

    kind: int
    gate: str
    head: str
    whole: str


GENERATORS = (
    Generator(EMAIL, rf"[@＠]|{_OPEN}(?:at|AT){_CLOSE}|\x20(?:at|AT)\x20{_LABEL}{_DOT}[\p{{L}}\p{{N}}-]", rf"(?<![\p{{L}}\p{{N}}._%+-]){_NAME}(?={_AT}{_LABEL}{_DOT}[\p{{L}}\p{{N}}-])",
              rf"{_NAME}{_AT}{_LABEL}(?:{_DOT}{_LABEL}){{1,4}}"),
    Generator(IP, rf"[0-9]{_BYTE_DOT}[0-9]{{1,3}}{_BYTE_DOT}[0-9]", rf"(?<![0-9])[0-9]{{1,3}}+(?=(?:{_BYTE_DOT}[0-9]{{1,3}}+){{3}}(?![0-9]))",
              rf"[0-9]{{1,3}}+(?:{_BYTE_DOT}[0-9]{{1,3}}+){{3}}"),
    Generator(IP, r":[0-9A-Fa-f]{0,4}:", r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}+:(?=[0-9A-Fa-f]{0,4}+:[0-9A-Fa-f:]*+(?![0-9A-Za-z:]))",
              r"(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}"),
    Generator(CARD, r"[0-9]{13}", r"(?<![0-9])[0-9]{13,19}+(?![0-9])", r"[0-9]{13,19}+"),
    Generator(CARD, rf"[0-9]{{4}}{_GAP}[0-9]{{4}}{_GAP}[0-9]{{4}}", rf"(?<![0-9])[0-9]{{4}}(?=(?:{_GAP}[0-9]{{4}}){{3}}(?![0-9]))", rf"[0-9]{{4}}(?:{_GAP}[0-9]{{4}}){{3}}"),
    Generator(CARD, rf"[0-9]{{4}}{_GAP}[0-9]{{6}}{_GAP}[0-9]{{5}}", rf"(?<![0-9])[0-9]{{4}}(?={_GAP}[0-9]{{6}}{_GAP}[0-9]{{5}}(?![0-9]))", rf"[0-9]{{4}}{_GAP}[0-9]{{6}}{_GAP}[0-9]{{5}}"),
    Generator(PHONE, r"[0-9]\)?[\x20./-]{0,2}[0-9]{3,4}[\x20./-][0-9]{4}", r"(?<![0-9+])\(?[0-9]{2,4}\)?(?=[\x20./-]{0,2}[0-9]{3,4}[\x20./-][0-9]{4}(?![0-9]))",
              r"\(?[0-9]{2,4}\)?[\x20./-]{0,2}[0-9]{3,4}[\x20./-][0-9]{4}"),
    Generator(PHONE, r"[+＋0][\x200]?[1-9]", r"(?<![0-9])(?:\+\x20|＋\x20?|00)[1-9](?=(?:[\x20().-]{0,2}[0-9]){7,13}+(?![\x20().-]{0,2}[0-9]))",
              r"(?:\+\x20|＋\x20?|00)[1-9](?:[\x20().-]{0,2}[0-9]){7,13}+"),
)

# Words near a span that speak for its kind, in the four languages of the corpus and more; and some that speak against all.
_HINTS = {
    EMAIL: r"(?i)e-?mail|mail|contact|kontakt|correo|courriel|write\x20to|reach",
    IP: r"(?i)\bips?\b|host|server|address|adresse|direcci|client|login|ping",
    CARD: r"(?i)card|karte|carte|tarjeta|visa|credit|kredit|amex|mastercard|pay|pago",
    PHONE: r"(?i)phone|tel|call|fax|mobil|cell|number|nummer|num[ée]ro|whatsapp|sms",
}
_AGAINST = r"(?i)token|key|hash|sha|md5|uuid|guid|isbn|issn|version|\bv\.?$|order|invoice|serial|commit|secret|=\x20?\"?$"


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the Luhn test."""
    value = lambda c, i: c.cast("int") * (1 + i % 2)
    doubled = F.transform(F.reverse(F.regexp_extract_all(text, F.lit("[0-9]"), F.lit(0))), value)
    return F.aggregate(doubled, F.lit(0), lambda s, v: s + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def _starts(lengths: Column) -> Column:
    """Sum of all elements before each one, in blocks, so that long arrays cost no more than short ones for each element."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
    block = lambda j: F.slice(lengths, j * _BLOCK + 1, _BLOCK)
    none = F.array().cast("array<int>")

    def running(first: Column, values: Column) -> Column:
        state = F.struct(first.alias("at"), none.alias("out"))
        return F.aggregate(values, state, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]

    sums = F.transform(blocks, lambda j: F.aggregate(block(j), F.lit(0), lambda a, b: a + b))
    offsets = running(F.lit(0), sums)
    return F.when(F.size(lengths) == 0, none).otherwise(F.flatten(F.transform(F.arrays_zip(blocks.alias("j"), offsets.alias("o")), lambda z: running(z["o"], block(z["j"])))))


_SPANS = "array<struct<kind:int,start:int,end:int,span:string,left:string,right:string>>"
_CHECKS = {IP: lambda x: x.rlike(_PARTS_FIT), CARD: luhn}
_REACH = LONGEST + CONTEXT


def _pieces(m: Column, g: Column) -> Column:
    """Gaps and matches in turn, the middle of long ones left out, so that what is near a match is found in few short pieces."""
    def ends(x: Column) -> Column:
        return F.when(F.length(x) > 2 * _REACH, F.concat(F.left(x, F.lit(_REACH)), F.right(x, F.lit(_REACH)))).otherwise(x)

    return F.flatten(F.transform(g, lambda x, i: F.array(ends(x), F.coalesce(ends(F.get(m, i)), F.lit("")))))


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but the text if None) in a struct ``keep``, and the arrays ``base`` and ``proposed`` of spans.

    Spans count code points, ends exclusive; they come with the text around
    them. Generators see base spans of their kind masked, so nothing proposed
    overlaps one.

    All patterns go through the same steps side by side: matches and the gaps
    between them, where the gate of a pattern lets a text through; lengths;
    running sums, which are the starts; spans. The work grows with the text and
    the number of matches, however many a text has.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    text, none = F.col("_t"), F.array().cast(_SPANS)
    base = [f"_b{k}" for k in BASE]
    proposed = [f"_p{j}" for j in range(len(GENERATORS))]
    df = docs.select(F.struct(*keep, F.lit(0).alias("_")).alias("keep"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))

    def matches(source: Column, gate: str, pattern: str) -> Column:
        on = source.contains(gate) if gate == "@" else source.rlike(gate)
        found = F.struct(F.regexp_extract_all(source, F.lit(pattern), F.lit(0)).alias("m"), F.split(source, pattern, -1).alias("g"))
        return F.when(on, F.filter(F.array(found), lambda x: F.size(x["m"]) > 0))

    def masked(kind: int) -> Column:
        b, check = F.get(F.col(f"_b{kind}"), F.lit(0)), _CHECKS.get(kind)
        fill = lambda x: F.repeat(F.lit("\x01"), F.length(x))
        hide = lambda x: fill(x) if check is None else F.when(check(x), fill(x)).otherwise(x)
        parts = F.transform(b["m"], lambda x, i: F.concat(F.get(b["g"], i), hide(x)))
        return F.when(b.isNull(), text).otherwise(F.concat(F.array_join(parts, ""), F.element_at(b["g"], -1)))

    def lengths(c: str) -> Column:
        """Matches, pieces, and from the start of each match to the start of the next (the match before and the gap)."""
        x = F.get(F.col(c), F.lit(0))
        steps = F.transform(x["m"], lambda _, i: F.length(F.get(x["g"], i)) + F.when(i > 0, F.length(F.get(x["m"], i - 1))).otherwise(0))
        return F.when(x.isNotNull(), F.struct(x["m"].alias("m"), _pieces(x["m"], x["g"]).alias("p"), steps.alias("l")))

    def starts(c: str) -> Column:
        sums = F.zip_with(_starts(F.col(f"{c}.l")), F.col(f"{c}.l"), lambda a, b: a + b)
        return F.when(F.col(c).isNotNull(), F.struct(f"{c}.m", f"{c}.p", sums.alias("s")))

    def spans(c: str, kind: int, whole: str | None) -> Column:
        m, p = F.col(f"{c}.m"), F.col(f"{c}.p")
        near = lambda first, count: F.array_join(F.slice(p, first, count), "")

        def span(start: Column, i: Column) -> Column:
            own = F.get(m, i)
            after = F.left(near(2 * i + 3, 40), F.lit(_REACH))
            left = F.right(near(F.greatest(2 * i + 2 - 20, F.lit(1)), F.least(F.lit(20), 2 * i + 1)), F.lit(CONTEXT))
            if whole is None:
                found, end = F.left(own, F.lit(LONGEST + 1)), start + F.length(own)
                right = F.left(after, F.lit(CONTEXT))
            else:
                found = F.regexp_extract(F.left(F.concat(own, after), F.lit(LONGEST)), "^" + whole, 0)
                end = start + F.length(found)
                right = F.substr(F.concat(own, after), F.length(found) + 1, F.lit(CONTEXT))
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), found.alias("span"), left.alias("left"), right.alias("right"))

        out = F.transform(F.col(f"{c}.s"), span)
        if whole is not None:
            out = F.filter(out, lambda x: F.length(x["span"]) > 0)
        elif kind in _CHECKS:
            out = F.transform(F.filter(F.arrays_zip(m.alias("m"), out.alias("x")), lambda z: _CHECKS[kind](z["m"])), lambda z: z["x"])
        return F.when(F.col(c).isNotNull(), out).otherwise(none)

    df = pin(df.select("keep", "_t", *[matches(text, _GATES[k], BASE[k]).alias(c) for k, c in enumerate(base)]), *base)
    df = pin(df.select("keep", *base, *[matches(masked(g.kind), g.gate, g.head).alias(c) for g, c in zip(GENERATORS, proposed)]), *proposed)
    for step in (lengths, starts):
        df = pin(df.select("keep", *[step(c).alias(c) for c in base + proposed]), *base, *proposed)
    kinds = [(k, None) for k in BASE] + [(g.kind, g.whole) for g in GENERATORS]
    df = df.select("keep", *[spans(c, *k).alias(c) for c, k in zip(base + proposed, kinds)])
    return df.select("keep", F.concat(*base).alias("base"), F.concat(*proposed).alias("proposed"))


# --- features ----------------------------------------------------------------

FEATURES = ("kind", "digits", "valid", "style", "left_edge", "right_edge", "chained", "hint", "against", "spaces", "shape", "spread", "tail")


def features(x: Column) -> Column:
    """Format and context of a span struct as small integers, in the order of ``FEATURES``."""
    kind, span, left, right = (x[c] for c in ("kind", "span", "left", "right"))
    digits = F.regexp_replace(span, "[^0-9]", "")
    n = F.length(digits)
    last = F.regexp_extract(span, r"([\p{L}\p{N}-]+)$", 1)
    groups = F.regexp_replace(F.regexp_replace(span, "[^0-9]+", " "), "[0-9]", "9")
    six = span.contains(":")
    valid = (F.when(kind == EMAIL, last.rlike(r"^\p{Ll}{2,6}$"))
             .when(kind == IP, F.when(six, span.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") | span.rlike(r"^[23f][0-9A-Fa-f:]*::[0-9A-Fa-f:]*$"))
                   .otherwise(span.rlike(_PARTS_FIT)))
             .when(kind == CARD, luhn(digits)).otherwise(n.between(9, 15)))

    def edge(c: Column) -> Column:
        return F.when(c == "", 0).when(c.rlike(r"[\x20\t\r\n]"), 1).when(c.rlike(r"[\p{L}_]"), 3).when(c.rlike("[0-9]"), 4).otherwise(2)

    before, after = F.right(left, F.lit(1)), F.left(right, F.lit(1))
    chained = F.when(left.rlike(r"[0-9][^\p{L}0-9\n]{1,2}$"), 1).otherwise(0) + F.when(right.rlike(r"^[^\p{L}0-9\n]{1,2}[0-9]"), 2).otherwise(0)
    style = (F.when(span.rlike(rf"{_OPEN}(?:at|AT|@|dot|DOT|\.){_CLOSE}"), 3).when(span.rlike(r"\x20(?:at|AT|dot|DOT)\x20"), 4)
             .when(span.rlike(r"\x20[@＠.]|[@＠.]\x20"), 5).when(six, 6).when(span.rlike("^[0-9]+$"), 0)
             .when(span.rlike(r"^[0-9]+(?:([^0-9])[0-9]+)(?:\1[0-9]+)*$"), 1).otherwise(2))
    hint = F.lit(0)
    for k, words in _HINTS.items():
        hint = F.when(left.rlike(words), F.when(kind == k, 2).otherwise(1)).otherwise(hint)
    hint = F.when((kind == EMAIL) & left.rlike(_HINTS[EMAIL]) | (kind == IP) & left.rlike(_HINTS[IP]) | (kind == CARD) & left.rlike(_HINTS[CARD])
                  | (kind == PHONE) & left.rlike(_HINTS[PHONE]), 2).otherwise(hint)
    spaces = F.least(F.length(span) - F.length(F.replace(span, F.lit(" "), F.lit(""))), F.lit(8))
    shape = (F.when(groups.rlike(r"^9999 9999 9999 9999$"), 1).when(groups.rlike(r"^9999 999999 99999$"), 2).when(groups.rlike(r"^ ?999 999 9999$"), 3)
             .when(groups.rlike(r"^9{16}$"), 4).when(groups.rlike(r"^9{13,19}$"), 5).when(groups.rlike(r"^ ?9{2,4} 9{3,4} 9{4}$"), 6).otherwise(0))
    spread = F.size(F.array_distinct(F.regexp_extract_all(digits, F.lit("[0-9]"), F.lit(0))))
    tail = F.when(span.rlike(r"\.\x20?\p{Lu}[\p{L}\p{N}-]*$"), 1).when(span.rlike(r"\.\x20\p{L}+$"), 2).when(last.rlike("[0-9]"), 3).otherwise(0)
    values = (kind, F.least(n, F.lit(20)), F.when(valid, 1).otherwise(0), style, edge(before), edge(after), chained, hint,
              F.when(left.rlike(_AGAINST), 1).otherwise(0), spaces, shape, spread, tail)
    return F.array(*[v.cast("int") for v in values])


# --- examples ----------------------------------------------------------------

def _example(label: int, x: Column, span: Column, left: Column | None = None, right: Column | None = None) -> Column:
    return F.struct(F.lit(label).alias("label"), x["kind"].alias("kind"), span.alias("span"),
                    (x["left"] if left is None else left).alias("left"), (x["right"] if right is None else right).alias("right"))


def _examples(x: Column) -> Column:
    """The span of a struct in disguise (label 1) and broken (label 0), by kind, as an array."""
    span, left, right = x["span"], x["left"], x["right"]
    name, domain = F.substring_index(span, "@", 1), F.substring_index(span, "@", -1)
    swap = lambda s, what, by: F.replace(s, F.lit(what), F.lit(by))
    join = F.concat
    hinted = lambda word: join(F.right(left, F.lit(CONTEXT - len(word))), F.lit(word))
    email = []
    # as it is, and with letters for its digits: many addresses have none
    for own, at in ((name, domain), (F.regexp_replace(name, "[0-9]", "k"), F.regexp_replace(domain, "[0-9]", "o"))):
        host = F.substring_index(at, ".", 1)
        email += [(1, join(F.lit(a), own, F.lit(by), swap(at, ".", dot))) for a, by, dot in (
            ("", "@", "."), ("é", "@", "."), ("", " (at) ", "."), ("", "[at]", "."), ("", " at ", "."), ("", " [at] ", " [dot] "), ("", "(at)", "(dot)"),
            ("", " at ", " dot "), ("", " AT ", " DOT "), ("", " @ ", "."), ("", "@ ", " . "))]
        email += [(0, join(own, F.lit(by), host, F.lit(rest))) for by, rest in (
            (" at ", ". The"), (" at ", ".Then"), (" at ", ". 5"), (" at ", ". In"), (" @ ", ". We"), (" at ", ". and"))]
    email += [(0, join(F.lit(a), host, F.lit(rest))) for a, rest in (("look at ", ".And"), ("it at ", ". it"), ("at at ", ". and"))]
    digits = F.regexp_replace(span, "[^0-9]", "")
    rest = F.substring_index(span, ".", -3)
    wide = join(F.lit("9"), F.lpad(F.right(F.substring_index(span, ".", 1), F.lit(2)), 2, "0"), F.lit("."), rest)
    ip = [(l, swap(s, ".", by)) for l, s in ((1, span), (0, wide)) for by in (".", "[.]", "(.)", " . ", "[dot]", " dot ")]
    broken = join(F.substr(digits, F.lit(1), F.length(digits) - 1), ((F.right(digits, F.lit(1)).cast("int") + 1) % 10).cast("string"))
    four = lambda s, by: F.regexp_replace(s, r"([0-9]{4})(?=[0-9])", f"$1{by}")
    card = [(l, s) for l, d in ((1, digits), (0, broken)) for s in (d, four(d, " "), four(d, "-"), four(d, "."), four(d, "/"))]
    chains = [(l, d, a, b) for l, d in ((1, digits), (0, broken)) for a, b in ((join(broken, F.lit(" ")), right), (left, join(F.lit(" "), F.left(broken, F.lit(CONTEXT - 1)))))]
    chains += [(0, digits, join(F.right(left, F.lit(16)), F.lit("c3b")), right), (0, digits, left, join(F.lit("af1"), F.left(right, F.lit(16)))),
               (0, digits, join(F.right(left, F.lit(12)), F.lit('token = "b4')), right)]
    ten = F.right(digits, F.lit(10))
    cut3 = lambda form: F.regexp_replace(ten, "^([0-9]{3})([0-9]{3})([0-9]{4})$", form)
    local = [cut3("($1) $2-$3"), cut3("$1-$2-$3"), cut3("$1.$2.$3"), cut3("$1 $2 $3")]
    phone = [(1, span), (1, join(F.lit("+ "), F.substr(span, F.lit(2), F.lit(LONGEST)))), (1, join(F.lit("00"), F.substr(span, F.lit(2), F.lit(LONGEST)))), *[(1, s) for s in local]]
    told = [(1, s, hinted("tel: "), right) for s in local] + [(1, s, hinted("phone "), right) for s in local]
    amid = [(0, s, join(F.right(left, F.lit(16)), F.lit("731 ")), right) for s in local[1:]] + [(0, s, left, join(F.lit(" 418"), F.left(right, F.lit(16)))) for s in local[1:]]
    # numbers side by side that are none: groups of four and others
    amid += [(0, F.regexp_replace(F.right(join(F.lit("5200"), digits), F.lit(12)), "^([0-9]{4})([0-9]{4})([0-9]{4})$", form), left, right) for form in ("$1 $2 $3", "$1-$2-$3", "$1.$2.$3")]
    amid += [(0, cut3(form), left, right) for form in ("$1/$2/$3", "$1$2 $3")]
    amid += [(0, s, hinted(w), right) for s in local[1:] for w in ("order ", "isbn ", "serial ")]
    sets = {EMAIL: email, IP: ip, CARD: [*card, *chains], PHONE: [*phone, *told, *amid]}
    sets[IP] += [(0, span, left, F.lit(".7 and later")), (0, span, hinted("version "), right), (0, span, hinted(" v"), right)]
    out = F.array().cast("array<struct<label:int,kind:int,span:string,left:string,right:string>>")
    for k, rows in sets.items():
        out = F.when(x["kind"] == k, F.array(*[_example(r[0], x, *r[1:]) for r in rows])).otherwise(out)
    return out


def _refuted(x: Column) -> Column:
    """A proposal of the corpus that cannot be what it looks like."""
    n = F.length(F.regexp_replace(x["span"], "[^0-9]", ""))
    lettered = x["left"].rlike(r"[\p{L}_]$") | x["right"].rlike(r"^[\p{L}_]")
    return (F.when(x["kind"] == EMAIL, x["span"].rlike(r"\x20at\x20") & x["span"].rlike(r"\.\x20?\p{Lu}[\p{L}\p{N}-]*$"))
            .when(x["kind"] == IP, ~x["span"].contains(":") & ~x["span"].rlike(_PARTS_FIT))
            .when(x["kind"] == CARD, ~luhn(x["span"]) | lettered).otherwise((n < 9) | lettered))


def examples(scanned: DataFrame, limit: int = FIT_SPANS) -> DataFrame:
    """(label, pattern of features, number, fold) of the examples drawn from a scan.

    For each kind up to ``limit`` distinct base spans and as many refuted
    proposals, by a hash of span and context; copies of a text bring nothing
    new. Every fourth span (by another hash) is for calibration (fold 1).
    """
    parts = []
    for name, keep in (("base", None), ("proposed", _refuted)):
        spans = scanned.select(F.explode(name).alias("x"))
        spans = spans if keep is None else spans.where(F.exists(F.array("x"), keep))
        spans = spans.where(F.length("x.span") <= LONGEST).select(F.lit(name).alias("name"), "x.kind", "x.span", "x.left", "x.right").distinct()
        for k in range(len(KINDS)):
            parts.append(spans.where(F.col("kind") == k).withColumn("_h", F.xxhash64("span", "left", "right")).orderBy("_h", "span", "left", "right").limit(limit))
    drawn = reduce(DataFrame.unionByName, parts).select("name", F.struct("kind", "span", "left", "right").alias("x"))
    # within array functions, where long expressions are evaluated as they stand
    made = F.transform(F.array("x"), lambda x: F.when(F.col("name") == "base", _examples(x)).otherwise(F.array(_example(0, x, x["span"]))))
    counted = F.transform(F.flatten(made), lambda e: F.struct(e["label"].alias("label"), features(e).alias("f")))
    rows = drawn.select((F.xxhash64("x.span", F.lit(1)) % 4 == 0).cast("int").alias("fold"), F.explode(counted).alias("e"))
    return rows.groupBy("fold", "e.label", "e.f").agg(F.count(F.lit(1)).alias("n"))


# --- boosted trees on counted patterns ----------------------------------------

@dataclass
class Model:
    """Trees as nested (feature, threshold, left, right) or leaf values; calibration (slope, offset); threshold of each kind."""

    trees: list = field(default_factory=list)
    calibration: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[int, float] = field(default_factory=dict)


def _grow(f: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int):
    """A regression tree on gradients and curvatures, by the best gain on every feature and value."""
    def value(r):
        return float(-RATE * g[r].sum() / (h[r].sum() + 1.0))

    def gain(a, b):
        return a * a / (b + 1.0)

    if depth == 0 or len(rows) < 2:
        return value(rows)
    best = (1e-6, None, None)
    whole = gain(g[rows].sum(), h[rows].sum())
    for j in range(f.shape[1]):
        v = f[rows, j]
        top = int(v.max()) + 1
        gs, hs = np.cumsum(np.bincount(v, g[rows], top)), np.cumsum(np.bincount(v, h[rows], top))
        for t in range(top - 1):
            won = gain(gs[t], hs[t]) + gain(gs[-1] - gs[t], hs[-1] - hs[t]) - whole
            if won > best[0] and hs[t] >= 1.0 and hs[-1] - hs[t] >= 1.0:
                best = (won, j, t)
    if best[1] is None:
        return value(rows)
    low = f[rows, best[1]] <= best[2]
    return (best[1], best[2], _grow(f, g, h, rows[low], depth - 1), _grow(f, g, h, rows[~low], depth - 1))


def _margin(tree, f: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(f), tree)
    j, t, low, high = tree
    return np.where(f[:, j] <= t, _margin(low, f), _margin(high, f))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def boost(f: np.ndarray, label: np.ndarray, n: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> list:
    """Trees of logistic gradient boosting on patterns with their counts; the first is a constant."""
    share = min(max((n * label).sum() / max(n.sum(), 1), 0.01), 0.99)
    trees: list = [math.log(share / (1 - share))]
    margin, every = np.full(len(f), trees[0]), np.arange(len(f))
    for _ in range(rounds):
        p = _logistic(margin)
        tree = _grow(f, n * (p - label), n * p * (1 - p), every, depth)
        trees.append(tree)
        margin = margin + _margin(tree, f)
    return trees


def calibrate(margin: np.ndarray, label: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to probabilities, by Newton's steps with a weak prior at (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = _logistic(a * margin + b)
        r, w = n * (p - label), n * p * (1 - p)
        grad = np.array([(r * margin).sum() + (a - 1), r.sum() + b])
        curve = np.array([[(w * margin * margin).sum() + 1, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1]])
        step = np.linalg.solve(curve, grad)
        size = max(1.0, float(np.abs(step).max()))
        a, b = a - step[0] / size, b - step[1] / size
    return float(max(a, 0.05)), float(b)


def threshold(p: np.ndarray, label: np.ndarray, n: np.ndarray, precision: float = PRECISION) -> float:
    """The lowest probability from which on the share of right ones, less one doubt, is ``precision``; 2 if there is none."""
    order = np.argsort(-p, kind="stable")
    right, seen = np.cumsum((n * label)[order]), np.cumsum(n[order])
    edge = np.append(p[order][1:] != p[order][:-1], True)                   # ties are taken together
    fine = edge & (right / (seen + 1.0) >= precision)
    return float(p[order][np.flatnonzero(fine)[-1]]) if fine.any() else 2.0


def fit(scanned: DataFrame, limit: int = FIT_SPANS, precision: float = PRECISION) -> Model:
    """Trees, calibration and thresholds from the examples of a scan; an empty model if there are none.

    A threshold is at least 1/2. At most some thousand patterns reach the driver.
    """
    rows = examples(scanned, limit).orderBy("fold", "label", "f").collect()
    if not rows:
        return Model()
    f = np.array([r.f for r in rows], dtype=np.int64)
    label, n, held = (np.array([r[c] for r in rows], dtype=np.float64) for c in ("label", "n", "fold"))
    train = held == 0 if (held == 0).any() else held == 1
    check = held == 1 if (held == 1).any() else held == 0
    model = Model(boost(f[train], label[train], n[train]))
    margin = sum(_margin(t, f) for t in model.trees)
    model.calibration = calibrate(margin[check], label[check], n[check])
    p = _logistic(model.calibration[0] * margin + model.calibration[1])
    for k in range(len(KINDS)):
        own = check & (f[:, 0] == k)
        if own.any():
            model.thresholds[k] = max(0.5, threshold(p[own], label[own], n[own], precision))
    return model


def probability(model: Model, f: Column) -> Column:
    """Calibrated probability of a pattern of features, as an expression."""
    def walk(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        j, t, low, high = tree
        return F.when(F.get(f, F.lit(j)) <= t, walk(low)).otherwise(walk(high))

    margin = F.lit(0.0)
    for tree in model.trees:
        margin = margin + walk(tree)
    a, b = model.calibration
    return 1 / (1 + F.exp(-(margin * a + b)))


# --- selection ---------------------------------------------------------------

def select(scanned: DataFrame, model: Model) -> DataFrame:
    """``scanned`` with ``spans``: base spans (score 2) and the accepted proposals, by start.

    A proposal that overlaps a base span goes; of proposals that overlap the
    likelier stays, of equal ones the earlier and longer.
    """
    slim = lambda x, s: F.struct(x["start"].alias("start"), (-x["end"]).alias("neg_end"), x["kind"].alias("kind"), x["end"].alias("end"), s.alias("score"))
    base = F.transform("base", lambda x: slim(x, F.lit(2.0)))
    if not model.trees:
        return scanned.withColumn("spans", F.array_sort(base))
    scored = pin(scanned.withColumn("_f", F.transform("proposed", lambda x: F.struct(x.alias("x"), features(x).alias("f")))), "_f")

    def least(kind: Column) -> Column:
        out = F.lit(2.0)
        for k, t in model.thresholds.items():
            out = F.when(kind == k, F.lit(float(t))).otherwise(out)
        return out

    added = F.transform("_f", lambda z: slim(z["x"], probability(model, z["f"])))
    scored = pin(scored.withColumn("_a", F.filter(added, lambda x: x["score"] >= least(x["kind"]))).drop("_f"), "_a")
    kind = "struct<start:int,neg_end:int,kind:int,end:int,score:double>"
    start = F.struct(F.lit(None).cast(kind).alias("last"), F.lit(0).alias("reach"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        last, sure = s["last"], x["score"] > 1.5
        free = last.isNull() | (x["start"] >= s["reach"]) | (sure & (last["score"] > 1.5))
        better = x["score"] > last["score"]
        reach = F.when(free, F.greatest(s["reach"], x["end"])).when(better, F.greatest(F.when(last["score"] > 1.5, s["reach"]).otherwise(0), x["end"])).otherwise(s["reach"])
        out = F.when(free & last.isNotNull(), F.concat(s["out"], F.array(last))).otherwise(s["out"])
        return F.struct(F.when(free | better, x).otherwise(last).alias("last"), reach.alias("reach"), out.alias("out"))

    done = F.aggregate(F.array_sort(F.concat(base, "_a")), start, step, lambda s: F.when(s["last"].isNotNull(), F.concat(s["out"], F.array(s["last"]))).otherwise(s["out"]))
    return scored.withColumn("spans", F.when(F.size("_a") == 0, F.array_sort(base)).otherwise(done)).drop("_a")


def span_text(spans: Column) -> Column:
    """kind:start:end, by kind as listed, then start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(k) for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = F.concat(s["out"], F.substr(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))))
        out = F.when(x["start"] < s["at"], s["out"]).otherwise(F.concat(piece, F.lit("["), F.get(names, x["kind"]), F.lit("]")))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

    return F.aggregate(F.array_sort(spans), start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, limit: int = FIT_SPANS, precision: float = PRECISION) -> DataFrame:
    """``keep`` columns (all but the text if None), ``base`` and ``spans`` of every row.

    Spans count code points, ends exclusive. A null or empty text has none.
    Equal texts have equal spans; an empty table gives no rows. Kept columns
    called base or spans are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text_col, "base", "spans")]
    scanned = cut(scan(docs, text_col, keep))
    found = select(scanned, fit(scanned, limit, precision))
    return found.select(*[F.col("keep")[c].alias(c) for c in keep], "base", "spans")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, number of base spans of each kind, ``base_sha256``, ``spans`` as text and ``n_added``."""
    found = find(docs, text_col, [id_col])
    counts = [_count(k).alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
                        (F.size("spans") - F.size("base")).cast("long").alias("n_added"))
