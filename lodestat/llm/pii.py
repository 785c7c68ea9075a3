"""Personal data by weak supervision, in DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, payment cards and telephone numbers; looser
patterns add candidates of the same kinds (other separators, no country code, ``(at)``).  Four
labelers vote on every candidate: its shape, its own check (checksum, parts, number of
digits), a gazetteer of prefixes and endings, and the words in front of it.
Expectation-maximisation over the counts of vote patterns, a table of bounded size, gives the
labelers' reliabilities and each pattern's probability; a logistic span classifier on votes
and form is trained on these probabilities and decides on the looser candidates.  Base spans
always stay.

Nothing is shuffled but counts of vote patterns: a document's spans are arrays of its row.

Defined cases: null text is empty and has no spans; an empty table gives no rows; equal rows
are treated alike; a looser candidate that overlaps a base span is no candidate; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import narrow, whole
from lodestat.session import cut

# Kinds in their order, and the patterns of the base spans.  Possessive
# repetition finds the same matches without the recursion long runs would cause.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text that does not hold this has no match of the pattern above.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE = {
    "email": r"(?i)[A-Z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Z0-9-]++)++",
    "card": r"(?<![0-9])[0-9](?:[ ._-]?[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9.])(?:\+|00)?\(?[0-9](?:[ ().\/-]{0,3}[0-9]){8,14}+(?![0-9])",
}
LOOSE_HINT = {"email": r"(?i)[\[(] ?at ?[\])]", "card": r"[0-9][ ._-]?[0-9][ ._-]?[0-9][ ._-]?[0-9]", "phone": r"[0-9][ ().\/-]{0,3}[0-9][ ().\/-]{0,3}[0-9]"}
# Gazetteers and context words.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot ?[\])] ?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|us|ca|au|jp|ch|at|be)$",
    "ip": r"^(?!0+\.|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6[05])",
    "phone": r"^(?:\+|00)(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
}
GOOD_WORDS = r"(?i)\b(?:e-?mail|mail|contact|phone|tel|telephone|call|mobile|fax|card|visa|mastercard|ip|address|host|telefon|correo|courriel)\b"
BAD_WORDS = r"(?i)\b(?:version|isbn|issn|doi|order|invoice|page|no|nr|article|section|serial|id|rfc)\b\.?"
CONTEXT = 24  # characters in front of a span that the context labeler reads
KEEP = 0.9  # probability from which a looser candidate becomes a span
LABELERS = 4


def _let(value: Column, then) -> Column:
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(lengths: Column) -> Column:
    """Inclusive running sums of a non-empty array, by blocks so that long arrays stay cheap."""
    block = 256

    def add(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, b: a + b)

    blocks = F.transform(F.sequence(F.lit(0), ((F.size(lengths) - 1) / block).cast("int")), lambda b: add(F.slice(lengths, b * block + 1, F.lit(block))))
    return _let(F.struct(lengths.alias("l"), blocks.alias("b")), lambda s: F.transform(s["l"], lambda _, i: (
        add(F.slice(s["b"], F.lit(1), (i / block).cast("int"))) + add(F.slice(s["l"], (i / block).cast("int") * block + 1, i % block + 1)))))


def _found(text: Column, pattern: str, hint: str) -> Column:
    """``start, end, m`` of all leftmost matches, in code points: gaps and matches take turns."""
    kind = "array<struct<start:int,end:int,m:string>>"

    def spans(s: Column) -> Column:
        steps = F.transform(s["m"], lambda x, i: F.char_length(F.get(s["gaps"], i)) + F.when(i > 0, F.char_length(F.get(s["m"], i - 1))).otherwise(0))
        return F.zip_with(_running(steps), s["m"], lambda at, m: F.struct(at.alias("start"), (at + F.char_length(m)).alias("end"), m.alias("m")))

    found = _let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gaps")),
                 lambda s: F.when(F.size(s["m"]) > 0, spans(s)).otherwise(F.array().cast(kind)))
    return F.when(text.rlike(hint), found).otherwise(F.array().cast(kind))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    """The base rule of a kind for a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.cast("double") <= 255)
    d = _digits(m)
    if kind == "card":
        return F.char_length(d).between(12, 19) & _luhn(d)
    return F.char_length(d).between(9, 15)


def _votes(kind: str, s: Column, text: Column, base: bool) -> Column:
    """Votes 1, 0 or -1 of the labelers on one candidate."""
    m, d = s["m"], _digits(s["m"])
    if kind == "email":
        check = F.when(m.rlike(r"[A-Za-z]{2,}$"), 1).otherwise(-1)
    elif kind == "ip":
        check = F.when(_valid("ip", m), 1).otherwise(-1)
    elif kind == "card":
        check = F.when(_luhn(d), 1).otherwise(-1)
    else:
        check = F.when(F.char_length(d).between(10, 13), 1).when(F.char_length(d) > 15, -1).otherwise(0)
    before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
    context = F.when(before.rlike(GOOD_WORDS), 1).when(before.rlike(BAD_WORDS), -1).otherwise(0)
    gazetteer = F.when((d if kind == "card" else m).rlike(GAZETTEER[kind]), 1).otherwise(-1)
    return F.array(F.lit(1 if base else -1), check, gazetteer, context)


def _candidates(text: Column) -> tuple[Column, Column]:
    """Base spans and looser candidates of a text: ``start, rank, end, votes, size, parts``."""

    def form(kind: str, s: Column, base: bool) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"),
                        _votes(kind, s, text, base).alias("votes"), F.least((s["end"] - s["start"]) / 4, F.lit(7)).cast("int").alias("size"),
                        s["m"].rlike(r"[^0-9A-Za-z@.]").cast("int").alias("parts"))

    def spans(kind: str, table: dict, hints: dict, base: bool) -> Column:
        found = _found(text, table[kind], hints[kind])
        if base:
            found = F.filter(found, lambda s: _valid(kind, s["m"]))
        return F.transform(found, lambda s: form(kind, s, base))

    base = F.concat(*[spans(k, BASE, HINT, True) for k in KINDS])
    loose = F.concat(*[spans(k, LOOSE, LOOSE_HINT, False) for k in LOOSE])
    return base, loose


def patterns(held: DataFrame) -> list:
    """Counts of vote patterns and forms over all candidates: a bounded table."""
    every = held.select(F.explode(F.concat("base", "loose")).alias("c"))
    return every.groupBy("c.rank", "c.votes", "c.size", "c.parts").count().collect()  # at most 4 x 81 x 8 x 2 rows


def reliabilities(rows: list, rounds: int = 50) -> tuple[list[float], list[float], list[float]]:
    """Labelers' reliabilities, share of true spans per kind, and each pattern's probability.

    A vote is right with the labeler's reliability, which starts at 0.8 and keeps the weight of
    ten such votes.
    """
    right, share = [0.8] * LABELERS, [0.5] * len(KINDS)
    post = [0.5] * len(rows)
    for _ in range(rounds):
        for i, r in enumerate(rows):
            odds = math.log(share[r["rank"]] / (1 - share[r["rank"]]))
            odds += sum(v * math.log(right[j] / (1 - right[j])) for j, v in enumerate(r["votes"]))
            post[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for j in range(LABELERS):
            good, cast = 8.0, 10.0
            for p, r in zip(post, rows):
                if r["votes"][j]:
                    good += r["count"] * (p if r["votes"][j] > 0 else 1 - p)
                    cast += r["count"]
            right[j] = min(0.99, max(0.51, good / cast))
        for k in range(len(KINDS)):
            own = [(p, r["count"]) for p, r in zip(post, rows) if r["rank"] == k]
            share[k] = (1 + sum(p * n for p, n in own)) / (2 + sum(n for _, n in own))
    return right, share, post


def classifier(rows: list, post: list[float], rounds: int = 300) -> list[float]:
    """Weights of the span classifier: kinds, votes, size and parts."""
    width = len(KINDS) + LABELERS + 2
    w, seen, total = [0.0] * width, [1e-6] * width, sum(r["count"] for r in rows) or 1
    inputs = [[float(r["rank"] == k) for k in range(len(KINDS))] + [float(v) for v in r["votes"]] + [r["size"] / 8, float(r["parts"])] for r in rows]
    for _ in range(rounds):
        g = [1e-4 * x for x in w]
        for x, p, r in zip(inputs, post, rows):
            z = sum(a * b for a, b in zip(w, x))
            err = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * r["count"] / total
            g = [a + err * b for a, b in zip(g, x)]
        seen = [s + x * x for s, x in zip(seen, g)]
        w = [x - 0.5 * d / math.sqrt(s) for x, d, s in zip(w, g, seen)]
    return w


def _probability(c: Column, w: list[float]) -> Column:
    kinds = F.element_at(F.array(*[F.lit(x) for x in w[:len(KINDS)]]), c["rank"] + 1)
    votes = sum((F.get(c["votes"], F.lit(j)) * F.lit(w[len(KINDS) + j]) for j in range(LABELERS)), F.lit(0.0))
    return 1 / (1 + F.exp(-(kinds + votes + c["size"] / 8 * F.lit(w[-2]) + c["parts"] * F.lit(w[-1]))))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``added`` spans (``start, rank, end``)."""
    rows = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", whole("text").alias("text"))
    base, loose = _candidates(F.col("text"))
    held = cut(rows.select("doc_id", base.alias("base"), loose.alias("loose")))
    held = held.withColumn("loose", F.filter("loose", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))))
    counted = patterns(held)
    _, _, post = reliabilities(counted)
    weights = classifier(counted, post)
    added = F.filter("loose", lambda c: _probability(c, weights) >= KEEP)

    def bare(spans):
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))

    return held.select("doc_id", bare("base").alias("base"), bare(added).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans per kind, the hash of the base spans and all spans as text."""
    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                        _written(F.concat("base", "added")).alias("spans"))
