"""Repeated passages of lines, found by content-defined chunks and passages of ``LONG`` words, in DataFrame functions only.

A text's lines are hashed; a rolling hash over ``SPAN`` line hashes ends a chunk where it
falls in one of ``EVERY`` classes, so boundaries depend on the lines around them alone and
move with a passage that is shifted.  A line of ``LONG`` words or more is a chunk of its own.
Besides, the fewest whole lines that reach ``LONG`` words, from every line on and back from
every line, are passages: together they cover each line of every repeat of whole lines that
has ``LONG`` words, wherever it starts and ends.  Chunks of at least ``LEAST`` words and
passages whose hash occurs again anywhere are suspects; suspects are compared by the SHA-256
of their bytes, one occurrence stays (smallest id, then first in the text), and the lines of
the others are cut out.  A line that is cut always has an equal one that stays: each cut
points to an earlier occurrence.

Only hashes are counted over all chunks, with partial counts before the shuffle, so a chunk
or passage found in a third of all documents is one row per task.  Text travels for suspects alone,
then once to rebuild.

Defined cases: null text stays null and empty text empty; a text whose lines are all removed
becomes empty and its row stays; rows equal in id and text are one document and lose the
same lines; rows with a null id come last and are told apart by their text; an empty table
gives no rows; other columns, whatever their names, come back as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import WORD, whole
from lodestat.session import cut

SPAN = 2  # lines under the rolling hash
EVERY = 3  # a chunk ends on average after as many lines
LONG = 50  # words from which a line is a chunk of its own
LEAST = 8  # words of the shortest chunk that is removed


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _ends(s: Column) -> Column:
    """0-based last lines of the chunks: where the rolling hash says so, around long lines, and the last line."""
    last = F.size(s["h"]) - 1

    def ends_at(i: Column) -> Column:
        rolled = F.xxhash64(*[F.get(s["h"], i - back) for back in range(SPAN)])
        return ((i == last) | (F.get(s["n"], i) >= LONG) | F.coalesce(F.get(s["n"], i + 1) >= LONG, F.lit(False)) | (F.pmod(rolled, F.lit(EVERY)) == 0))

    return F.filter(F.sequence(F.lit(0), last), ends_at)


def _span(first: Column, last: Column) -> Column:
    return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"))


def _chunks(s: Column) -> Column:
    """``first, last`` of each chunk of at least ``LEAST`` words."""
    spans = _bound(_ends(s), lambda e: F.transform(e, lambda end, i: _span(F.coalesce(F.get(e, i - 1) + 1, F.lit(0)), end)))
    return F.filter(spans, lambda c: F.aggregate(F.slice(s["n"], c["first"] + 1, c["last"] - c["first"] + 1), F.lit(0), lambda a, n: a + n) >= LEAST)


def _passages(s: Column) -> Column:
    """``first, last`` of the fewest whole lines that reach ``LONG`` words, from each line on and back from each line."""

    def windows(w: Column) -> Column:
        # w: the line of each word; starts: the first word of each line that has words
        total = F.size(w)
        starts = F.filter(F.sequence(F.lit(0), total - 1), lambda k: (k == 0) | (F.get(w, k) != F.get(w, k - 1)))

        def both(at: Column) -> Column:
            ends = F.concat(F.transform(F.filter(at, lambda k: k > 0), lambda k: k - 1), F.array(total - 1))
            on = F.transform(F.filter(at, lambda k: k + LONG <= total), lambda k: _span(F.get(w, k), F.get(w, k + LONG - 1)))
            back = F.transform(F.filter(ends, lambda k: k >= LONG - 1), lambda k: _span(F.get(w, k - LONG + 1), F.get(w, k)))
            return F.concat(on, back)

        return F.when(total >= LONG, _bound(starts, both)).otherwise(F.array().cast("array<struct<first:int,last:int>>"))

    return _bound(F.flatten(F.transform(s["n"], lambda n, i: F.array_repeat(i, n))), windows)


def spans(text: Column) -> Column:
    """``first, last, hash`` of each chunk and passage of a text."""

    def hashed(s: Column) -> Column:
        return F.transform(F.array_distinct(F.concat(_chunks(s), _passages(s))), lambda c: F.struct(
            c["first"].alias("first"), c["last"].alias("last"), F.xxhash64(F.slice(s["h"], c["first"] + 1, c["last"] - c["first"] + 1)).alias("hash")))

    lines = _bound(_lines(text), lambda x: F.struct(F.transform(x, lambda y: F.xxhash64(y)).alias("h"), F.transform(x, lambda y: F.regexp_count(y, F.lit(WORD))).alias("n")))
    return _bound(lines, hashed)


_KEY = ["id", "mark"]


def repeats(rows: DataFrame) -> DataFrame:
    """``id, mark, cuts``: per document the spans (``first, last``) of which another occurrence stays.

    ``rows`` has ``id, mark`` and ``text``.
    """
    found = cut(rows.select(*_KEY, F.explode(spans(whole("text"))).alias("c")).select(*_KEY, "c.*"))
    often = cut(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"))
    # a document's suspects stand together before its text is fetched
    suspects = cut(found.join(often, "hash").groupBy(*_KEY).agg(F.collect_set(F.struct("first", "last")).alias("s")))
    bodies = rows.select(*_KEY, "text").join(suspects, _KEY).select(*_KEY, _lines(F.col("text")).alias("lines"), F.explode("s").alias("c"))
    body = F.array_join(F.slice("lines", F.col("c.first") + 1, F.col("c.last") - F.col("c.first") + 1), "\n")
    # equal hashes of other bytes fall apart here; passages overlap, so their digests travel, not their bytes
    bodies = cut(bodies.select(*_KEY, "c.first", "c.last", F.unhex(F.sha2(body, 256)).alias("sha")))
    proven = cut(bodies.groupBy("sha").agg(F.min(F.struct(*_KEY, "first", "last")).alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha", "keep"))
    again = bodies.join(proven, "sha")
    # a passage that overlaps the one that stays is part of it
    gone = again.filter((F.struct(*_KEY) != F.struct("keep.id", "keep.mark")) | (F.col("first") > F.col("keep.last")))
    return cut(gone.groupBy(*_KEY).agg(F.collect_set(F.struct("first", "last")).alias("cuts")))


def _gone(cuts: Column) -> Column:
    """The lines of ``cuts``, which may overlap."""
    return F.array_distinct(F.flatten(F.transform(cuts, lambda c: F.sequence(c["first"], c["last"]))))


def _rebuilt(text: Column, cuts: Column) -> Column:
    """The text without the lines of ``cuts``."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(_lines(text)) - 1), _gone(cuts))
    lines = F.transform(F.array(F.struct(_lines(text).alias("l"), kept.alias("k"))), lambda s: F.array_join(F.transform(s["k"], lambda i: F.get(s["l"], i)), "\n"))
    return F.when(cuts.isNull(), text).otherwise(F.element_at(lines, 1))


def _cleaned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text, key = F.col(f"input.`{text_col}`"), F.col(f"input.`{id_col}`")
    # a null id sorts last: the largest number with a mark of its own
    rows = docs.select(F.struct("*").alias("input")).select(
        F.coalesce(key, F.lit(2**63 - 1)).alias("id"), F.xxhash64(key.isNull(), text).alias("mark"), text.alias("text"), "input")
    cuts = repeats(rows)
    return rows.join(cuts, _KEY, "left").select("input", F.col("text").alias("before"), "cuts", _rebuilt(F.col("text"), F.col("cuts")).alias("after"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text column."""
    done = _cleaned(docs, id_col, text_col)
    return done.select(*[F.col("after").alias(c) if c == text_col else F.col(f"input.`{c}`").alias(c) for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, text_sha256`` (of the cleaned text) of each row."""
    done = _cleaned(docs, id_col, text_col)
    removed = F.coalesce(F.size(_gone(F.col("cuts"))), F.lit(0))
    return done.select(F.col(f"input.`{id_col}`").alias("doc_id"), F.size(_lines(whole("before"))).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"),
                       F.sha2(whole("after"), 256).alias("text_sha256"))
