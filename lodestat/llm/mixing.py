"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source starts with the same copy number, target over source size.  Its
whole part is taken for sure; the fractions are rounded together: two documents at a time,
words move at random from one to the other until one fraction is 0 or 1.  Each move keeps
the words of the pair and every document's expectation, so a source misses its target by no
more than half of the one document that is left over.

The pairs form a tree: groups of about ``FAN`` documents fold to one residual each, groups of
``FAN`` residuals to one, and so on; the groups of a level are independent tasks and none
grows with its source.

Defined cases: null text has no words; documents without words are never taken; rows equal
in id, source and size are rounded one by one, and as many of them as the rounding says are
taken, whichever; a null source is a source of its own, ordered
last; without any words all targets are 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import WORD, narrow, small, whole
from lodestat.operators.ordering import number_rows, running_total
from lodestat.session import cut

FAN = 64
WEIGHTS = (1, 2, 3)
MOST = 3  # copies of a document at most
_SOURCE = ["no_source", "source"]
_TINY = 1e-12


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, no_source, source, size`` of each row, written once."""
    rows = narrow(docs, doc_id=id_col, text=text_col, source=source_col)
    return cut(rows.select("doc_id", F.col("source").isNull().alias("no_source"), whole("source").alias("source"),
                           F.regexp_count(whole("text"), F.lit(WORD)).cast("long").alias("size")))


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: ``source_size, target``.

    Sources in code point order weigh ``weights`` in turn.  A target stops at ``most`` times
    its source; filling up by weight ends where no target is above its stop, at the level
    where min(stop, level x weight) adds up to all words.
    """
    per = sized.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    ranked = number_rows(per, _SOURCE, "rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights)).cast("int") + 1))
    ranked = ranked.withColumn("stop", F.col("source_size") * F.lit(float(most))).withColumn("full", F.col("stop") / F.col("weight"))
    order = ["full", *_SOURCE]
    filled = running_total(running_total(ranked, "stop", order, name="stops"), "weight", order, name="weights")
    total = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("all_weights"))
    # the level reached when the sources before this one have stopped and the rest share by weight
    level = (F.col("words") - (F.col("stops") - F.col("stop"))) / (F.col("all_weights") - (F.col("weights") - F.col("weight")))
    settled = filled.crossJoin(F.broadcast(total)).withColumn("level", level)  # one row on the right
    reached = settled.filter(F.col("level") <= F.col("full")).agg(F.min_by("level", F.struct(*order)).alias("level"))
    out = filled.crossJoin(F.broadcast(reached))  # one row on the right
    return cut(out.select(*_SOURCE, "source_size", F.least(F.col("stop"), F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target")))


def _let(value: Column, then) -> Column:
    """``then`` of a value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _settle(held: Column, item: Column) -> Column:
    """Move words between the held document and the next one until one is settled.

    Both are structs of ``size, key, part, draw``.  Result: the settled document's key,
    whether it is taken, and the document that goes on.
    """
    give = F.least((1 - held["part"]) * held["size"], item["part"] * item["size"])  # words that may move to held
    take = F.least(held["part"] * held["size"], (1 - item["part"]) * item["size"])  # words that may move to item

    def moved(w: Column) -> Column:
        # the chance of a move is the other move's length, so expectations stay
        words = F.when(item["draw"] * (w["give"] + w["take"]) < w["take"], w["give"]).otherwise(-w["take"])
        return F.struct((held["part"] + words / held["size"]).alias("a"), (item["part"] - words / item["size"]).alias("b"))

    def outcome(p: Column) -> Column:
        whole_held = (p["a"] <= _TINY) | (p["a"] >= 1 - _TINY)
        done, taken, rest, part = (F.when(whole_held, x).otherwise(y) for x, y in (
            (held, item), (p["a"] > 0.5, p["b"] > 0.5), (item, held), (p["b"], p["a"])))
        return F.struct(done["key"].alias("key"), taken.alias("taken"),
                        F.struct(rest["size"].alias("size"), rest["key"].alias("key"), part.alias("part"), rest["draw"].alias("draw")).alias("rest"))

    return _let(_let(F.struct(give.alias("give"), take.alias("take")), moved), outcome)


def _fold(items: Column) -> Column:
    """The documents of one group in turn: those settled, and the residual."""

    def step(state: Column, item: Column) -> Column:
        return _let(_settle(state["rest"], item), lambda r: F.struct(
            F.concat(state["done"], F.array(F.struct(r["key"].alias("key"), r["taken"].alias("taken")))).alias("done"), r["rest"].alias("rest")))

    kind = "array<struct<key:struct<doc_id:bigint,size:bigint,copy:bigint>,taken:boolean>>"
    start = F.struct(F.array().cast(kind).alias("done"), F.element_at(items, 1).alias("rest"))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, step)


def rounded(parts: DataFrame, seed: int = 0, fan: int = FAN) -> DataFrame:
    """Round the fraction ``part`` of each item (``no_source, source, doc_id, size, copy, part``) to 0 or 1.

    Result: the same keys and ``extra`` (0 or 1).
    """
    counts = parts.groupBy(*_SOURCE).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    draw = F.pmod(F.xxhash64("doc_id", "size", "copy", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # longest first: the short ones then level out what the long ones left open
    item = F.struct(F.col("size").cast("double").alias("size"), F.struct("doc_id", "size", "copy").alias("key"), "part", draw.alias("draw"))
    groups = F.ceil(F.col("n") / F.lit(fan))
    level = (parts.join(small(counts), _SOURCE)
             .select(*_SOURCE, F.pmod(F.xxhash64("doc_id", "size", "copy", F.lit(seed + 1)), groups).alias("group"), item.alias("item")))
    settled, width = None, -(-most // fan)
    while True:
        folded = cut(level.groupBy(*_SOURCE, "group").agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
                     .select(*_SOURCE, "group", _fold(F.col("items")).alias("f")))
        done = folded.select(*_SOURCE, F.explode("f.done").alias("d")).select(*_SOURCE, "d.key.*", F.col("d.taken").cast("int").alias("extra"))
        settled = done if settled is None else settled.unionByName(done)
        if width <= 1:
            break
        # a residual draws anew on each level
        again = F.pmod(F.xxhash64("f.rest.key", F.lit(width)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        level = folded.select(*_SOURCE, F.floor(F.col("group") / fan).alias("group"), F.struct(
            F.col("f.rest.size"), F.col("f.rest.key"), F.col("f.rest.part"), again.alias("draw")).alias("item"))
        width = -(-width // fan)
    last = folded.select(*_SOURCE, "f.rest.key.*", (F.col("f.rest.part") >= 0.5).cast("int").alias("extra"))
    return settled.unionByName(last)


_KEY = [*_SOURCE, "doc_id", "size"]


def plan(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Rows as ``sizes`` has them, and one row per key of these: ``source_size, target, sure`` (copies for certain),
    ``m`` (rows of the key) and ``extra`` (how many of them are taken once more)."""
    sized = sizes(docs, id_col, text_col, source_col)
    goal = small(targets(sized, weights, most))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    keys = cut(sized.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("m")).join(goal, _SOURCE).withColumn("sure", F.floor(copies + _TINY))
               .withColumn("part", F.greatest(copies - F.col("sure"), F.lit(0.0))))
    open_ = keys.filter((F.col("size") > 0) & (F.col("part") > _TINY))
    # equal rows are items of their own, told apart by their copy number
    items = open_.select(*_KEY, "part", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("copy"))
    extra = rounded(items, seed).groupBy(*_KEY).agg(F.sum("extra").alias("extra"))
    on = [F.col(f"k.{c}").eqNullSafe(F.col(f"e.{c}")) for c in _KEY]
    told = keys.alias("k").join(extra.alias("e"), on, "left").select("k.*", F.coalesce("e.extra", F.lit(0)).alias("extra"))
    return sized, cut(told.drop("part"))


def _copies(rows: DataFrame) -> DataFrame:
    """Adds ``copies`` to rows that carry their key's ``sure, m, extra``.

    Only rows of a key that is taken in part are numbered, and a hot key is spread for it.
    """
    count = lambda more: F.when(F.col("size") > 0, F.col("sure") + more.cast("long")).otherwise(0).cast("long")
    partly = (F.col("extra") > 0) & (F.col("extra") < F.col("m"))
    plain = rows.filter(~partly).withColumn("copies", count(F.col("extra") > 0))
    numbered = running_total(rows.filter(partly).withColumn("_one", F.lit(1).cast("long")).withColumn("_id", F.monotonically_increasing_id()), "_one", ["_id"], _KEY, "_no")
    return plain.unionByName(numbered.withColumn("copies", count(F.col("_no") <= F.col("extra"))).drop("_one", "_id", "_no"))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: ``doc_id, no_source, source, size, source_size, target, copies``."""
    sized, told = plan(docs, weights, most, seed, id_col, text_col, source_col)
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in _KEY]
    rows = sized.alias("r").join(told.alias("t"), on).select("r.*", "t.source_size", "t.target", "t.sure", "t.m", "t.extra")
    return _copies(rows).select("doc_id", "no_source", "source", "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns."""
    _, told = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    packed = docs.select(F.struct("*").alias("row"))
    have = (F.col(f"row.`{source_col}`").isNull(), whole(F.col(f"row.`{source_col}`")), F.col(f"row.`{id_col}`"),
            F.regexp_count(whole(F.col(f"row.`{text_col}`")), F.lit(WORD)).cast("long"))
    on = [h.eqNullSafe(F.col(c)) for h, c in zip(have, _KEY)]
    taken = _copies(packed.join(told.filter((F.col("size") > 0) & (F.col("sure") + F.col("extra") > 0)), on)).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
