"""Filters, lookups and list idioms on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordering import first_per_key, number_rows, running_total


# Result texts of the lookups.
BAD_POSITION = "Position must be greater than zero"
NOT_FOUND = "Not Found"
NO_YEAR = "Year not found"


def above_mean(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    """Rows above the mean of ``col``; the mean is always over the whole frame."""
    mean = df.agg(F.avg(col)).scalar()
    out = df.filter(F.col(col) > mean)
    return out.filter(where) if where is not None else out


def split_by_mean_of(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """Adds ``side``: ``lower`` below the other frame's mean, else ``ge``."""
    mean = other.agg(F.avg(other_col)).scalar()
    return df.withColumn("side", F.when(F.col(col) < mean, "lower").otherwise("ge"))


def at_minimum(df: DataFrame, col: str) -> DataFrame:
    """All rows that hold the minimum of ``col``."""
    return df.filter(F.col(col) == df.agg(F.min(col)).scalar())


def drop_duplicates_keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key, rows renumbered from 0 along ``order``."""
    return number_rows(first_per_key(df, key, order), order, "row")


def recode(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out.otherwise(default)


def contains_word_flag(col: Column, word: str) -> Column:
    return F.lower(col).contains(word.lower()).cast("int")


# Multiplier, increment and prime modulus of the portable row mask.
MASK_A, MASK_B, MASK_P = 48271, 11, 2147483647


def row_hash(key: Column) -> Column:
    """Portable pseudo-random integer of an integer key, the same in any SQL engine."""
    first = F.pmod(key * MASK_A + MASK_B, F.lit(MASK_P))
    return F.pmod(first * MASK_A + MASK_B, F.lit(MASK_P))


def hide_labels(df: DataFrame, key: str, share: float) -> DataFrame:
    """Adds ``hidden``, true for about ``share`` of the rows, by a hash of ``key``."""
    return df.withColumn("hidden", row_hash(F.col(key)) < int(share * MASK_P))


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows in hash order of ``key``."""
    return df.withColumn("_h", row_hash(F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def split_at_date(df: DataFrame, col: str, fmt: str, cutoff: str) -> DataFrame:
    """Parses ``col`` by ``fmt`` into ``date`` and adds ``period``: early up to the cutoff, else late."""
    out = df.withColumn("date", F.to_date(col, fmt))
    return out.withColumn("period", F.when(F.col("date") <= F.lit(cutoff).cast("date"), "early").otherwise("late"))


def word_in_document(doc: Column, word: str, mode: str = "token") -> Column:
    """Case-insensitive membership of a token, or of a substring on request."""
    low = F.lower(doc)
    if mode == "substring":
        return low.contains(word.lower())
    return F.array_contains(F.split(low, r"\s+"), word.lower())


def word_in_documents(docs: DataFrame, ids: DataFrame, key: str, text: str, word: str, mode: str = "token") -> DataFrame:
    """(id, found) for every asked id; an id with no document is false."""
    hit = docs.select(key, word_in_document(F.col(text), word, mode).alias("found"))
    return ids.join(hit, key, "left").select(key, F.coalesce("found", F.lit(False)).alias("found"))


def fixed_four(x: Column) -> Column:
    """Text of a share of 0 to 1 with four decimals, rounded as C's ``%.4f`` does: by the exact binary
    value, halves to the even digit.  Java's formatter rounds the shortest decimal text half up.
    """
    # the first 26 binary places and the rest: both products below are exact wherever a half can lie
    head = F.floor(x * float(1 << 26)) / float(1 << 26)
    whole = F.floor(head * 10000.0)
    over, rest = head * 10000.0 - whole - 0.5, (x - head) * 10000.0
    up = F.when(over > -rest, 1).when(over < -rest, 0).otherwise(F.pmod(whole, F.lit(2)))
    ten_thousandths = whole + up  # the rest is below 0.0002 of a unit here, so one step up is the most
    return F.format_string("%d.%04d", F.floor(ten_thousandths / 10000), F.pmod(ten_thousandths, F.lit(10000)))


def format_pvalue(p: Column, trials: int = 10000) -> Column:
    """Text of a simulated p-value with its standard error."""
    digits = len(str(trials)) - 1
    se = F.sqrt(p * (1 - p) / F.lit(float(trials)))
    return (
        F.when(p == 0, F.lit(f"<10^-{digits}"))
        .when(p == 1, F.lit(f">1-10^-{digits}"))
        .otherwise(F.format_string("%s ± %s", fixed_four(p), fixed_four(se)))
    )


def find_names(ranked: DataFrame, pattern: str, year: int) -> DataFrame:
    """(rank, name) of one year whose name matches; ``status`` tells an empty year apart."""
    hits = ranked.filter((F.col("year") == year) & F.col("name").rlike(pattern)).select(
        "rank", "name", F.lit("ok").alias("status"))
    known = ranked.filter(F.col("year") == year).agg(F.count(F.lit(1)).alias("n"))
    empty = known.filter("n = 0").select(
        F.lit(None).cast("bigint").alias("rank"), F.lit(None).cast("string").alias("name"),
        F.lit(NO_YEAR).alias("status"))
    return hits.unionByName(empty)


def name_at(ranked: DataFrame, asked: DataFrame) -> DataFrame:
    """Names for asked (year, position) rows with texts for bad and unknown positions."""
    r = ranked.select("year", F.col("rank").alias("position"), "name")
    return asked.join(r, ["year", "position"], "left").select(
        "year", "position",
        F.when(F.col("position") < 1, F.lit(BAD_POSITION))
        .otherwise(F.coalesce("name", F.lit(NOT_FOUND))).alias("name"))


def replace_year(ranked: DataFrame, new: DataFrame, year: int) -> DataFrame:
    """The ranking with one whole year replaced."""
    return ranked.filter(F.col("year") != year).unionByName(new.withColumn("year", F.lit(year)).select(*ranked.columns))


def rank_within(df: DataFrame, by: list[str], order: list, name: str = "rank") -> DataFrame:
    """1-based position inside each group along ``order``, with hot groups spread over tasks."""
    return running_total(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", order, by, name).drop("_one")


def pair_by_position(left: DataFrame, left_order: list, right: DataFrame, right_order: list, n: int) -> DataFrame:
    """Pairs the first ``n`` rows of two ordered frames; the shorter one ends the result."""
    lhs = number_rows(left.orderBy(*left_order).limit(n), left_order, "pos", 1)
    rhs = number_rows(right.orderBy(*right_order).limit(n), right_order, "pos", 1)
    return lhs.join(rhs, "pos")


def positions_by_category(df: DataFrame, category: str, order: list[str]) -> DataFrame:
    """(category, nth, position): the rows of each category in order of appearance.

    One row per position, so a frequent category is no single long list.
    """
    rows = number_rows(df.select(category, *order), order, "position")
    return rank_within(rows, [category], ["position"], "nth").select(category, "nth", "position")


def last_n_sorted(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.select(col).orderBy(F.desc(col)).limit(n).orderBy(col)


def reverse_ranks(df: DataFrame, order: list) -> DataFrame:
    """Adds ``rank`` counted from the end of ``order``: 0 for the last row."""
    flipped = [F.desc(c) if isinstance(c, str) else c for c in order]
    return number_rows(df, flipped, "rank")


def with_ties_top(df: DataFrame, count: str, k: int) -> DataFrame:
    """All rows whose count reaches the k-th largest count; every row when there are fewer than k."""
    kth = df.select(count).orderBy(F.desc(count)).limit(k).agg(F.min(count)).scalar()
    return df.filter(F.col(count) >= kth)


def anti(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    return df.join(other, key, "left_anti").select(*key).distinct()


def endpoints(edges: DataFrame, by: list[str] = ()) -> DataFrame:
    """Distinct endpoints of an edge table."""
    by = list(by)
    return edges.select(*by, F.col("src").alias("node")).unionByName(
        edges.select(*by, F.col("dst").alias("node"))).distinct()


def undirected(edges: DataFrame, by: list[str] = ()) -> DataFrame:
    """Distinct undirected edges without loops, ``src < dst``."""
    return edges.filter("src <> dst").select(
        *by, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def common_neighbours(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Size of the shared out-neighbour set for given (node, other) pairs, zero included."""
    near = edges.select(F.col("src").alias("node"), F.col("dst").alias("via"))
    far = edges.select(F.col("src").alias("other"), F.col("dst").alias("via"))
    shared = pairs.join(near, "node").join(far, ["other", "via"]).groupBy("node", "other").agg(F.count(F.lit(1)).alias("common"))
    return pairs.join(shared, ["node", "other"], "left").select("node", "other", F.coalesce("common", F.lit(0)).alias("common"))


def strongest_weights(weights: DataFrame, key: str, weight: str, k: int = 30) -> DataFrame:
    """The ``k`` rows of largest absolute weight with their ``side``; ties by key."""
    top = weights.orderBy(F.desc(F.abs(weight)), key).limit(k)
    return top.withColumn("side", F.when(F.col(weight) > 0, "positive").otherwise("negative"))
