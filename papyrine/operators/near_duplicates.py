"""Documents with nearly the same words, by MinHash.

A document is the set of its shingles, runs of `WIDTH` words. Each of many hash functions has its minimum over the set, and
two sets agree in such a minimum as often as they share shingles (Jaccard similarity). `ROWS` minima make a band; sets that
agree in a whole band meet in a bucket. Everything is expressions and joins; nothing runs in Python.

A bucket's members are compared with one of them, its pivot, exactly and by whole sets: as many comparisons as members, so a
bucket of thousands of near copies is settled in one pass. Where its members are still not all connected, a bucket of at most
`WHOLE` members is settled by all its pairs. A larger one is cut by the other bands: sets that are alike agree in many bands,
sets that share but a common footer don't. This goes on for `DEPTH` bands; what is then left apart is compared with ever more
pivots, four times as many in each round, until a round brings no link or all pairs were compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators.components import connected
from papyrine.sources.tables import materialize

WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 32, 4  # at the least similarity a pair shares no band with a probability of 5e-8
DEPTH = 3
WHOLE = 64  # a bucket with so many members is settled by all its pairs, each of which is compared once for all buckets
PART = 8  # bands whose minima are found in one pass
# Fixed value: words are runs of letters and digits, in lower case.
WORD = r"[\p{L}\p{N}]+"


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the different runs of `width` words; of all words where there are fewer; none without a word."""

    def of(words: Column) -> Column:
        runs = F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1)))
        hashes = F.array_distinct(F.transform(runs, lambda first: F.xxhash64(F.slice(words, first, width))))
        return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<long>"))

    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return F.element_at(F.transform(F.array(words), of), 1)  # the words travel in an array of one, found once


def _name(text: Column) -> Column:
    """Equal for texts of the same words in the same order: 16 bytes of their SHA-256."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return F.substring(F.unhex(F.sha2(F.array_join(words, " "), 256)), 1, 16)


def _minima(sets: DataFrame) -> DataFrame:
    """vertex, n (members of the set), part, and `buckets`, a number for each band of that part.

    Minima are taken before the shuffle, so many at a time as Java compiles.
    """
    members = sets.select("vertex", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    members = members.select("*", F.explode(F.sequence(F.lit(0), F.lit(BANDS // PART - 1))).alias("part"))
    width = PART * ROWS
    least = [F.min(F.xxhash64("h", F.col("part") * width + i)).alias(f"m{i}") for i in range(width)]
    found = members.groupBy("vertex", "part").agg(F.max("n").alias("n"), *least)
    buckets = [F.xxhash64("part", F.lit(b), *(f"m{b * ROWS + r}" for r in range(ROWS))) for b in range(PART)]
    return found.select("vertex", "n", "part", F.array(*buckets).alias("buckets"))


def _banded(minima: DataFrame) -> DataFrame:
    """(vertex, n, band, bucket)"""
    rows = minima.select("vertex", "n", "part", F.posexplode("buckets").alias("_place", "bucket"))
    return rows.select("vertex", "n", (F.col("part") * PART + F.col("_place")).alias("band"), "bucket")


def _shared(buckets: DataFrame) -> DataFrame:
    """(bucket, size, pivot, pivot_n) of the buckets with more than one member."""
    pivot = F.min_by(F.struct("vertex", "n"), F.xxhash64("vertex"))
    counted = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), pivot.alias("_pivot"))
    return counted.filter("size > 1").select("bucket", "size", F.col("_pivot.vertex").alias("pivot"), F.col("_pivot.n").alias("pivot_n"))


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, n_a, b, n_b) whose sets are alike, as links (a, b)."""
    sizes = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least  # no others can be
    asked = pairs.filter("a <> b").filter(sizes).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    asked = materialize(asked, "pairs")
    if asked.isEmpty():
        return asked
    needed = asked.select(F.col("a").alias("vertex")).union(asked.select("b")).distinct()
    known = materialize(sets.join(needed, "vertex", "left_semi"), "sets")
    both = asked.join(known.toDF("a", "_one"), "a").join(known.toDF("b", "_other"), "b")
    shared = F.size(F.array_intersect("_one", "_other"))
    return both.filter(shared >= (F.size("_one") + F.size("_other") - shared) * F.lit(least)).select("a", "b")


def _unsettled(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members (bucket, vertex, n, size, root) of the buckets that links do not connect yet; a bucket of two is settled."""
    roots = connected(links).toDF("vertex", "_root")
    rooted = members.join(roots, "vertex", "left").withColumn("root", F.coalesce("_root", "vertex")).drop("_root")
    ends = rooted.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("_first"), F.max("root").alias("_last"))
    return rooted.join(ends.filter("size > 2 AND _first <> _last").select("bucket", "size"), "bucket")


def _by_pivots(apart: DataFrame, sets: DataFrame, least: float, pivots: int) -> DataFrame:
    """Links between the members of each bucket and some `pivots` of them; all pairs where a bucket has no more members."""
    chosen = (F.col("size") <= pivots) | (F.pmod(F.xxhash64("vertex", "bucket"), F.col("size")) < pivots)
    one = apart.filter(chosen).select("bucket", F.col("vertex").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("_one"))
    other = apart.select("bucket", F.col("vertex").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("_other"))
    return _similar(one.join(other, "bucket").filter("_one <> _other"), sets, least)


def _links(minima: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    banded = _banded(minima)
    found = None
    for depth in range(DEPTH):
        shared = _shared(banded)
        members = materialize(banded.join(shared, "bucket"), "buckets")
        pairs = members.select(F.col("pivot").alias("a"), F.col("pivot_n").alias("n_a"), F.col("vertex").alias("b"), F.col("n").alias("n_b"))
        links = _similar(pairs, sets, least)
        found = links if found is None else found.union(links)
        found = materialize(found, "links")
        apart = materialize(_unsettled(members.select("bucket", "vertex", "n", "band"), found), "apart")
        found = materialize(found.union(_by_pivots(apart.filter(F.col("size") <= WHOLE), sets, least, WHOLE)), "links")
        apart = apart.filter(F.col("size") > WHOLE)
        if apart.isEmpty():
            return found
        if depth + 1 < DEPTH:  # by each later band
            others = _banded(minima).select("vertex", F.col("band").alias("_other"), F.col("bucket").alias("_bucket"))
            finer = apart.join(others, "vertex").filter("_other > band")
            banded = finer.select("vertex", "n", F.col("_other").alias("band"), F.xxhash64("bucket", "_bucket").alias("bucket")).distinct()
    pivots = WHOLE
    while True:
        apart = materialize(_unsettled(apart.select("bucket", "vertex", "n"), found), "apart")
        if apart.isEmpty():
            return found
        links = materialize(_by_pivots(apart, sets, least, pivots), "links")
        if links.isEmpty():
            return found
        found = materialize(found.union(links), "links")
        apart = apart.filter(F.col("size") > pivots)
        pivots *= 4


def near_duplicates(df: DataFrame, key: str = "pdf_path", text: str = "ocr_text", width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """`key` and `component`, the smallest key among the documents a row is linked to, itself included.

    Documents are linked when the Jaccard similarity of their shingle sets is `least` or more, or when their words are the same;
    no link is false, and a link is missed only where neither bands nor pivots bring the two together. A document without a
    word is linked to nothing. One row per row of `df`: rows without a key count as well, and a component of such rows only is
    null. Copies of a text are one vertex, so any number of them costs as much as one.
    """
    named = df.select(F.col(key).alias("_key"), _name(F.col(text)).alias("vertex"), shingles(F.col(text), width).alias("shingles"))
    named = materialize(named, "shingles")
    full = named.filter("size(shingles) > 0").select("vertex", "shingles")
    sets = full.groupBy("vertex").agg(F.first("shingles").alias("shingles"))
    minima = materialize(_minima(full), "minima")
    roots = connected(_links(minima, sets, least)).toDF("vertex", "_root")
    members = named.filter("size(shingles) > 0").select("_key", "vertex").join(roots, "vertex", "left")
    members = members.select("_key", F.coalesce("_root", "vertex").alias("_root"))
    least_key = members.groupBy("_root").agg(F.min("_key").alias("component"))
    grouped = members.join(least_key, "_root").select(F.col("_key").alias(key), "component")
    alone = named.filter("size(shingles) = 0").select(F.col("_key").alias(key), F.col("_key").alias("component"))
    return grouped.union(alone)
