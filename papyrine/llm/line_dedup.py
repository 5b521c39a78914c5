"""Lines that many documents share, kept in one of them. SQL functions only.

The hashes of long lines are range-partitioned and sorted by hash, document and position. A line that fills much of the
corpus has many documents; these are dealt over `STREAMS` streams of a line, so that ranges can end between them. A pass over each
range finds the first line of every document in a stream, and what the streams know of a hash is added up. What is decided of
a hash goes back to its streams, so that no task sees a common line as a whole. The result is no text but one keep bitmap
per document, compressed to its runs of dropped lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.llm.scratch import write_and_read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE_SPACE = "\t\n\x0b\x0c\r "
LINE = ["_h1", "_h2"]  # a line's hash, 128 bits
STREAMS = 64  # parts of the documents of one line


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """What makes two lines the same: white space at the ends and the case of A-Z do not count."""
    return F.translate(F.btrim(line, F.lit(WHITE_SPACE)), UPPER, LOWER)


def _row_names(doc_id: Column, text: Column) -> list[Column]:
    """What tells rows apart: whether they have a doc_id, that or a hash of the text, and a hash of the text."""
    hashed = F.xxhash64(text)
    return [doc_id.isNotNull().alias("named"), F.coalesce(doc_id, hashed).alias("row_key"), hashed.alias("text_hash")]


def repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: named, row_key, text_hash (see `_row_names`) and dropped.

    Lines whose key has at least `least_chars` code points and occurs in at least `least_docs` documents go from all but
    the largest doc_id that holds the key, where all of them stay. `dropped` are the runs of dropped lines, structs
    (first, last) of 0-based positions in order. Rows of one doc_id count as one document. Rows without a doc_id count
    as one document each and come before those with one, in the order of a hash of their text.
    """
    keyed = docs.select(*_row_names(F.col("doc_id"), F.col("text")), "text")
    places = F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("_place", "_key")
    hashes = keyed.select("named", "row_key", "text_hash", places).filter(F.char_length("_key") >= least_chars)
    stream = F.pmod(F.xxhash64("named", "row_key"), F.lit(STREAMS)).cast("int").alias("_stream")
    line = [F.xxhash64("_key").alias(LINE[0]), F.xxhash64(F.lit(1), "_key").alias(LINE[1])]
    found = write_and_read(hashes.select(*line, stream, "named", "row_key", "text_hash", "_place"), "line-hashes")
    streams = write_and_read(_streams(found), "line-streams")
    common = (
        streams.groupBy(*LINE)
        .agg(F.sum("_docs").alias("_docs"), F.max("_any").alias("_any"), F.max("_last").alias("_keeper"))
        .filter(F.col("_docs") >= least_docs)
        .select(*LINE, F.col("_keeper").isNotNull().alias("_keeper_named"), F.coalesce("_keeper", "_any").alias("_keeper"))
    )
    decided = streams.select(*LINE, "_stream").join(common, LINE)
    kept = (F.col("named") == F.col("_keeper_named")) & (F.col("row_key") == F.col("_keeper"))
    dropped = found.join(decided, [*LINE, "_stream"]).filter(~kept)
    positions = F.sort_array(F.collect_set("_place"))
    return dropped.groupBy("named", "row_key", "text_hash").agg(_runs(positions).alias("dropped"))


def _streams(found: DataFrame) -> DataFrame:
    """Of each line and stream: _docs, how many documents hold the line, the greatest row_key, _any, and that with a doc_id, _last.

    The ranges are sorted once; a document's first line is the one that another document's, or nothing, precedes.
    """
    key, document = [*LINE, "_stream"], ["named", "row_key"]
    ordered = found.repartitionByRange(*key).sortWithinPartitions(*key, *document, "_place")
    before = F.lag(F.struct(*document)).over(Window.partitionBy(*key).orderBy(*document, "_place"))
    first = ordered.withColumn("_before", before).filter(F.col("_before").isNull() | (F.col("_before") != F.struct(*document)))
    return first.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_docs"), F.max("row_key").alias("_any"), F.max(F.when(F.col("named"), F.col("row_key"))).alias("_last")
    )


def _runs(positions: Column) -> Column:
    """Runs of consecutive numbers in a sorted array."""
    firsts = F.filter(positions, lambda x, i: (i == 0) | (F.get(positions, i - 1) != x - 1))
    lasts = F.filter(positions, lambda x, i: (i == F.size(positions) - 1) | (F.get(positions, i + 1) != x + 1))
    return F.arrays_zip(firsts.alias("first"), lasts.alias("last"))


def drop_repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """All columns of `docs` with `text` less its repeated lines, n_lines (before) and n_dropped.

    A null or empty text is one empty line and its new text is empty. See `repeated_lines` for which lines go. Repeated
    rows lose the same lines; a line is only counted once per doc_id. The other columns, whatever their names, stay as they
    are, but for n_lines and n_dropped, which are replaced. An empty table stays empty.
    """
    bitmaps = write_and_read(repeated_lines(docs, least_chars, least_docs), "line-bitmaps")
    # All columns travel in a struct, so that none can be taken for one of ours.
    row, text = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), F.col("text")
    rows = docs.select(row, *_row_names(F.col("doc_id"), text))
    joined = rows.join(bitmaps, [name for name in bitmaps.columns if name != "dropped"], "left")
    split = joined.select("row", "dropped", lines_of(F.col("row.text")).alias("lines"))
    lines, runs = F.col("lines"), F.col("dropped")

    def kept_part(i: Column) -> Column:
        """The lines before run i, or after the last one."""
        first = F.when(i == 0, F.lit(0)).otherwise(F.get(runs, i - 1)["last"] + 1)
        end = F.when(i == F.size(runs), F.size(lines)).otherwise(F.get(runs, i)["first"])
        return F.slice(lines, first + 1, end - first)

    parts = F.transform(F.sequence(F.lit(0), F.size(runs)), kept_part)
    lost = F.aggregate(runs, F.lit(0), lambda n, run: n + run["last"] - run["first"] + 1)
    kept = F.when(runs.isNull(), F.coalesce(F.col("row.text"), F.lit(""))).otherwise(F.array_join(F.flatten(parts), "\n"))
    return split.select(
        *[kept.alias(name) if name == "text" else F.col(f"row.`{name}`") for name in docs.columns if name not in ("n_lines", "n_dropped")],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
    )
