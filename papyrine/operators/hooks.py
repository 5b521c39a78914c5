"""Where users plug in code that Spark has no expression for: page readers, text recognition, classifiers.

Each hook takes a factory. It is called once per task, so models and clients are loaded there and never shipped, and it
returns a function that handles a list of values at once, as models on a GPU and overlapping requests want it. What goes
wrong ends up in the row, not in the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrine.functions.texts import NULL_PATH_ERROR, extract_error, null_path_error

Factory = Callable[[], Callable[[list], Iterable]]

PAGE_SCHEMA = "pdf_path string, page_no int, text string, error string"
_PAGE_COLUMNS = ["pdf_path", "page_no", "text", "error"]
_PAGE_TYPES = pa.schema([("pdf_path", pa.string()), ("page_no", pa.int32()), ("text", pa.string()), ("error", pa.string())])
_FLUSH_ROWS = 1_000


def _text_maker() -> Callable[[Any], str | None]:
    """What user code returns as a string Arrow accepts: page readers do produce lone surrogates."""
    return lambda value: None if value is None else str(value).encode("utf-8", "replace").decode("utf-8")


def _attempt(function: Callable[[list], Iterable], values: list) -> list[tuple[Any, str | None]]:
    """(value, error) for each of `values`. If a list fails as a whole, its values are tried one by one."""
    to_text = _text_maker()

    def failed(failure: BaseException) -> tuple[None, str]:
        return None, to_text(failure) or type(failure).__name__

    try:
        results = list(function(values))
        if len(results) != len(values):
            raise ValueError(f"{len(results)} results for {len(values)} values")
    except Exception as failure:
        return [failed(failure)] if len(values) == 1 else [one for value in values for one in _attempt(function, [value])]
    return [failed(one) if isinstance(one, Exception) else (to_text(one), None) for one in results]


def _in_batches(function: Callable[[list], Iterable], values: list, size: int) -> list[tuple[Any, str | None]]:
    """The same for any number of values, `size` at a time; null in, (null, null) out."""
    present = [place for place, value in enumerate(values) if value is not None]
    results: list[tuple[Any, str | None]] = [(None, None)] * len(values)
    for start in range(0, len(present), size):
        places = present[start : start + size]
        for place, result in zip(places, _attempt(function, [values[i] for i in places]), strict=True):
            results[place] = result
    return results


def append_result(df: DataFrame, factory: Factory, source: str, target: str, batch_size: int = 64) -> DataFrame:
    """Add struct column `target` with `value`, the function's result for `source`, and `error`, why there is none.

    `factory()`'s function takes a list of at most `batch_size` values and returns as many results; a result that is an
    Exception is that value's failure. Only `source` goes to Python. An array column is handled element by element and gives
    an array. The function is marked as not deterministic, so that no filter on its result makes Spark call it a second time.
    """
    nested = isinstance(df.schema[source].dataType, T.ArrayType)
    one = "struct<value: string, error: string>"

    @F.arrow_udf(f"array<{one}>" if nested else one)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = factory()
        kind = pa.struct([("value", pa.string()), ("error", pa.string())])
        for batch in batches:
            values = batch.to_pylist()
            flat = [x for row in values for x in row or []] if nested else values
            results = [{"value": value, "error": error} for value, error in _in_batches(function, flat, batch_size)]
            if not nested:
                yield pa.array(results, kind)
                continue
            found = iter(results)
            rows = [None if row is None else [next(found) for _ in row] for row in values]
            yield pa.array(rows, pa.list_(kind))

    return df.withColumn(target, run.asNondeterministic()(F.col(source)))


def extract_pages(
    files: DataFrame,
    reader: Callable[[], Callable[..., Iterable[str | None]]],
    path: str = "path",
    content: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Page rows (pdf_path, page_no, text, error) of files; pages count from 1.

    `reader()` returns a function from path, or from path and bytes if `content` names a column, to the texts of the pages
    in order. A file that fails gives one more row, with the error. `partitions` sets how many tasks share the work.
    Whole files travel in batches that Spark bounds in bytes (spark.sql.execution.arrow.maxBytesPerBatch).
    """
    columns = [path] if content is None else [path, content]
    to_text = _text_maker()

    def pages_of(read: Callable[..., Iterable[str | None]], values: list[Any]) -> Iterator[tuple]:
        name = values[0]
        if name is None:
            yield None, None, None, NULL_PATH_ERROR
            return
        try:
            for number, text in enumerate(read(*values), start=1):
                yield name, number, to_text(text), None
        except Exception as failure:
            yield name, None, None, to_text(failure) or type(failure).__name__

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), _PAGE_TYPES.types)]
        return pa.RecordBatch.from_arrays(arrays, _PAGE_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader()
        rows: list[tuple] = []
        for batch in batches:
            for values in zip(*(batch.column(name).to_pylist() for name in columns)):
                for row in pages_of(read, list(values)):
                    rows.append(row)
                    if len(rows) >= _FLUSH_ROWS:
                        yield to_batch(rows)
                        rows = []
        if rows:
            yield to_batch(rows)

    selected = files.select(*columns)
    return (selected.repartition(partitions) if partitions else selected).mapInArrow(run, PAGE_SCHEMA)


def extract_markdown(
    df: DataFrame, extractor: Factory, partitions: int | None = None, path: str = "pdf_path", batch_size: int = 64
) -> DataFrame:
    """Add `md_extraction_result`, what `extractor()`'s function makes of the path, and `error`, why it failed.

    A failure leaves an error text as the result; a result of None is none, and no failure. With `partitions` rows are
    first dealt out evenly over so many tasks, as each may take seconds.
    """
    rows = df.drop("error")
    done = append_result(rows.repartition(partitions) if partitions else rows, extractor, path, "_markdown", batch_size)
    failure = F.when(F.col(path).isNull(), null_path_error()).otherwise(F.col("_markdown.error"))
    shown = F.when(F.col(path).isNull(), null_path_error()).when(F.col("_markdown.error").isNotNull(), extract_error(F.col(path)))
    return (
        done.withColumn("error", failure)
        .withColumn("md_extraction_result", F.coalesce(shown, "_markdown.value"))
        .drop("_markdown")
    )
