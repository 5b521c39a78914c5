"""Replies of a costly classifier, kept so that no prompt is paid for twice.

A store is a folder of Parquet files with one row per prompt that has been answered: the prompt's hash, the reply, and when it
came. Before a call, prompts are made distinct and those with an answer are left out by an anti-join. Calls go out in batches,
in rounds of `round_batches`; what a round brought is appended to the store before the next one begins. A batch is a task by
itself while there are few for each core, then a task has up to `TASK_BATCHES` of them. So a task that fails repeats so many
batches, and a job that fails loses one round.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.operators.hooks import Factory, _in_batches
from papyrine.operators.ordering import number_in_any_order
from papyrine.sources.tables import materialize

TASK_BATCHES = 16  # a task costs some tenths of a second by itself
TASKS_PER_CORE = 4  # with fewer batches, each is a task
STORE_SCHEMA = "prompt_hash string, reply string, answered_at timestamp"


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def stored_replies(spark: SparkSession, store: str) -> DataFrame:
    """What is in the store, of several replies to a prompt the earliest; nothing if the folder is not there yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], STORE_SCHEMA)
    rows = spark.read.schema(STORE_SCHEMA).parquet(store)
    first = F.min(F.struct("answered_at", "reply")).alias("_first")
    return rows.groupBy("prompt_hash").agg(first).select("prompt_hash", "_first.reply", "_first.answered_at")


def with_retries(
    function: Callable[[list], list], tries: int, wait: float, limit: float | None, sleep: Callable[[float], None] = time.sleep
) -> Callable[[list], list]:
    """`function` called up to `tries` times while it raises or takes longer than `limit` seconds.

    Before each further call it waits `wait` seconds, then twice as long, and so on. A call that is late goes on in a thread of its
    own and its result is dropped. The last failure is raised.
    """

    def once(values: list) -> list:
        if limit is None:
            return list(function(values))
        pool = ThreadPoolExecutor(1)
        try:
            return pool.submit(lambda: list(function(values))).result(limit)
        except Late:
            raise TimeoutError(f"no reply within {limit:g} seconds") from None
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    def call(values: list) -> list:
        for attempt in range(tries):
            try:
                return once(values)
            except Exception:
                if attempt + 1 == tries:
                    raise
                sleep(wait * 2**attempt)
        return []

    return call


def task_number(batches: int, cores: int) -> int:
    """How many tasks share the batches of a round."""
    return max(min(batches, cores * TASKS_PER_CORE), -(-batches // TASK_BATCHES))


def _ask(batches: DataFrame, classifier: Factory, size: int, tries: int, wait: float, limit: float | None) -> DataFrame:
    """prompt_hash, reply, error, answered_at for the rows (prompt_hash, prompt) of each partition, `size` prompts at a time."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in (part.slice(start, size) for part in rows for start in range(0, part.num_rows, size)):
            function = function or with_retries(classifier(), tries, wait, limit)
            results = _in_batches(function, batch.column("prompt").to_pylist(), size)
            replies, errors = (list(column) for column in zip(*results, strict=True))
            now = pa.scalar(int(time.time() * 1e6), pa.timestamp("us", "UTC"))
            columns = [batch.column("prompt_hash"), pa.array(replies, pa.string()), pa.array(errors, pa.string()), pa.array([now.as_py()] * batch.num_rows, pa.timestamp("us", "UTC"))]
            yield pa.RecordBatch.from_arrays(columns, names=["prompt_hash", "reply", "error", "answered_at"])

    return batches.mapInArrow(run, "prompt_hash string, reply string, error string, answered_at timestamp")


def ask_once(
    df: DataFrame,
    classifier: Factory,
    store: str,
    prompt: str = "prompt",
    batch_size: int = 64,
    round_batches: int = 10_000,
    tries: int = 3,
    wait: float = 1.0,
    limit: float | None = 300.0,
) -> DataFrame:
    """Add `reply` and `error` to the rows of `df`, calling the classifier for prompts without a reply in `store` only.

    `classifier()` is called once per task and returns a function from a list of at most `batch_size` prompts to replies; a reply that
    is an Exception is that prompt's failure. A batch that raises or takes longer than `limit` seconds is tried `tries` times, with
    waits that double, and then prompt by prompt. Failures are not stored, so another run asks again. Equal prompts are
    asked once; a null prompt is not asked and has neither reply nor error. Rows of a hot prompt are joined with its reply by a join
    that adaptive execution splits.
    """
    spark = df.sparkSession
    asked = df.filter(F.col(prompt).isNotNull()).select(prompt_hash(F.col(prompt)).alias("prompt_hash"), F.col(prompt).alias("prompt"))
    distinct = asked.groupBy("prompt_hash").agg(F.first("prompt").alias("prompt"))
    missing = distinct.join(stored_replies(spark, store).select("prompt_hash"), "prompt_hash", "left_anti")
    numbered = number_in_any_order(missing, "_row").withColumn("_batch", F.floor(F.col("_row") / batch_size))
    numbered = materialize(numbered, "asked")  # with its place in a batch, so that a round reads its part only
    total = numbered.count()
    failures = None
    if total:
        last = (total - 1) // batch_size
        for first in range(0, last + 1, round_batches):
            some = numbered.filter(F.col("_batch").between(first, first + round_batches - 1))
            batches = min(round_batches, last + 1 - first)
            tasks = task_number(batches, spark.sparkContext.defaultParallelism)
            dealt = some.repartitionById(tasks, ((F.col("_batch") - first) % tasks).cast("int")).select("prompt_hash", "prompt")
            replied = materialize(_ask(dealt, classifier, batch_size, tries, wait, limit), "replies")
            replied.filter("error IS NULL").drop("error").write.mode("append").parquet(store)
            failed = replied.filter("error IS NOT NULL").select("prompt_hash", "error")
            failures = failed if failures is None else failures.union(failed)
    known = stored_replies(spark, store).select("prompt_hash", F.lit(True).alias("_stored"), F.col("reply").alias("_reply"))
    known = known.withColumn("_error", F.lit(None).cast("string"))
    if failures is not None:
        known = known.unionByName(failures.select("prompt_hash", F.lit(False).alias("_stored"), F.lit(None).cast("string").alias("_reply"), F.col("error").alias("_error")))
    joined = df.withColumn("_hash", prompt_hash(F.col(prompt))).join(known.withColumnRenamed("prompt_hash", "_hash"), "_hash", "left")
    return joined.select(*(F.col(f"`{name}`") for name in df.columns if name not in ("reply", "error")), F.col("_reply").alias("reply"), F.col("_error").alias("error"))
