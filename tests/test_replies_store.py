"""A store of replies: no prompt is asked twice, and failures are asked again."""

import time

import pytest
from pyspark.sql import functions as F

from papyrine.operators import replies_store as S


def counting(folder, fail=lambda prompt: False):
    """A classifier that leaves a file for each prompt it is asked."""

    def classifier():
        import uuid

        def reply(prompts):
            out = []
            for prompt in prompts:
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                    file.write(prompt)
                out.append(ValueError("no") if fail(prompt) else f"re: {prompt}")
            return out

        return reply

    return classifier


def calls(folder):
    return sorted(path.read_text() for path in folder.iterdir())


def test_a_prompt_is_asked_once(spark, tmp_path):
    asked, store = tmp_path / "asked", str(tmp_path / "store")
    asked.mkdir()
    rows = [(i, f"p{i % 30}", "kept") for i in range(300)] + [(900, None, "kept"), (901, "", "kept")]
    df = spark.createDataFrame(rows, "id int, prompt string, error string").repartition(5)
    ask = lambda frame, fail=lambda prompt: False, **more: S.ask_once(frame, counting(str(asked), fail), store, batch_size=4, round_batches=3, wait=0.01, **more)
    first = ask(df.filter("id < 100"), lambda prompt: prompt == "p7")
    got = {row.id: (row.reply, row.error) for row in first.collect()}
    assert first.columns == ["id", "prompt", "reply", "error"]
    assert got == {i: (None, "no") if i % 30 == 7 else (f"re: p{i % 30}", None) for i in range(100)}
    assert calls(asked) == sorted(f"p{i}" for i in range(30))
    again = {row.id: (row.reply, row.error) for row in ask(df).collect()}
    assert again == {i: (f"re: {p}", None) if p is not None else (None, None) for i, p, _ in rows}
    assert calls(asked) == sorted([f"p{i}" for i in range(30)] + ["p7", ""])  # what failed, and what is new
    ask(df, lambda prompt: True).collect()
    assert len(calls(asked)) == 32
    assert S.stored_replies(spark, store).count() == 31
    assert ask(df.filter("false")).collect() == []


def test_each_batch_is_a_task(spark, tmp_path):
    missing = spark.range(100).select(F.sha2(F.col("id").cast("string"), 256).alias("prompt"))
    sizes = []

    def classifier():
        return lambda prompts: [str(len(prompts))] * len(prompts)

    replied = S.ask_once(missing, classifier, str(tmp_path / "store"), batch_size=8)
    sizes = [int(row.reply) for row in replied.collect()]
    assert sorted(sizes) == [4] * 4 + [8] * 96


def test_retries_wait_longer_each_time_and_give_up():
    waits, tried = [], []

    def flaky(values):
        tried.append(values)
        if len(tried) < 3:
            raise OSError("busy")
        return values

    assert S.with_retries(flaky, 4, 0.5, None, waits.append)([1, 2]) == [1, 2]
    assert waits == [0.5, 1.0] and len(tried) == 3
    with pytest.raises(OSError):
        S.with_retries(lambda values: (_ for _ in ()).throw(OSError("busy")), 2, 1, None, waits.append)([1])
    assert waits == [0.5, 1.0, 1]


def test_a_late_batch_is_a_failure():
    start = time.perf_counter()
    with pytest.raises(TimeoutError, match="0.05"):
        S.with_retries(lambda values: time.sleep(2) or values, 2, 0, 0.05)([1])
    assert time.perf_counter() - start < 1.5
    assert S.with_retries(lambda values: values, 1, 0, 5)([1]) == [1]


def test_tasks_share_many_batches(spark, tmp_path, monkeypatch):
    assert S.task_number(13, 8) == 13 and S.task_number(10_000, 12) == 625 and S.task_number(100, 8) == 32
    monkeypatch.setattr(S, "TASKS_PER_CORE", 0)
    df = spark.range(100).select(F.col("id").cast("string").alias("prompt")).repartition(7)

    def classifier():
        return lambda prompts: [str(len(prompts))] * len(prompts)

    replied = S.ask_once(df, classifier, str(tmp_path / "store"), batch_size=2, round_batches=40)
    assert [row.reply for row in replied.collect()] == ["2"] * 100
