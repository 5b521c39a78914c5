"""Suffix dedup where several texts have one doc_id."""

import random

from tests.llm import brute
from tests.llm.test_repeats import removed


def test_texts_of_one_id_are_not_taken_for_each_other(spark):
    pick = random.Random(41)
    noise = lambda n: "".join(pick.choice("abcdefghijklmnop ") for _ in range(n))
    rows = []
    for i in range(25):
        passage, other = noise(260), noise(260)
        rows += [(i, noise(100) + passage + noise(300)), (i, noise(100) + other + noise(300))]
        rows += [(100 + i, noise(30) + passage + noise(50)), (200 + i, noise(60) + other + noise(20))]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(df) == sorted(brute.repeated_bytes(rows), key=repr)
