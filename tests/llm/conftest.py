import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [(row.doc_id, row.text) for row in docs.collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """Null and repeated ids, null, empty, blank, odd and very long texts, repeated rows."""
    pick = random.Random(7)
    long = " ".join(pick.choice(["alpha", "beta", "gamma", "delta", "épsilon", "zeta,"]) for _ in range(60_000))
    line = "A line of more than forty characters that several documents share.\n"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (4, "x"), (4, "other text of the same id"), (5, long), (6, long)]
    rows += [(7, "\U0001f600 \u0000   <|endoftext|> é"), (8, "12345 !!! 678"), (9, "a" * 5_000), (None, "no id"), (None, "no id")]
    rows += [(None, None), (10, line * 3), *((n, line + f"only in {n}") for n in range(11, 16)), (16, long[:400] + "tail")]
    return rows + [(17, "the und la de " * 20), (18, "\n" * 100)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The same as a table, with columns whose names clash with those of the operators."""
    names = "row key row_key _named named text_hash lines dropped n_lines n_dropped score lang_pred fingerprint hash marks shard"
    clashing = [(name, "string") for name in names.split()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` {t}" for n, t in clashing)
    table = [(i, text, "en" if k % 3 else None, None, len(text or ""), *(["x"] * len(clashing))) for k, (i, text) in enumerate(odd_rows)]
    return spark.createDataFrame(table, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
