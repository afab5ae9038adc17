from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from (doc_id, text); columns named as operators might name their own."""

    def make(rows, id_type="bigint"):
        full = [(i, t, "en", "s", 0 if t is None else len(t), f"k{n}", n) for n, (i, t) in enumerate(rows)]
        schema = f"doc_id {id_type}, text string, lang string, source string, n_chars bigint, key string, removed int"
        return spark.createDataFrame(full, schema).repartition(3)

    return make


LONG = " ".join(f"word{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls, empty and very long texts, repeated rows, ties, and a null id."""
    return documents(
        [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, LONG), (6, "one two"), (6, "one two"), (7, "one two"), (None, "x"), (None, "one two"), (8, "Ünï ß 漢字 😀.")]
    )


@pytest.fixture(scope="session")
def none(documents):
    return documents([])
