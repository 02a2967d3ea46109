from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

#: Columns whose names clash with what operators make on their way.
CLASHING = (
    "shard slot size start block tie number turn removed spans fp component_id score label "
    "passages n_tokens held_out predicted words codes bucket values ids h l begin end first "
    "key row fp root p c copies place least component __id __tie __key __bucket __hash __spans"
).split()


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text, source) rows, if asked with clashing columns."""

    def make(rows, clashing=False):
        full = [(i, t, None, s, None if t is None else len(t)) for i, t, *rest in rows for s in (rest or ["a"])]
        frame = spark.createDataFrame(full, DOCUMENTS)
        if clashing:
            from pyspark.sql import functions as F

            frame = frame.withColumns({c: F.lit("x") for c in CLASHING})
        return frame

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long text, ties and repeated rows."""
    long = " ".join(f"word{i % 977} and" for i in range(20_000))
    return [
        (None, None),
        (None, "some text without an id."),
        (1, ""),
        (2, " \n\t "),
        (3, long),
        (4, "One sentence here. Another one follows it."),
        (4, "One sentence here. Another one follows it."),
        (4, "The same id with a different text."),
        (5, None),
        (6, "One sentence here. Another one follows it."),
    ]
