import os

import pytest

from docklens.llm.shipping import ship

FOLDER = os.environ.get("DOCKLENS_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return FOLDER


#: Texts with the cases that every operator must take: null, empty, blank, one word,
#: other scripts and white space, line feeds, a long text, equal texts and a repeated row.
LONG = " ".join(f"word{n % 997} of line{n % 31}." for n in range(30_000))
TEXTS = [
    (1, "One small text about a river. It runs to the sea."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "word"),
    (6, "Ünïcode 漢字テキスト。 ça va? naïve space wide \U0001f600 end."),
    (7, "a  b\n\n c\td \r\n  e' don't we'll 12 345,6 x\u0085y \x1c z"),
    (8, LONG),
    (9, "One small text about a river. It runs to the sea."),
    (9, "One small text about a river. It runs to the sea."),
    (None, "a row without an id."),
    (10, LONG + " more"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The cases above, with columns that are named like results."""
    rows = [(i, t, "x", 1.5, "y", 3, "z", None) for i, t in TEXTS]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, kept string, score double, component_id string, shard int, "
        "`a.b c` string, cleaned long",
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
