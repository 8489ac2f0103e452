import pytest

from skyledger.llm.common import ship_package

LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
# Nulls in every column, empty and very long texts, ties, and repeated rows.
DOCS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta. Iota kappa!\nlambda mu", "en", "a"),
    (1, "alpha beta gamma delta epsilon zeta eta theta. Iota kappa!\nlambda mu", "en", "a"),
    (2, "", "en", "a"),
    (3, None, None, None),
    (None, "a text without an id, of some words", "de", "b"),
    (None, None, None, "b"),
    (4, LONG, "en", "b"),
    (5, LONG, "en", None),
    (6, "short", "fr", "c"),
    (6, "other text with the same id", "fr", "c"),
    (7, " \t\n ", "fr", "d"),
    (8, "naïve café 漢字 😀 words", "fr", "d"),
]
# Names that operators might use inside.
CLASHES = (
    "size", "order", "row", "key", "node", "cell", "skey", "target", "moments", "score", "statistics", "next", "range",
    "leaves", "spans", "text_key", "kind", "component", "directory", "payload", "label", "class_id", "start", "tie",
)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def messy(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("*", "cast(length(text) as long) as n_chars")
    return docs.selectExpr("*", *[f"'clash' as {name}" for name in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
