import pytest


@pytest.fixture(autouse=True)
def shipped(spark):
    from vitrine.session import ship_package
    ship_package(spark)


LONG = "word %d and " * 3
CLASHING = "lang string, score double, copy string, rate string, fp string, `key` string, component_id string, " \
           "leaks string, log_weight string, text_2 string, label string, target string"


@pytest.fixture
def edge_docs(spark):
    """Null, empty, blank, very long and repeated rows, null ids, and columns with the operators' names."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
    rows = [(1, "the same text of some words here"), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, long + " more"),
            (7, "the same text of some words here"), (7, "the same text of some words here"), (None, "no id at all"),
            (None, None), (8, "héllo wörld ß 日本語 \U0001f642 <|endoftext|> end"), (9, "x"), (10, "!!! ??? ***")]
    extra = ("en", 0.5, "a", "b", "c", "d", "e", "f", "g", "h", "i", "j")
    return spark.createDataFrame([(i, t, "s1" if i and i % 2 else None, *extra) for i, t in rows],
                                 f"doc_id long, text string, source string, {CLASHING}")


@pytest.fixture
def empty_docs(edge_docs):
    return edge_docs.filter("false")
