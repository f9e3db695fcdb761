import random

import pytest

CLASHING = ("key", "id", "row", "size", "start", "bucket", "kind", "digest", "node", "u", "v", "score", "no", "tag", "fp", "k", "t", "html2", "gone", "mark", "times", "_gone", "_mark", "_k", "_size")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)


def prose(n: int, seed: int, alphabet: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(alphabet)}" for _ in range(n))


def rows_of(texts):
    return [(i, t, "en", f"s{i % 3}" if i is not None and i % 7 else None, len(t) if t else None, *["x"] * len(CLASHING)) for i, t in texts]


@pytest.fixture(scope="session")
def edge_texts():
    """Nulls, empty and very long texts, copies, near copies, repeated rows, shared passages, odd white space."""
    base, shared = prose(300, 1), prose(40, 2)
    near = base.replace("w7 ", "w8 ")
    long = " ".join([prose(20000, 3, 5000), shared, prose(20000, 4, 5000)])
    return [(0, None), (1, ""), (2, base), (3, base), (4, near), (5, shared + " " + prose(30, 5)), (6, prose(25, 6) + "\n\t" + shared), (7, long),
            (8, "one two"), (9, "one two"), (10, "  \x0b "), (11, "a" * 5000), (12, "é▁ß 漢字 \U0001f600 \x00 z"), (13, shared), (13, shared), (None, base),
            (None, "alone here"), (14, "x " * 200), (15, "One TWO three"), (16, "one two three"), (17, "tail of words here " * 9)]


@pytest.fixture(scope="session")
def edge(spark, edge_texts):
    return spark.createDataFrame(rows_of(edge_texts), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
