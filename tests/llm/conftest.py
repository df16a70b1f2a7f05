import re

import pytest

from cardwarden.session import ship_package

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, id string, row string, part int, fp string, n double, k1 string, place int"


@pytest.fixture(scope="session")
def shipped(spark):
    return ship_package(spark)


@pytest.fixture(scope="session")
def docs_of(shipped):
    """Documents with further columns whose names the operators use inside; some of them missing."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, None, f"r{i}", 7, None, 0.5, None, None) for i, t in zip(ids, texts)]
        return shipped.createDataFrame(rows, COLUMNS)

    return make


PASSAGE = " ".join(f"word{i}" for i in range(60))

EDGE_TEXTS = [
    None, "", " \n\t ", "a", "A b", "The QUICK brown fox", "the quick brown fox", "the  quick\nbrown fox",
    "naïve ÉCOLE übergroß ΑΣ don't we'll", "snow \U0001f600 ́x <|endoftext|> '", "x" * 3000, "la " * 4000,
    f"start {PASSAGE} end", f"other {PASSAGE} tail of it", "same text here", "same text here", "same text here",
    " lead", "lead", "trail ", " nbsp em", "123 4567 8,9.",
]


@pytest.fixture(scope="session")
def edge(docs_of):
    """Missing and repeated ids, missing, empty, long and equal texts, over several partitions."""
    ids = [None if i in (3, 6) else 4 if i == 5 else i for i in range(len(EDGE_TEXTS))]
    return docs_of(EDGE_TEXTS, ids).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def real(shipped, sf_dir):
    return shipped.read.parquet(f"{sf_dir}/documents.parquet").cache()
