import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

NOISE = ["", " \n\t ", "one", "a b c d", "naïve café 日本語 " * 3]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew tea for a tired king".split()
    prose = " ".join(f"{w}{i}" for i, w in enumerate(base * 12))
    rows = [(i, t, "en", "s1") for i, t in enumerate(NOISE)]
    rows += [(10, prose, "en", "s1"), (11, prose, "en", None), (12, prose.upper(), None, "s2"), (12, prose.upper(), None, "s2")]
    rows += [(13, None, None, None), (None, prose, "de", "s1"), (14, "x" * 250_000, "de", "s1"), (15, " ".join(["w"] * 60_000), "de", "s2")]
    rows += [(20 + i, f"{prose} end{i}", "fr", "s3") for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = {c: frame["doc_id"] for c in ("_own", "_stats", "_kept", "_found", "_spans", "_quota", "_model", "n", "size", "rep", "node")}
    return frame.withColumns(clash)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
