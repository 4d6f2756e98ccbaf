import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_samples import DOCS, document, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, copies, repeated rows."""
    rows = [document(i, prose(i, 60 + i), source="ab"[i % 2]) for i in range(12)]
    rows += [
        document(20, None),
        document(21, ""),
        document(22, " \t\n\x0b\x0c\r "),
        document(23, "%%% 123 !!!"),
        document(24, prose(3, 63), source=None),
        document(25, prose(3, 63), lang=None),
        document(None, prose(40, 80)),
        document(26, prose(41, 30_000)),
        document(27, "éü\U0001f600 " + prose(42, 70)),
        document(0, prose(0, 60), source="a"),
        document(0, prose(0, 60), source="a"),
        document(28, "x" * 50_000),
        document(29, None, None, None),
        document(30, "a  b \n\n c\n" + prose(43, 55) + "  "),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 3 > 0, i % 4 == 0) for i in range(12)] + [(20, True, False), (None, True, True), (5, None, True), (99, True, False)]
    return spark.createDataFrame([(i, q if q is None else int(q), int(t)) for i, q, t in rows], "doc_id long, quality int, toxic int")
