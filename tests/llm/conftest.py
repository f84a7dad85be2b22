import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, fp long, row string, h string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents table with extra columns whose names the operators use inside."""

    def make(texts, parts=3, start=0):
        rows = [
            (start + i, t, ["en", "de", None][i % 3], f"src{i % 4}", None if t is None else len(t), i, None, f"r{i}", "x")
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, SCHEMA).repartition(parts)

    return make
