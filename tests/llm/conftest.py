import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Makes a documents table of (doc_id, text) pairs, with a column whose name clashes with one of the operators' own."""
    def make(rows, lang="en"):
        full = [(i, t, lang, f"src{k % 3}", len(t or ""), "x") for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS + ", shard string").coalesce(2)
    return make
