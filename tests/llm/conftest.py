import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=()):
        """rows of (doc_id, text[, lang, source]); `extra` names columns that clash with inner ones."""
        full = [(*r, *(("en", "s")[len(r) - 2 :]), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
