import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text) as documents with clashing extra columns."""

    def make(rows):
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, slot string, "
            "matches string, pii string, score string, token_ids string, toxicity string, n string, `key` string, class string"
        )
        full = [(i, t, "en", f"s{(i or 0) % 2}" if i != 3 else None, len(t or "")) + ("x",) * 10 for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make
