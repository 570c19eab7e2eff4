"""The entry with and without the optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["sparkaudit.llm", "corpus_pipeline", "ahocorasick", "public_tokenizers", "zstandard"])
def test_a_missing_module_of_the_text_part_leaves_the_rest(blocked):
    code = (
        f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; q = e.queries(); "
        "assert len(q) > 150 and 'h11_ridge_cv' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q); "
        "assert set(e.oracle_sql()) <= set(q)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-800:]


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
