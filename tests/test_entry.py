import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["spriteloom.llm", "xxhash", "public_tokenizers", "corpus_pipeline"])
def test_other_queries_stay_when_something_is_missing(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print('verdict_counts' in e.queries(), 'verdict_counts' in e.oracle_sql(), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.split() == ["True", "True", "False"]
