"""The entry without the training-data subpackage, or without what it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import sys
sys.path.insert(0, sys.argv[1])
sys.modules[sys.argv[2]] = None
import __spark_entry__ as entry
names, statements = entry.queries(), entry.oracle_sql()
assert set(statements) <= set(names)
print(len(names), sum(name.startswith("op") or name == "pipeline" for name in names))
"""


@pytest.mark.parametrize("blocked", ["tokenizers", "public_tokenizers", "deliverylens.llm", "corpus_pipeline"])
def test_other_queries_work_without_it(blocked):
    run = subprocess.run([sys.executable, "-c", COUNT, ROOT, blocked], capture_output=True, text=True, timeout=120)
    every, dealt = map(int, run.stdout.split())
    assert every > 140 and dealt == 0, run.stderr[-2000:]
