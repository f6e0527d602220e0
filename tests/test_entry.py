"""The entry module, with and without the text operators."""

import subprocess
import sys
from pathlib import Path

import pytest

from workload.oracle import ORACLE
from workload.queries import QUERIES

ROOT = Path(__file__).parent.parent

# Imports the entry while some modules cannot be found, and tells what it has.
SCRIPT = """
import importlib.abc, sys

class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {missing!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(sorted(entry.queries()) == {queries!r}, sorted(entry.oracle_sql()) == {queries!r})
"""


def entry_without(missing):
    script = SCRIPT.format(missing=missing, queries=sorted(QUERIES))
    return subprocess.run(
        [sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True, timeout=120
    )


@pytest.mark.parametrize(
    "missing", [["tidemark.llm"], ["tidemark.llm", "corpus_pipeline"]]
)
def test_core_queries_stay_without_text_operators(missing):
    assert set(QUERIES) == set(ORACLE)
    assert entry_without(missing).stdout == "True True\n"


def test_other_missing_modules_show():
    found = entry_without(["tidemark.operators"])
    assert found.returncode and "tidemark.operators" in found.stderr
