"""The entry lists the library's queries whatever is missing of the training-data operators."""

import subprocess
import sys
from pathlib import Path

import pytest

from registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r} or any(name.startswith(n + ".") for n in {names!r}):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
print(*e.queries())
"""


@pytest.mark.parametrize("names", [["longspan.llm"], ["regex"], ["longspan.llm", "corpus_pipeline"], ["corpus_pipeline"]])
def test_queries_are_listed_without(names):
    run = subprocess.run([sys.executable, "-c", HIDE.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    listed = set(run.stdout.split())
    assert set(QUERIES) <= listed and "pipeline" not in listed
