"""The entry points without the training-data operators, with and without their pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTS_ALL = """
import __spark_entry__ as entry
names, twins = set(entry.queries()), set(entry.oracle_sql())
assert "latency_stats" in names and twins <= names, names
assert "pipeline" not in names and not [n for n in names if n.startswith("op")], names
"""


@pytest.mark.parametrize("left_out", [("corpus_pipeline.py",), ()])
def test_entry_without_operators(tmp_path, left_out):
    ignored = shutil.ignore_patterns("llm", "__pycache__", ".git", "*.json", *left_out)
    shutil.copytree(REPO, tmp_path / "repo", ignore=ignored)
    subprocess.run([sys.executable, "-c", LISTS_ALL], cwd=tmp_path / "repo", env=os.environ | {"PYTHONPATH": ""}, check=True)
