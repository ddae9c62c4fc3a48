from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from muster import queries

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_corpus_operators(tmp_path, pipeline):
    """A copy without them imports and has every panel query, whether corpus_pipeline.py is there or not."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json"))
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True)
    found, sql = (line.split() for line in done.stdout.splitlines())
    assert found == sorted(queries.QUERIES) and sql == sorted(queries.ORACLE_SQL)
