"""The engine without its training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("leftover", [False, True])
def test_engine_runs_without_the_subpackage(tmp_path, leftover):
    shutil.copytree(ROOT / "caseledger", tmp_path / "caseledger", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if leftover:
        (tmp_path / "caseledger/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; n = set(e.queries()); assert n and set(e.oracle_sql()) <= n and 'pipeline' not in n"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
