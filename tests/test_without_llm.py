"""The rest of the repository without the training-data part."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_llm(tmp_path, pipeline):
    home = tmp_path / "repo"
    shutil.copytree(HERE, home, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", *([] if pipeline else ["corpus_pipeline.py"])))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 80 and set(o) <= set(q) and not any(n.startswith('op') for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=home, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
