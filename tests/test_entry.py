"""The driver's entry with and without its optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), *sorted(q))"


@pytest.mark.parametrize("gone", [["newsloom/llm", "tests/llm"], ["newsloom/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_optional_parts(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.parquet", "spark-warehouse"))
    for path in gone:
        if (copy / path).is_dir():
            shutil.rmtree(copy / path)
        elif (copy / path).exists():
            os.remove(copy / path)
    names = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=copy, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": str(copy)}).stdout.split()
    assert "channel_audit" in names and "inventory" in names
    assert "pipeline" not in names
    assert any(n.startswith("op1_") for n in names) == (copy / "newsloom/llm").exists()
