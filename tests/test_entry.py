"""The driver's entry module in a tree without the training-data folders."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_training_data_folders(tmp_path, pipeline):
    shutil.copytree(os.path.join(HERE, "spendlens"), tmp_path / "spendlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", "corpus_pipeline.py"][: 2 if pipeline else 1]:
        shutil.copy(os.path.join(HERE, name), tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'over_budget' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
