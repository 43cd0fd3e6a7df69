import os
import subprocess
import sys

import pytest
from oracle import DATA

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_contract(spark):
    import __spark_entry__ as e

    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    df = e.entry(spark)
    assert df.columns == ["label", "n", "share"] and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_works_without_llm(tmp_path):
    """The core imports and lists its queries where the llm package is gone."""
    import shutil

    shutil.copytree(os.path.join(ROOT, "corpusloom"), tmp_path / "corpusloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p7_ids' not in q; assert set(e.oracle_sql()) <= set(q)"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env)
