"""The package and its registry work without the training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path


def test_entry_without_llm(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "gleaner", tmp_path / "gleaner", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'url_normalize' in q and set(s) <= set(q) and not any(k.startswith('op') and k[2].isdigit() for k in q)"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_entry_where_the_subpackage_cannot_be_imported():
    """A library that the subpackage needs is missing: the other queries stay."""
    root = str(Path(__file__).resolve().parents[1])
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; q = e.queries(); assert 'url_normalize' in q and set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from gleaner.sources import shared

    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[2,1,1024]"))
    with pytest.raises(RuntimeError, match="share"):
        shared.shared_dir(session)
