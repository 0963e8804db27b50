"""Without these operators the rest still imports."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WITHOUT = "import __spark_entry__ as e; q = e.queries(); assert 'frame_stride_sample' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) == set(q)"


def _run(folder, code: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True)


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_without_the_subpackage(tmp_path, pipeline):
    shutil.copytree(os.path.join(ROOT, "framewright"), tmp_path / "framewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])]:
        shutil.copy(os.path.join(ROOT, name), tmp_path)
    assert (done := _run(tmp_path, WITHOUT)).returncode == 0, done.stderr


def test_what_the_subpackage_needs_must_be_there(tmp_path):
    shutil.copytree(os.path.join(ROOT, "framewright"), tmp_path / "framewright", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    (tmp_path / "framewright" / "llm" / "common.py").write_text("import a_library_that_is_not_there\n")
    assert "a_library_that_is_not_there" in _run(tmp_path, "import __spark_entry__").stderr
