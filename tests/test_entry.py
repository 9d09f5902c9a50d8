"""The driver's contract, and that the library does without its corpus part."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_runs(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_corpus_part(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not [k for k in q if k.startswith('op') or k == 'pipeline'], q"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env=env)
    # the other tests run there, too: a few of them, on their own session
    some = "test_entry_runs or test_rtf or test_redaction or g05 or k01"
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-x", "-q", "-p", "no:cacheprovider", "-k", some], cwd=tmp_path / "r", check=True, env=env)
