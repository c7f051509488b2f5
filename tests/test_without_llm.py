"""The library without the jobs for training data."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "prepare_corpus" in names and set(entry.oracle_sql()) <= names
assert not [n for n in names if n.startswith("op") and n[2].isdigit()] and "pipeline" not in names
"""


def bare(tmp_path, keep_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json"))
    if not keep_pipeline and (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env=env, capture_output=True, text=True, timeout=120)


def test_without_folders_and_pipeline(tmp_path):
    made = bare(tmp_path, False)
    assert made.returncode == 0, made.stderr


def test_without_folders(tmp_path):
    made = bare(tmp_path, True)
    assert made.returncode == 0, made.stderr
