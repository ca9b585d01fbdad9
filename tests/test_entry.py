"""The driver's entry without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_folders(tmp_path):
    """With radspan/llm and tests/llm gone, with or without corpus_pipeline.py, the entry imports and knows the other queries."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".*"))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 90 and set(e.oracle_sql()) <= set(e.queries()); assert not [q for q in e.queries() if q.startswith('op') and q[2].isdigit() or q == 'pipeline']"
    for gone in ("", "corpus_pipeline.py"):
        if gone:
            (copy / gone).unlink(missing_ok=True)
        subprocess.run([sys.executable, "-c", code], cwd=copy, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, check=True, timeout=120)
