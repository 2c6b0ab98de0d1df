"""The entry works without the text operators."""

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _counts(folder) -> list[int]:
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)},
                         capture_output=True, text=True, check=True)
    return [int(x) for x in out.stdout.split()]


def test_without_the_text_operators(tmp_path):
    for name in ("__spark_entry__.py", "oracle_queries.py"):
        shutil.copy(f"{HERE}/{name}", tmp_path)
    shutil.copytree(f"{HERE}/tableguard", tmp_path / "tableguard", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    n, sql = _counts(tmp_path)
    assert n == sql >= 50
    # an empty folder left behind, and the pipeline's file without its operators
    (tmp_path / "tableguard/llm").mkdir()
    (tmp_path / "corpus_pipeline.py").write_text("from tableguard.llm import mixing\n")
    assert _counts(tmp_path) == [n, sql]
