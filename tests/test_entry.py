"""The driver's entry file, whole and with the corpus operators taken out."""

import json
import os
import re
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("gone", [("tidemark/llm",), ("tidemark/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without_the_corpus_operators(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "tests", "__pycache__"))
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", LIST], cwd=copy, env=env, capture_output=True, text=True, check=True)
    queries, sql = json.loads(out.stdout)
    assert "minute_aggregates" in queries and set(sql) <= set(queries) and "pipeline" not in queries
    if "tidemark/llm" in gone:
        assert not [q for q in queries if re.match(r"op\d", q)]
