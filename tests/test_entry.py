"""The entry module without the corpus subpackage and its pipeline: all other queries are there."""

import os
import shutil
import subprocess
import sys

from jobs.registered import QUERIES as JOBS
from taxaflow.plans.queries import ORACLE_SQL, QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_subpackage(tmp_path):
    copy = tmp_path / "repo"
    for part in ("taxaflow", "jobs"):
        shutil.copytree(os.path.join(REPO, part), copy / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), copy)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names, sql = done.stdout.splitlines()
    assert names.split() == sorted(QUERIES.keys() | JOBS.keys()) and sql.split() == sorted(ORACLE_SQL.keys() | JOBS.keys())


def test_another_missing_module_is_an_error(tmp_path):
    for part in ("taxaflow", "jobs"):
        shutil.copytree(os.path.join(REPO, part), tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__", "boxes.py"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "boxes" in done.stderr
