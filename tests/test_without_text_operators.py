"""The rest works when the text operators, their tests and the pipeline are gone."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL

SCRIPT = f"""
import __spark_entry__ as e
assert e.llm is None and "pipeline" not in e.queries() and not [n for n in e.queries() if n.startswith("op")]
assert set(e.oracle_sql()) == set(e.queries())
import pkgutil, importlib, pitchlens
for m in pkgutil.walk_packages(pitchlens.__path__, "pitchlens."):
    importlib.import_module(m.name)
from pitchlens.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
assert e.queries()["stg_teams"](spark, {SF_SMALL!r}).count() > 0
"""


def test_the_rest_works_alone(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: {
        n for n in names if n in (".git", "__pycache__", "corpus_pipeline.py", "spark-warehouse", "llm") or n.startswith(".pytest")})
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_broken_text_operator_isnt_hidden(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", ".pytest_cache"))
    if not os.path.isdir(f"{copy}/pitchlens/llm"):
        return  # nothing to break
    with open(f"{copy}/pitchlens/llm/queries.py", "a") as f:
        f.write("\nimport no_such_module\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode and "no_such_module" in done.stderr
