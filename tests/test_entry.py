"""The driver contract with and without the optional corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())))"


def says(folder):
    return subprocess.run([sys.executable, "-c", SAYS], cwd=folder, capture_output=True, text=True, check=True).stdout


def test_entry_without_corpus_operators(tmp_path):
    from weirflow.plans import QUERIES

    shutil.copytree(REPO / "weirflow", tmp_path / "weirflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    assert says(tmp_path) == f"{len(QUERIES)} []\n"
