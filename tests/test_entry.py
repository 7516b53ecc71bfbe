"""The entry module without the optional training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
for name in {absent!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
print("NAMES", *entry.queries(), "SQL", *entry.oracle_sql())
"""


def names(folder, absent=()):
    run = subprocess.run(
        [sys.executable, "-W", "ignore", "-c", SCRIPT.format(absent=list(absent))], cwd=folder, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0, run.stderr
    found = run.stdout.rpartition("NAMES")[2].split()
    return set(found[: found.index("SQL")]), set(found[found.index("SQL") + 1 :])


@pytest.mark.parametrize("without", ["folder", "folder and pipeline", "library"])
def test_entry_without_training_data_operators(tmp_path, without):
    ignore = shutil.ignore_patterns("llm", "__pycache__") if without != "library" else shutil.ignore_patterns("__pycache__")
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=ignore)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if without != "folder and pipeline" and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    queries, sql = names(tmp_path, ["xxhash"] if without == "library" else [])
    assert "mart_daily_transaction_kpi" in queries and sql <= queries
    assert not any(n == "pipeline" or n.startswith("op") and n[2].isdigit() for n in queries)
