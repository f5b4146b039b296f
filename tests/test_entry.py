"""The entry without the training-data subpackage: no folder, an empty folder, a broken module."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
SAID = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"


def run(folder):
    return subprocess.run([sys.executable, "-B", "-c", SAID], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.fixture
def copy(tmp_path):
    for name in ("quipu", "__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).is_dir():
            shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path / name)
    return tmp_path


@pytest.mark.parametrize("empty", [True, False])
def test_left_out(copy, empty):
    shutil.rmtree(copy / "quipu" / "llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True) if not empty else (copy / "quipu" / "llm").mkdir()
    done = run(copy)
    assert done.returncode == 0 and done.stdout.split()[2] == "False", done.stderr


def test_other_import_errors_are_not_hidden(copy):
    if not (copy / "quipu" / "llm").exists():
        pytest.skip("without the subpackage")
    (copy / "quipu" / "llm" / "queries.py").write_text("import nothing_of_that_name\n")
    assert run(copy).returncode != 0
