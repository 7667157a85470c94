"""The entry module with, without and with a broken optional part."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(sum(k.startswith('op') or k == 'pipeline' for k in q), len(q), set(e.oracle_sql()) <= set(q))"


def _imported(folder):
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})


@pytest.fixture
def without_llm(tmp_path):
    """A copy of the library without the optional part."""
    shutil.copytree(f"{ROOT}/ledgerline", tmp_path / "ledgerline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    return tmp_path


def test_entry_without_the_optional_part(without_llm):
    run = _imported(without_llm)
    assert run.returncode == 0, run.stderr
    found, n, oracles = run.stdout.split()
    assert found == "0" and int(n) >= 65 and oracles == "True"
    (without_llm / "ledgerline" / "llm").mkdir()  # an empty folder is none either
    assert _imported(without_llm).stdout == run.stdout


def test_entry_does_not_hide_errors_of_the_optional_part(without_llm):
    part = without_llm / "ledgerline" / "llm"
    part.mkdir()
    (part / "__init__.py").write_text("")
    (part / "queries.py").write_text("import no_such_module\n")
    (without_llm / "corpus_pipeline.py").write_text("")
    run = _imported(without_llm)
    assert run.returncode != 0 and "no_such_module" in run.stderr
