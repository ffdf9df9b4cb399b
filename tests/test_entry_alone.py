"""The entry file and the other tests work without the training-data operators."""

import os
import shutil
import subprocess
import sys

from ledgerline.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _copy(tmp_path, *without):
    to = tmp_path / "repo"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.md"))
    for name in without:
        path = to / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    return to


def _python(folder, *args):
    env = dict(os.environ, PYTHONPATH=str(folder), PYTHONDONTWRITEBYTECODE="1")
    return subprocess.run([sys.executable, *args], cwd=folder, env=env, capture_output=True, text=True, timeout=240)


ASK = "import __spark_entry__ as e; print(*sorted(e.queries())); assert callable(e.entry); e.oracle_sql()"


def test_entry_without_the_operators(tmp_path):
    for gone in (("ledgerline/llm", "tests/llm"), ("ledgerline/llm", "tests/llm", "corpus_pipeline.py")):
        folder = _copy(tmp_path / str(len(gone)), *gone)
        found = _python(folder, "-c", ASK)
        assert found.returncode == 0, found.stderr
        assert set(found.stdout.split()) == set(QUERIES)
    collected = _python(folder, "-m", "pytest", "--collect-only", "-q", "tests")
    assert collected.returncode == 0, collected.stdout[-2000:]


def test_another_missing_module_is_an_error(tmp_path):
    folder = _copy(tmp_path, "corpus_pipeline.py")
    (folder / "corpus_pipeline.py").write_text("import a_library_that_is_not_there\n")
    found = _python(folder, "-c", ASK)
    assert found.returncode != 0 and "a_library_that_is_not_there" in found.stderr
