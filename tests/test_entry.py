"""The entry in a copy of the repository: whole, without the optional subpackage, and with a module missing that only it needs."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.fixture
def copy(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "quillstream", "checks"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    return tmp_path


def listed(folder, first=""):
    done = subprocess.run([sys.executable, "-c", f"{first}\n{LIST}"], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return [set(line.split()) for line in done.stdout.splitlines()]


def library():
    from checks.oracle import SQL
    from checks.queries import QUERIES

    return [set(QUERIES), set(SQL)]


def test_without_the_subpackage(copy):
    if (copy / "quillstream" / "llm").exists():
        (copy / "quillstream" / "llm").rename(copy / "elsewhere")
    assert listed(copy) == library()


def test_without_a_module_that_only_the_subpackage_needs(copy):
    assert listed(copy, "import sys; sys.modules['xxhash'] = sys.modules['zstandard'] = sys.modules['public_tokenizers'] = None") == library()


def test_whole(copy):
    queries, sql = listed(copy)
    assert queries >= library()[0] and sql >= library()[1]
