"""The driver's module with the corpus operators absent as a whole, or in part."""

import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT


def names(at, *left_out):
    shutil.copytree(ROOT / "sluice", at / "sluice", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and (ROOT / name).exists():
            shutil.copy(ROOT / name, at / name)
    (at / "sluice/llm/__pycache__").mkdir(parents=True)  # what Python leaves behind
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=at, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)


def test_absent_as_a_whole(tmp_path):
    got = names(tmp_path, "llm", "corpus_pipeline.py")
    assert got.returncode == 0 and "owed_best" in got.stdout.split() and not [n for n in got.stdout.split() if n == "pipeline" or n[:2] == "op" and n[2].isdigit()]


@pytest.mark.skipif(not (ROOT / "sluice/llm/urls.py").exists(), reason="the corpus operators are absent")
def test_a_missing_part_is_an_error(tmp_path):
    got = names(tmp_path, "urls.py")
    assert got.returncode and "urls" in got.stderr
