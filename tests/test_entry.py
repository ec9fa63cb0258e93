"""The entry without the optional part: in a copy that lacks its folders or its libraries."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(k for k in e.queries() if k.startswith('op') or k == 'pipeline'))"


def run(folder, code=SHOW):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": str(folder)})


@pytest.fixture()
def copy(tmp_path):
    target = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "repolens"), target / "repolens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), target)
    return target


@pytest.mark.parametrize("left", ["nothing", "pipeline", "empty folder"])
def test_entry_without_the_folders(copy, left):
    if left != "nothing":
        (copy / "corpus_pipeline.py").write_text("from repolens.llm import bpe\n")
    if left == "empty folder":
        (copy / "repolens/llm/__pycache__").mkdir(parents=True)
    out = run(copy)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip().endswith("[]") and int(out.stdout.split()[0]) >= 50


def test_entry_without_a_library_of_the_optional_part(copy):
    (copy / "repolens/llm").mkdir()
    (copy / "repolens/llm/queries.py").write_text("QUERIES, SQL = {}, {}\n")
    (copy / "corpus_pipeline.py").write_text("import public_tokenizers\n")
    out = run(copy, "import sys; sys.modules['public_tokenizers'] = None; " + SHOW)
    assert out.returncode == 0 and out.stdout.strip().endswith("[]"), out.stderr


def test_other_import_errors_are_not_hidden(copy):
    (copy / "corpus_pipeline.py").write_text("import some_missing_module\n")
    out = run(copy)
    assert out.returncode != 0 and "some_missing_module" in out.stderr
