"""The driver's entry points, with and without the training-data package."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; from colloquia.plans import catalogue as c; q, o = e.queries(), e.oracle_sql(); assert set(q) >= set(c.QUERIES) and set(o) <= set(q); print(len(q) - len(c.QUERIES))"


@pytest.mark.parametrize("gone, left", [((), 11), (("colloquia/llm",), 0), (("colloquia/llm", "corpus_pipeline.py"), 0), (("corpus_pipeline.py",), 10)])
def test_parts_may_be_missing(tmp_path, gone, left):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "colloquia", tmp_path / "colloquia")
    for name in gone:
        path = tmp_path / name
        shutil.rmtree(path, ignore_errors=True) if path.is_dir() else path.unlink(missing_ok=True)
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == (left if (ROOT / "colloquia/llm").exists() else 0)


def test_errors_inside_a_part_are_not_hidden(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "colloquia", tmp_path / "colloquia")
    shutil.rmtree(tmp_path / "colloquia/llm", ignore_errors=True)
    (tmp_path / "colloquia/llm").mkdir()
    (tmp_path / "colloquia/llm/__init__.py").write_text("")
    (tmp_path / "colloquia/llm/queries.py").write_text("import no_such_module")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode and "no_such_module" in done.stderr
