"""Everything but the corpus part imports and registers without the corpus folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and len(q) > 50; print(*[n for n in q if n.startswith('op') or n == 'pipeline'])"


@pytest.mark.parametrize("gone", [["tidecast/llm"], ["tidecast/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_the_rest_works_alone(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for name in gone:
        target = copy / name
        if target.is_dir():
            shutil.rmtree(target)
        elif target.exists():
            target.unlink()
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "pipeline" not in names and (not names if "tidecast/llm" in gone else True)
