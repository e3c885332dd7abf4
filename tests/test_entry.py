"""The entry module without its optional part, and the package in the workers of any session."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {names!r} or name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Blocked())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
names = set(entry.queries())
print(len(names), "publish_raw" in names, any(n.startswith("op") and n[2].isdigit() for n in names))
"""


@pytest.mark.parametrize("names", [("public_tokenizers",), ("regex",), ("tiktoken", "sentencepiece"), ("corpus_pipeline",),
                                   ("snapforge.llm",)])
def test_other_queries_are_there_without_optional_modules(names, tmp_path):
    code = BLOCKED.format(names=names, root=str(ROOT))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, timeout=120, check=True)
    count, published, operators = done.stdout.split()
    assert int(count) >= 66 and published == "True" and operators == "False"
    assert "without the training-data operators" in done.stderr


def test_a_broken_module_is_not_hidden(tmp_path):
    """Only a missing module leaves the optional part out."""
    (tmp_path / "corpus_pipeline.py").write_text("raise RuntimeError('broken')")
    code = f"import sys; sys.path[:0] = [{str(tmp_path)!r}]; import corpus_pipeline"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=60).returncode != 0
    source = (ROOT / "__spark_entry__.py").read_text()
    assert "except ModuleNotFoundError" in source and "except Exception" not in source


def test_workers_have_the_package_wherever_the_driver_started(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from snapforge.session import build_session
spark = build_session("elsewhere", "local[1]", **{{"spark.ui.enabled": "false"}})
def run(batches):
    import snapforge.functions.codes
    yield from batches
print("rows", spark.range(3).mapInArrow(run, "id long").count())
"""
    given = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=given, timeout=180)
    assert "rows 3" in done.stdout, done.stderr[-500:]
