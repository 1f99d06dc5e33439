"""The driver's contract without the training-data folders."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert len(q) > 50 and set(o) <= set(q) and "pipeline" not in q and not any(n[:2] == "op" and n[2].isdigit() for n in q)
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_llm_folder(tmp_path, pipeline):
    """The rest registers its queries with the subpackage gone, whether or not the pipeline's file is left behind."""
    shutil.copytree(os.path.join(ROOT, "panelrank"), tmp_path / "panelrank", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * pipeline:
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path / name)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], capture_output=True, text=True, cwd=tmp_path, env=env)
    assert done.returncode == 0, done.stderr
