"""The entry points, and what is left of the library without the training-corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_library_stands_alone(tmp_path):
    to = tmp_path / "repo"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(q) == set(e.oracle_sql()) and not any(k.startswith('op') for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=to, env=os.environ | {"PYTHONPATH": str(to)}, check=True)


def test_nothing_else_imports_the_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "loam")):
        if os.sep + "llm" not in folder:
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "loam.llm" not in f.read()
