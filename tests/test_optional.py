import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_works_without_the_optional_part(tmp_path, gone):
    """Both folders of that name gone, with the pipeline or without."""
    to = tmp_path / "repo"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(*gone, ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=to, check=True, env=os.environ | {"PYTHONPATH": str(to)})


def test_only_the_entry_names_the_optional_part():
    for top, dirs, names in os.walk(os.path.join(ROOT, "traceloom")):
        dirs[:] = [d for d in dirs if d != "llm"]
        for n in names:
            if n.endswith(".py"):
                assert "traceloom.llm" not in open(os.path.join(top, n)).read()
