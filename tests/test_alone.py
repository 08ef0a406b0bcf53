"""The shop part works without the operators on text."""

import os
import shutil
import subprocess
import sys

from tillmart import registry

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_text_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "*cache*"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(registry.queries()))] * 2
