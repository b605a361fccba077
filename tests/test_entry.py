"""The entry points without the optional training-data subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from inkwell.sources.storage import shared_folder

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [("inkwell/llm", "tests/llm"), ("inkwell/llm", "tests/llm", "corpus_pipeline.py")])
def test_lists_queries_without_the_subpackage(tmp_path, gone):
    kept = tmp_path / "kept"
    shutil.copytree(ROOT, kept, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for name in gone:
        path = kept / name
        if path.is_dir():
            shutil.rmtree(path)
        else:
            path.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'antibody_style_rules' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op')]; assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=kept, check=True, env={"PATH": "/usr/bin:/bin:/usr/local/bin"})


def test_no_machine_local_folder_on_a_cluster():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)), "rows")
