"""The driver's contract, with and without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_and_registry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())


def test_import_without_the_subpackage(tmp_path):
    for p in ROOT.iterdir():
        if p.name not in ("corpus_pipeline.py", "tidemark", ".git", "tests"):
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "tidemark").mkdir()
    for p in (ROOT / "tidemark").iterdir():
        if p.name != "llm":
            (tmp_path / "tidemark" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and 'pipeline' not in q and not any(n.startswith('op1') for n in q); print(len(e.oracle_sql()))"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True).returncode == 0


def test_import_without_a_library_of_the_subpackage():
    code = "import sys; sys.modules['tiktoken'] = None; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and 'pipeline' not in q"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True).returncode == 0
