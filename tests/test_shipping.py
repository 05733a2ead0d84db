"""Tasks must not depend on the package being importable where they run."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

PROGRAM = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
folder = "/root/testdata/sf0.001"
for name in ("chunk_word", "chunk_sentence", "chunk_udtf_lateral", "page_extract", "message_extract", "embed_hash",
             "knn_exact", "knn_batch", "knn_ivf", "cosine_pairs", "list_page_links"):
    assert e.queries()[name](spark, folder).count() > 0, name
print("all ran")
"""


def test_queries_run_from_any_folder(folder, tmp_path):
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_works_without_the_training_operators(folder, tmp_path):
    """The rest imports and runs where the optional package and its pipeline are not there."""
    import shutil

    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "corpusloom", tmp_path / "corpusloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    program = """
import __spark_entry__ as e
assert set(e.queries()) == set(e.oracle_sql()) and not any(n.startswith("op") or n == "pipeline" for n in e.queries())
print("fine without")
"""
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "fine without" in done.stdout, done.stderr[-3000:]
