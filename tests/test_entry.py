import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
SCRIPT = """
import __spark_entry__ as entry
from pyspark.sql import SparkSession
found = entry.queries()
assert found and not any(k.startswith("op") and k[2].isdigit() or k == "pipeline" for k in found)
assert set(entry.oracle_sql()) <= set(found)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert entry.entry(spark).count() > 0 and found["url_domain"](spark, "/root/testdata/sf0.001").count() > 0
print("fine")
"""


def test_the_rest_works_without_the_optional_folders(tmp_path):
    for name in ("cataloom", "__spark_entry__.py", "corpus_pipeline.py"):
        source = REPO / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)
    got = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert got.stdout.strip().endswith("fine"), got.stderr[-2000:]
