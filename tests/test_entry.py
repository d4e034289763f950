"""The driver's contract."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_workers_import_the_package_from_anywhere(tmp_path):
    """A session started in another folder, with the repository on the driver's path only."""
    code = f"""import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", __spark_entry__.queries()["ref_catalogue_pages"](spark, {DATA!r}).count(), __spark_entry__.entry(spark).count())"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
