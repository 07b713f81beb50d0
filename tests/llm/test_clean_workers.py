"""The operators run where executors have no copy of this package."""

import os
import subprocess
import sys

from millrace.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys, tempfile
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", tempfile.mkdtemp()).getOrCreate())

def there(_):
    import importlib.util
    yield importlib.util.find_spec("millrace") is not None

sys.path.insert(0, sys.argv[1])          # the driver's path only
import __spark_entry__
assert not any(spark.sparkContext.parallelize([0], 1).mapPartitions(there).collect())
queries = __spark_entry__.queries()
for name in sys.argv[2:]:
    assert queries[name](spark, "/root/testdata/sf0.001").limit(5).count(), name
print("all ran")
"""


def test_operators_need_no_package_on_executors(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, str(tmp_path / "run.py"), ROOT, *QUERIES], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all ran" in got.stdout, got.stderr[-3000:]
