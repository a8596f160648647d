import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from lodeworks.session import shared_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
first, second = shared_dir(spark), shared_dir(spark)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert second.startswith("file:" + first), (first, second)
assert shared_dir(spark) == second
print("fallback works")
"""


def test_a_folder_of_its_own_only_where_none_is_named(tmp_path):
    """A separate process, because the test session does name a folder."""
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(Path(__file__).resolve().parent.parent))],
        env={**__import__("os").environ, "SPARK_CONF_DIR": str(tmp_path)},
        capture_output=True,
        text=True,
        timeout=120,
    )
    assert "fallback works" in run.stdout, run.stderr[-2000:]


def test_the_named_folder_is_used(spark):
    from lodeworks.session import work_path

    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
