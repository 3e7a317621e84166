import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
from dayflow import session
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
root = session.ensure_checkpoint_dir(spark)
df = session.materialize(spark.range(7), "t")
assert df.count() == 7 and spark.range(3).checkpoint().count() == 3
print("ROOT", root)
"""


def test_fallback_root_only_when_unset(tmp_path):
    conf_dir = tempfile.mkdtemp(dir=str(tmp_path))          # no spark-defaults.conf
    env = dict(os.environ, SPARK_CONF_DIR=conf_dir, DAYFLOW_SCRATCH=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", SCRIPT % ROOT], env=env, capture_output=True,
                         text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    root = [line for line in out.stdout.splitlines() if line.startswith("ROOT ")][0][5:]
    assert root.startswith(str(tmp_path))


def test_configured_root_is_used(spark):
    from dayflow import session
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.ensure_checkpoint_dir(spark) == configured
        assert session.scratch_path(spark, "x").startswith(configured.rstrip("/") + "/dayflow/")


CLUSTER = r"""
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
from dayflow import session
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
class Elsewhere:
    def __getattr__(self, name):
        return "spark://host:7077" if name == "master" else getattr(spark.sparkContext, name)
class Session:
    sparkContext = Elsewhere()
    conf = spark.conf
try:
    session.ensure_checkpoint_dir(Session())
except ValueError as e:
    print("RAISED", e)
"""


def test_no_machine_local_folder_on_a_cluster(tmp_path):
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(dir=str(tmp_path)))
    out = subprocess.run([sys.executable, "-c", CLUSTER % ROOT], env=env, capture_output=True,
                         text=True, timeout=300)
    assert "RAISED set spark.checkpoint.dir" in out.stdout, out.stderr[-2000:]


CLEAR = r"""
import os, sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
from dayflow import session
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
session.materialize(spark.range(3), "a")
root = session.scratch_root(spark)
assert spark.sparkContext.applicationId in root and os.path.isdir(root)
assert session.clear_scratch(spark) and not os.path.exists(root)
assert not session.clear_scratch(spark)
print("CLEARED")
"""


def test_scratch_of_a_run_can_be_cleared(tmp_path):
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(dir=str(tmp_path)),
               DAYFLOW_SCRATCH=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", CLEAR % ROOT], env=env, capture_output=True,
                         text=True, timeout=300)
    assert "CLEARED" in out.stdout, out.stderr[-2000:]
