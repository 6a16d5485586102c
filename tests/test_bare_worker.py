import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {shared!r}).getOrCreate())
from leadloom.operators import dedupe, merge
from leadloom.operators.normalize import normalize_submissions
from leadloom.schema import LEAD_SCHEMA
fields = "seq long, name string, email string, phone string, company string, country string"
# a shared mailbox of several people is settled by the replay, a name beyond ASCII by the folding function
rows = [(1, "Ana Lim", "a@x.io", None, "Globe", None), (2, "Åna Lim", "a@x.io", None, "Acme", None), (3, "Ana Lim", "a@x.io", "12345678", "Acme", None)]
done = merge.merge_submissions(spark.createDataFrame([], LEAD_SCHEMA), normalize_submissions(spark.createDataFrame(rows, fields)))
print("TARGETS", sorted(tuple(r) for r in done.decisions.select("seq", "target").collect()))
print("PAIRS", dedupe.dedupe_candidates(done.leads, 0.0).count())
"""


def test_workers_need_no_installed_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=ROOT, shared=str(tmp_path / "shared"))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "TARGETS" in done.stdout and "PAIRS" in done.stdout
