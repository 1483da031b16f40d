"""Workers that have no copy of the repository."""

import os
import subprocess
import sys
from pathlib import Path

REPOSITORY = Path(__file__).resolve().parents[2]
JOB = """
import sys
sys.path.insert(0, {repository!r})
from strataline.session import session
spark = session("far", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
spark.sparkContext.setLogLevel("OFF")
from pyspark.sql import functions as F

def has_copy(batches):
    import importlib.util
    for batch in batches:
        batch["found"] = importlib.util.find_spec("strataline") is not None
        yield batch

assert not spark.range(1).mapInPandas(has_copy, "id long, found boolean").first().found
from strataline.llm import queries
for name in {names!r}:
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
print("all ran")
"""


def test_queries_run_where_workers_have_no_copy_of_the_repository(tmp_path):
    names = [f"op{n}_" for n in (1, 2, 4, 5, 7, 9, 11, 12, 13)]
    from strataline.llm.queries import QUERIES

    names = [name for name in QUERIES if name.startswith(tuple(names))]
    job = tmp_path / "job.py"
    job.write_text(JOB.format(repository=str(REPOSITORY), names=names))
    environment = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    ran = subprocess.run([sys.executable, str(job)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    assert "all ran" in ran.stdout, ran.stderr[-3000:]
