"""The tasks run in workers that cannot import the library."""

import os
import subprocess
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
CODE = """
import sys
sys.path.insert(0, {root!r})  # the driver's own path: workers start elsewhere without it
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
def worker(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.record_batch([pa.array([importlib.util.find_spec("pluvia") is not None])], names=["found"])
assert not any(r.found for r in spark.range(4).mapInArrow(worker, "found boolean").collect())
from pluvia.llm.queries import QUERIES
for name in {names!r}:
    print(name, len(QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
"""


@pytest.mark.parametrize("names", [["op2_masked_lm", "op4_langid", "op5_toxicity", "op7_html_extract"],
                                   ["op11_wavelet", "op12_prefix_trie", "op13_collocations"]])
def test_queries_run_without_the_package_on_the_executors(names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT), names=names)], cwd=tempfile.mkdtemp(), env=env,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines()] == names
