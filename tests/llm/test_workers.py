"""Workers that have no installed copy of the package run every Python stage."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import os
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", os.getcwd() + "/ckpt").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
missing = spark.range(1).mapInPandas(lambda it: (b.assign(id=int(__import__("importlib.util").util.find_spec("eventlake") is None) + 0 * b.id) for b in it), "id long").first()[0]
from eventlake.llm.queries import QUERIES
for name in {names!r}:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count(), missing, flush=True)
"""
NAMES = ["op3_histogram_topk", "op4_prob_minhash", "op5_classifier_chain", "op6_power_of_two_packing", "op8_soft_mixing",
         "op9_template_text", "op10_gear_chunks", "op11_guess_cost_secrets", "op12_phrase_collocations", "op13_token_alignment"]


def test_queries_run_on_workers_without_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, names=NAMES)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=900)
    lines = [x.split() for x in out.stdout.splitlines() if x.startswith("op")]
    assert [x[0] for x in lines] == NAMES, out.stderr[-2000:]
    assert {x[2] for x in lines} == {"1"}  # the workers cannot import the package
