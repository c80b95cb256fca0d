"""Executors need no copy of the package; features need little memory."""

import os
import subprocess
import sys
import textwrap
import tracemalloc

import pyarrow as pa

from keyloop.llm.quality_classifier import SLICE, features
from keyloop.llm.text import Shared, slices

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_operators_travel_to_workers_without_the_package(tmp_path):
    """The repository is on the driver's path only; workers start elsewhere."""
    script = tmp_path / "driver.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path / 'c')!r})
                 .config("spark.sql.warehouse.dir", {str(tmp_path / 'w')!r}).getOrCreate())

        def alone(_):
            import importlib.util
            yield importlib.util.find_spec("keyloop") is None
        assert all(spark.sparkContext.parallelize([0], 1).mapPartitions(alone).collect())
        sys.path.insert(0, {ROOT!r})
        from keyloop.llm import queries
        for name in ("op1_line_dedup", "op2_decontaminate", "op9_toxicity", "op12_prefix_trie", "op13_periodic_runs"):
            assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
        print("all ran")
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_features_of_short_texts_stay_small():
    text = " ".join(["word", "and", "an", "other"] * 5)
    batch = pa.RecordBatch.from_arrays([pa.array([text] * ((4 << 20) // len(text)))], names=["text"])
    tracemalloc.start()
    for part in slices([batch], most=SLICE):
        features(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20


def test_workers_hold_a_broadcast_object_without_its_pickled_bytes(spark):
    shared = Shared(spark, {"a": list(range(5))})

    def run(batches):
        sent = shared._sent.value
        for batch in batches:
            yield batch.append_column("same", pa.array([sent == shared.value == {"a": list(range(5))}] * batch.num_rows))

    assert all(r.same for r in spark.range(4).mapInArrow(run, "id long, same boolean").collect())
    assert shared.value == {"a": list(range(5))}
