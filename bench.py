"""Headline-query timings; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed in full with a no-op sink (nothing is collected
to the driver) after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from lexicarve.plans import catalog  # noqa: E402
from lexicarve.session import get_session, scratch_path  # noqa: E402

HEADLINE = [
    "flagship_top_terms",      # T4 + T6 + unigram T10 + top-k per class over the labelled corpus
    "t10_tfidf",               # 1-4-gram TF-IDF over every document
    "t11_sparse_vectors",      # the same as sparse vectors over the sorted vocabulary
    "a8_vocabulary",           # sorted vocabulary with global index
    "w1_balanced_sample",
    "w2_holdout",
    "l2_ordered_split",
    "l4_l5_shuffle_batches",
    "w6_stratified_folds",
    "t4_preprocess",
    "j4_lexicon_joins",
    "e3_e7_fixed_length_examples",
    "e1_e2_e4_pad_to_longest",
    "p7_reset_index",          # every document, payload kept
    "m1_m5_binary_metrics",
    "r2_w3_w4_l6_search_log",
    "r3_r4_forest_predictions",
    "r5_r7_holdout_search",
    "m7_transfer_evaluation",
    "m7_model_transfer",
]


def laid_out(spark, sf_dir: str, cpus: int) -> str:
    """The tables of ``sf_dir`` with documents in as many files as a large table would have.

    The test table is one file of one row group, which only one core can
    scan. The copy is timed as ``layout`` and counts in the total.
    """
    to = scratch_path(spark, "bench-tables")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(2 * cpus, "doc_id").write.parquet(f"{to}/documents.parquet")
    for name in ("labels", "embeddings"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{to}/{name}.parquet")
    return to


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, driver_memory="16g")
    spark.conf.set("spark.sql.files.openCostInBytes", "1m")  # the copy's files are small: few to a task
    spark.read.parquet(f"{sf_dir}/labels.parquet").count()  # warm the session
    times = {}
    t = time.time()
    sf_dir = laid_out(spark, sf_dir, cpus)
    times["layout"] = round(time.time() - t, 3)
    for name in HEADLINE:
        t = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
