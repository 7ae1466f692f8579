"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Every query is fully executed through the ``noop`` sink (no driver collect).
``BENCH_QUERIES=a,b`` or ``BENCH_ALL=1`` change the query set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans.catalog import QUERIES  # noqa: E402
from quire.session import get_spark  # noqa: E402

HEADLINE = [
    "collocations_by_frequency",
    "collocations_by_tfidf",
    "ngram_counts",
    "sentence_log_probability",
    "fill_masks",
    "build_corpus",
    "tfidf_weights",
    "chi2_select",
    "knn_classify",
    "nearest_sentence",
    "similar_words",
    "stratified_folds",
    "classification_report",
    "matrix_multiply",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2,
                      driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    if os.environ.get("BENCH_ALL"):
        names = sorted(QUERIES)
    elif os.environ.get("BENCH_QUERIES"):
        names = os.environ["BENCH_QUERIES"].split(",")
    else:
        names = [q for q in HEADLINE if q in QUERIES]
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001
            print(f"{name} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            times[name] = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(v for v in times.values() if v is not None), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
