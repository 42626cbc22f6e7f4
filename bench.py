"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import time

from traceloom.plans import catalog
from traceloom.session import build_session

HEADLINE = ["curation_funnel", "exact_dedupe", "word_tokens", "decontaminate_documents", "jaccard_pairs", "near_dedupe", "run_aggregate", "bootstrap_ci", "auroc_brier", "threshold_curve", "decayed_posterior", "rolling_rate", "asof_price", "nearest_centroid", "replay_lookup"]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1).count()
    took = {}
    for name in HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": d}))
    spark.stop()


if __name__ == "__main__":
    main()
