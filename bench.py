"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores.
Every query is written to the no-op sink and timed from plan to last row, once; a first
run of one query, not counted, starts the JVM's code paths.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimstream.plans.queries import QUERIES  # noqa: E402
from claimstream.session import local_session, shared_folder  # noqa: E402

HEADLINE = [
    "quality_metrics",
    "payload_roundtrip",
    "claims_redact",
    "shingle_counts",
    "ngram_topk",
    "pattern_record",
    "vocabulary",
    "tfidf_terms",
    "reservoir_sample",
    "minhash_signatures",
    "similarity_clusters",
    "similar_claims",
    "lsh_summary",
    "stream_positions",
    "window_exact",
    "dgim_estimate",
    "dgim_batch_stats",
    "train_eval",
    "feature_words",
    "stream_confusion",
    "stream_dgim",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    shared_folder(spark)
    QUERIES["quality_metrics"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
