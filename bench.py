"""Time the headline queries; prints one JSON line.

Each query is run once to warm up and then ``BENCH_RUNS`` times; the best run counts. All
rows and columns are computed: the results go to Spark's noop sink.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from paralane.plans.queries import QUERIES  # noqa: E402
from paralane.session import local_session  # noqa: E402

HEADLINE = (
    "validation_report", "rejections_by_direction", "valid_pairs", "keep_first_by_pair",
    "text_measures", "normalized_pairs", "fanned_out_triplets", "sampled_pairs", "split_pairs",
    "stratified_pairs", "ranked_pairs", "evaluation_table", "evaluation_by_domain",
    "dataset_fingerprint", "whole_dataset_fingerprint", "run_comparison", "vocabulary", "token_ids",
    "padded_token_batches", "translations",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(min(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(folder.rstrip("/").rsplit("sf", 1)[-1]),
        "cores": cores,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
