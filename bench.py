"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to the end over the whole tables; its rows go to Spark's no-op sink. One small query runs first so that
the figures do not contain the start of the JVM. Queries under ``REPEAT_BELOW`` seconds run three times; the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from lexigram.plans.registry import QUERIES
from lexigram.session import local_session

REPEAT_BELOW = 10

HEADLINES = (
    "trigram_from_text",
    "trigram_counts",
    "bigram_counts",
    "unigram_counts",
    "stopword_filter",
    "next_word_prob",
    "next_word_ranked",
    "next_word_topk",
    "backoff_candidates",
    "backoff_scored",
    "lexeme_feature_counts",
    "association",
    "similarity_matrix",
    "labelled_matrix",
    "stemmed_association",
    "stemmed_labelled_matrix",
    "stemmed_counts",
    "doc_convert",
    "client_report",
    "stream_dedup",
    "stream_progress",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    QUERIES["corpus_size_direct"](spark, sf_dir).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        runs = []
        while not runs or len(runs) < 3 and runs[0] < REPEAT_BELOW:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
