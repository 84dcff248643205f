"""Times the headline queries: one warm-up, then the median of three runs (of one, where the warm-up took over 10 s).

Prints one JSON line.  Every query writes its whole result to the no-op sink.  A
query that is not done after ``BENCH_LIMIT`` seconds is cancelled and listed as
unfinished; the others go on.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

from turnloom.plans.catalog import QUERIES
from turnloom.session import build_session

HEADLINE = [
    "corpus_clean", "source_counts", "normalize_mixed", "math_answers", "sft_render", "chat_stats", "parse_back", "epoch_manifest",
    "rlaif_sample", "rep_penalty", "reward_agent", "tool_validity", "tool_report", "group_advantage", "pretoken_counts", "pair_counts",
    "sft_labels", "pack_trajectories", "gae", "masked_kl", "policy_loss", "rollout_metrics", "pretrain_arrays", "dpo_arrays", "stream_pieces",
    "stream_ingest", "stream_assemble", "bpe_vocab", "bpe_compression",
]
SLOW = 10


def cancel_after(spark, limit: float, done: threading.Event) -> None:
    """Cancels the jobs that run at the limit and, as a query may start others, those of each second after it."""
    if not done.wait(limit):
        while not done.is_set():
            spark.sparkContext.cancelAllJobs()
            done.wait(1)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    limit = float(os.environ.get("BENCH_LIMIT", "120"))
    seconds, unfinished = {}, []
    for name in names:
        query = QUERIES[name][0]
        taken: list[float] = []
        done = threading.Event()
        threading.Thread(target=cancel_after, args=(spark, limit, done), daemon=True).start()
        try:
            while len(taken) < runs + 1 and not (len(taken) == 2 and taken[0] > SLOW):
                start = time.perf_counter()
                query(spark, sf_dir).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
        except Exception as error:  # cancelled, or failed: the others are still timed
            print(f"{name}: {type(error).__name__} {str(error)[:200]}", file=sys.stderr)
        finally:
            done.set()
        if len(taken) > 1:
            seconds[name] = round(statistics.median(taken[1:]), 3)
            print(f"{name}: {seconds[name]} (first {taken[0]:.2f})", file=sys.stderr)
        else:
            unfinished.append(name)
    total = round(sum(seconds.values()), 3)
    out = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "unfinished": unfinished, "sf": os.path.basename(sf_dir.rstrip("/"))}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
