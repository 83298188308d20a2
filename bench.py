"""Time the headline queries and print one JSON line.

``bpe_merges`` and ``bpe_vocabulary`` train each time, 1,024 merges and the whole vocabulary. ``vocab`` trains the 256
merges that the encoding queries after it load, so that their times hold no training.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "corpus_overview", "render_chat", "min_length", "word_counts", "bpe_merges", "bpe_vocabulary", "vocab", "encode_bytes", "encode_bpe",
    "encode_bpe_in_place", "roundtrip", "budget_cut", "shards_offset", "shards_greedy", "shard_table", "export_bin",
    "pack_sequences", "pipeline_shards", "pack_from_files", "bigram_perplexity", "topk_nucleus", "interval_metrics", "rolling_step_time", "stream_ingest",
]


def main() -> None:
    from shardloom.plans.queries import QUERIES
    from shardloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [a for a in sys.argv[1:] if a in QUERIES] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.shardloom.scanPartitions", cpus if cpus.isdigit() else "8")  # the tables are single row groups

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("min_length")  # starts the JVM's code generation and the file caches
    times = {name: round(run(name), 3) for name in names}
    tokens = QUERIES["split_totals"](spark, sf_dir).groupBy().sum("n_tokens").first()[0]
    line = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
            "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus, "byte_tokens": tokens}
    if "encode_bytes" in times:
        line["encode_bytes_tokens_per_sec"] = round(tokens / times["encode_bytes"])
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
