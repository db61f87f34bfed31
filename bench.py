"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from corpusforge.plans.queries import registry
from corpusforge.session import build_session

HEADLINE = [
    "star_join", "entity_scoreboard", "entity_profile", "entity_summary", "chunk_documents",
    "page_sections", "clean_text", "paper_chunks", "unified_corpus", "change_feed", "index_sync",
    "refresh_due", "vector_topk", "keyword_topk", "hybrid_topk", "evaluation_report",
    "tool_dispatch", "conversation_outcome",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = registry()
    spark.read.parquet(f"{folder}/region.parquet").count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            available[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
