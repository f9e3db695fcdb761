"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and run in full (results go to the noop sink), once to warm up and then
$BENCH_RUNS times; the median counts. $BENCH_ONLY is a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "a03_system_entity", "a06_schema_profile", "a10_object_manifest", "a14_discover_fks", "b02_constraints", "b05_boolean_order",
    "c01_edge_join", "c03_is_connected_to", "c04_group_by_source", "c05_k_hop", "c07_fk_edges", "d02_count_connected",
    "d04_crawl_stats", "d07_score_summary", "e04_sample_percent", "e05_segment_number", "f03_dedup_content",
    "f04_insert_if_not_found", "g21_word_bleu", "g24_jaccard_chars", "h01_find_similar", "h01_find_similar_many",
    "h03_find_similar_mmr", "h04_approx_similar", "h06_embed_texts", "h12_detections_to_boxes", "i04_extract_blocks_html",
    "i13_segment", "i13_segment_block_rows", "i14_is_clean", "i15_segment_rows", "i17_embedding_rows", "j01_nested_to_graph_nodes", "k04_delete_spec",
    "k12_sql_ingest", "l02_run_once",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]

    from plexus.queries.registry import QUERIES, load_all
    from plexus.session import local_session

    spark = local_session(cpus, app="plexus-bench")
    load_all()
    times = {}
    for name in only or HEADLINE:
        taken = []
        for i in range(runs + 1):
            if i > 1 and taken[1] > 5:
                break  # one warm run says enough about the long ones
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            if i == 0:
                print(f"{name}: first {taken[0]:.2f}s", file=sys.stderr)
        times[name] = round(statistics.median(taken[1:]), 4)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
