"""Time the headline queries and print one JSON line.

Folder and cores come from BENCH_SF_DIR and BENCH_CPUS. Each query runs once to warm up
and is then timed; the index and the vectors are timed as jobs of their own, since
searches share them as a service would.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from placeseek.operators import lexical, semantic  # noqa: E402
from placeseek.plans import load_all, shared  # noqa: E402
from placeseek.plans.registry import QUERIES  # noqa: E402
from placeseek.session import local_session, work_path  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "c7_bm25_floored",
    "a10_batch_search",
    "c11_lexical_search",
    "d6_knn_l2_batch",
    "d9_semantic_search",
    "e10_routed_search",
    "g5_rank_fusion",
    "b14_clean_text",
    "b16_place_names",
    "b24_pages_to_posts",
    "a7_json_parts",
    "a11_keyed_insert",
    "f4_statistics_payload",
    "f10_describe_lineitem",
    "f14_describe_lengths",
    "f20_top_words",
    "f21_tone",
    "g1_context_cues",
    "g7_text_chunks",
    "g9_trend_change",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    begun = time.perf_counter()
    run()
    return round(time.perf_counter() - begun, 3)


def main() -> None:
    load_all()
    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def index() -> None:
        lexical.build_index(shared.searchable(spark, FOLDER), work_path(spark, "bench-index"))

    def vectors() -> None:
        drain(semantic.encode_hashed(shared.searchable(spark, FOLDER), "text", ["doc_id"]))

    for name, job in (("c12_index_build", index), ("d1_encode_corpus", vectors)):
        if os.environ.get("BENCH_ONLY") and name not in os.environ["BENCH_ONLY"].split(","):
            continue
        job()
        seconds[name] = timed(job)
    only = os.environ.get("BENCH_ONLY")
    chosen = [n for n in HEADLINE if not only or n in only.split(",")]
    for name in chosen:
        drain(QUERIES[name](spark, FOLDER))
        seconds[name] = timed(lambda: drain(QUERIES[name](spark, FOLDER)))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
