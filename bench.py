"""Times the headline queries and prints one JSON line.

Every query runs once to warm up (code generation, file caches) and then three
times, or once if it is a long one; the median counts.  Results
go to a sink that reads every row and column and keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scrubwell.plans import catalog  # noqa: E402
from scrubwell.session import local_session  # noqa: E402

HEADLINE = (
    "redact_all",
    "clean_corpus",
    "report_by_source",
    "strip_html",
    "redact_phone",
    "normalize_nfc",
    "drop_repeats",
    "token_tally",
    "dedupe_texts",
    "detect_language",
    "route_foreign",
    "spell_correct",
    "redact_entities",
    "stream_clean",
    "scan_variant",
    "redact_profanity_table",
    "dedupe_incremental",
    "report_merged",
)
LONG = 5.0


def run_once(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "scrubwell-bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    size = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "count(*) AS docs", "sum(octet_length(text)) / 1e6 AS mb"
    ).first()
    timings: dict[str, float] = {}
    for name in names:
        first = run_once(spark, name, folder)
        repeats = 1 if first > LONG else 3
        runs = [run_once(spark, name, folder) for _ in range(repeats)]
        timings[name] = round(statistics.median(runs), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    rates = {
        name: {
            "docs_per_sec": round(size.docs / timings[name]),
            "mb_per_sec": round(size.mb / timings[name], 1),
        }
        for name in ("redact_all", "clean_corpus", "spell_correct", "route_foreign")
        if name in timings
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
