"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from holdsift.plans import catalog  # noqa: E402
from holdsift.session import session  # noqa: E402

QUERIES = [
    "url_fingerprint", "page_links", "signal_filename", "signal_url", "signal_page_context", "signal_doc_header",
    "fuzzy_filename", "fuzzy_text", "classify_documents", "grid_rows", "content_duplicates", "novelty_cascade",
    "ledger_upsert", "data_hash", "publish_upsert", "published_top", "drift_header", "review_apply", "run_alerts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or QUERIES
    spark = session(
        "holdsift-bench", master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false", "spark.holdsift.inputPartitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["url_normalize"](spark, sf_dir).limit(1).collect()  # start-up is not the queries' time
    took = {}
    for name in names:
        t = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - t, 3)
        print(f"{name}: {took[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
