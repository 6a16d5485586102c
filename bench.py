"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Each query writes all its rows to a sink that drops them. What a query works on
(the lead table and the submissions) is written beforehand.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leadloom.operators import dashboard, dedupe, merge, query, upsert  # noqa: E402
from leadloom.operators.normalize import normalize_seed, normalize_submissions  # noqa: E402
from leadloom.functions.source import classify_source  # noqa: E402
from leadloom.plans import derived  # noqa: E402
from leadloom.sources.scratch import written  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("leadloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        # methods that the JVM would not compile are better left to smaller units
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = session()
    def several_files(df):
        return written(df.repartition(int(CPUS)), "bench")

    raw = several_files(derived.leads_raw(spark, SF_DIR))
    leads = several_files(derived.leads(spark, SF_DIR))
    signups = several_files(derived.submissions_raw(spark, SF_DIR))
    followups = several_files(derived.followups_raw(spark, SF_DIR))
    seed = several_files(normalize_seed(derived.seed_update_raw(spark, SF_DIR)))
    talk = derived.table(spark, SF_DIR, "conversations")
    jobs = {
        "normalize_seed": lambda: normalize_seed(raw),
        "classify_leads": lambda: classify_source(raw, "notes"),
        "classify_conversations": lambda: classify_source(talk, "text"),
        "dashboard": lambda: dashboard.dashboard(leads),
        "list_search": lambda: query.list_leads(leads, q="jane", limit=200),
        "export_rows": lambda: query.export_rows(leads, status="new"),
        "dedupe_candidates": lambda: dedupe.dedupe_candidates(leads),
        "pair_scores": lambda: dedupe.pair_scores(leads),
        "seed_upsert": lambda: upsert.seed_upsert(leads, seed),
        "apply_patches": lambda: upsert.apply_patches(leads, derived.patches(spark, SF_DIR)),
        "merge_signups": lambda: merge.merge_submissions(leads, normalize_submissions(signups)).leads,
        "merge_followups": lambda: merge.merge_submissions(leads, normalize_submissions(followups)).leads,
    }
    times = {}
    for name, job in jobs.items():
        seen = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            seen.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seen), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    result = {"metric": "headline queries, median seconds, summed", "value": total, "unit": "sec"}
    print(json.dumps({**result, "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
