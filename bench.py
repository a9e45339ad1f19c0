"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.catalog import queries  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINES = [
    "d14_load_fact",
    "d15_journal_fact",
    "d1_scd1",
    "d3_scd2_merge",
    "d5_scd2_hash_and_flag",
    "d7_scd2_from_control",
    "d7_load_by_control",
    "d8_merge",
    "d9_surrogate_keys",
    "d16_incremental_extract",
    "d22_apply_status",
    "a1_revenue_mart",
    "a3_claim_mart",
    "a4_revenue_mart_pre_aggregated",
    "a12_string_agg_distinct",
    "j1_inner_chain",
    "j6_role_playing",
    "j10_pre_aggregated",
    "w1_dedup_kept",
    "w1_dedup_removed",
    "w3_forward_fill",
    "q3_split_nulls",
    "q5_split_bad_dates",
    "q9_validate_files",
    "k1_land_to_bronze",
    "s16_copy_into",
    "r3_restart",
    "v4_as_of_version",
    "v6_restore",
    "v9_zorder",
    "l1_lineage",
    "l6_interval_depth",
    "l7_sql_references",
    "l8_key_usage",
    "f3_plain_text",
    "f10_explode_words",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "tidemark-bench", **{"spark.sql.shuffle.partitions": cores})
    known = queries()
    wanted = sys.argv[1:] or HEADLINES

    def run(name: str) -> float:
        began = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    run("t5_union_all")
    run("j1_inner_chain")
    times = {name: round(run(name), 3) for name in wanted}
    scale = Path(folder).name.removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
