"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``queries`` and ``value`` are first runs in the session; ``warm`` has the second run of the queries in WARM.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.plans import load_queries
from changeflow.session import get_session

HEADLINE = (
    "decode_delimited", "decode_ctrl", "decode_json_image", "decode_json_array", "decode_fixed_be", "decode_fixed_le",
    "decode_proto", "bind_changes", "cast_typed", "net_changes", "net_changes_long", "net_rejects", "net_lineage",
    "merge_batch", "apply_update_sparse", "key_change_chain", "key_change_vacate", "nopk_replay", "hold_after_error",
    "sql_text_update", "table_stats", "throughput_by_table", "seek_time", "stream_live_view", "stream_apply",
)

WARM = (
    "decode_delimited", "decode_ctrl", "decode_json_image", "decode_json_array", "decode_fixed_be", "decode_fixed_le",
    "decode_proto", "bind_changes", "net_changes", "net_rejects", "merge_batch",
)


def timed(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "changeflow-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_queries()
    names = sys.argv[1:] or HEADLINE
    seconds = {name: timed(queries[name], spark, sf_dir) for name in names}
    warm = {name: timed(queries[name], spark, sf_dir) for name in names if name in WARM}
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "warm": warm, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
