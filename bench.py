"""Headline queries, timed one by one; prints one JSON line.

Every query is planned and run in full into a sink that discards the rows, so the time covers all
columns of all rows. Each runs ``BENCH_RUNS`` times (2 by default) and the best run counts, so that
class loading and code compilation do not hide the work.
"""

from __future__ import annotations

import json
import os
import sys
import time

from marketframe import builder
from marketframe.queries import QUERIES

HEADLINE = (
    "pair_ratio",
    "natural_join_annotate",
    "join_many_to_many",
    "last_by_many",
    "sum_by_keys",
    "derived_ticks_bid_ask",
    "derived_bars_historical",
    "derived_orders_submitted",
    "null_sentinels",
    "special_conditions",
    "json_note",
    "broker_time_parse",
    "html_unescape",
    "ema_time_blocked",
    "previous_row_blocked",
    "previous_row_return",
    "quote_change_only",
    "ohlc_bars_5s",
    "ohlc_bars_1d",
    "tick_history_after",
    "snapshot_when",
    "ema_time",
    "prediction_bands",
    "order_intents",
    "beta_regression",
    "hedge",
    "option_scenarios",
    "scenario_risk",
    "error_enrich",
    "resolve_contracts",
    "request_fanout",
    "stream_last_by",
    "stream_ema",
    "stream_bars",
    "stream_ema_keyed",
    "bars_rollup_all_sizes",
    "contract_search_indexed",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["select_distinct"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf_dir)),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
