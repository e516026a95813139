"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the threads (8).
Each query runs in full into a no-op sink; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from candlewick.plans.queries import QUERIES  # noqa: E402
from candlewick.session import build_session  # noqa: E402

HEADLINE = (
    "candles_daily",
    "candles_event_time",
    "candles_arrival_order",
    "indicators_batch",
    "indicators_trailing100",
    "moving_average",
    "enriched_candles",
    "latest_n",
    "latest_100_per_instrument",
    "scalping_signals",
    "signals_symbol",
    "market_summary",
    "ml_training_set",
    "ml_features",
    "ml_scaled",
    "json_tick_decode",
    "ticker_parse",
    "instrument_upsert",
    "upsert_last_wins",
    "insert_ignore",
    "dq_report",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        app="candlewick-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["candles_daily"](spark, folder).count()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
