"""Times the load, the answers and the checks; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from registry import derived
from registry.queries import registered, staging, star
from starloom.plans.load import load_star
from starloom.session import get_spark
from starloom.sources.warehouse import new_folder


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return round(time.perf_counter() - begin, 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        f"local[{cpus}]",
        "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    # Makes the text tables, which are the input and not the work, and warms the load up.
    star(spark, sf_dir)
    load = lambda: load_star(spark, staging(spark, sf_dir), new_folder(spark, "bench"), by_place=True)
    seconds = {"load_star": min(timed(load) for _ in range(2))}
    for name, query in registered().items():
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = min(
            timed(lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save())
            for _ in range(2)
        )
    orders = derived.table(spark, sf_dir, "orders").count()
    print(
        json.dumps(
            {
                "metric": "total_warm_time",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "orders": orders,
                "load_orders_per_sec": round(orders / seconds["load_star"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
