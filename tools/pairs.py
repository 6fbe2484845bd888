"""Time alternative plans for one operator on the same stored input: ``pairs.py <sf_dir> <scratch> [copies]``."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from deskloom import configure  # noqa: E402
from deskloom import settings as S  # noqa: E402
from deskloom.operators import eav, upsert  # noqa: E402
from deskloom.plans import views  # noqa: E402
from deskloom.sample import Desk  # noqa: E402


def newest_by_maximum(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in key and c not in order]
    return rows.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("_best")).select(*key, "_best.*")


def first_by_join_back(t) -> DataFrame:
    events = t["changeevent"].select(F.col("id").alias("firstchanged"), "pvalue")
    return views.first_change_id(t).join(events, "firstchanged").select("ticketid", F.col("pvalue").alias("initialpriority"))


def clock(name: str, make: Callable[[], DataFrame], runs: int = 4) -> None:
    times = []
    for _ in range(runs):
        start = time.time()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.time() - start)
    print(f"{name:40s} first {times[0]:6.2f}s best {min(times[1:]):6.2f}s", flush=True)


def main() -> None:
    sf_dir, scratch = sys.argv[1], sys.argv[2]
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 1
    spark = configure(
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.log.level", "OFF")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .getOrCreate()
    )
    desk, stored = Desk(spark, sf_dir), {}

    def copied(rows: DataFrame, *ids: str) -> DataFrame:
        far = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        for column in ids:
            far = far.withColumn(column, F.when(F.col(column) > 0, F.col(column) + F.col("_copy") * 100_000_000).otherwise(F.col(column)))
        return far.drop("_copy")

    shifted = {"ticketdata": ["objectid"], "changeevent": ["id", "auditid"], "audit": ["id", "ticketid"], "ticketfields": []}
    for name, ids in shifted.items():
        rows = copied(desk[name], *ids) if ids else desk[name]
        rows.write.mode("overwrite").parquet(f"{scratch}/{name}")
        stored[name] = spark.read.parquet(f"{scratch}/{name}")
    copied(desk.source("lineitem"), "l_orderkey").write.mode("overwrite").parquet(f"{scratch}/lineitem")
    lines = spark.read.parquet(f"{scratch}/lineitem")

    data, titles = stored["ticketdata"], S.TICKET_ATTRIBUTES
    print({n: r.count() for n, r in stored.items()}, lines.count())
    clock("pivot: five joins (used)", lambda: eav.pivot(data, titles, "ticketid"))
    clock("pivot: one list per entity", lambda: eav.pivot_one_pass(data, titles, "ticketid"))
    clock("pivot: one maximum per title", lambda: eav.pivot_unique(data, titles, "ticketid"))
    key, order = ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    clock("newest: row_number (used)", lambda: upsert.newest(lines, key, order))
    clock("newest: max(struct)", lambda: newest_by_maximum(lines, key, order))
    clock("first change: min(struct) (used)", lambda: views.ticket_initial_priority(stored))
    clock("first change: join back", lambda: first_by_join_back(stored))


if __name__ == "__main__":
    main()
