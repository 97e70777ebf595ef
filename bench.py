"""Times of the headline queries; prints one line of JSON.

BENCH_SF_DIR tables are written as Ion first, and two made tables of the shapes that
timed once. Each query is run twice and its better time counts.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainstone.sources.reader import read_ion
from grainstone.sources.writer import write_ion

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROWS = int(os.environ.get("BENCH_ROWS", "2000000"))
#: Files of the made tables; a binary file is one task's.
FILES = 4 * int(CPUS)
LINES = {"format": "newline_delimited"}


def narrow(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    pick = lambda words, n: F.element_at(F.array(*map(F.lit, words)), (i % n + 1).cast("int"))
    return spark.range(ROWS, numPartitions=FILES).select(
        i,
        pick(["alpha", "bravo", "charlie", "delta", "echo"], 5).alias("category"),
        ((i % 1000) * F.lit(0.01).cast("decimal(4,2)")).cast("decimal(18,2)").alias("amount"),
        (i % 2 == 0).alias("flag"),
        F.timestamp_seconds(F.lit(1577836800) + i).cast("timestamp_ntz").alias("ts"),
        F.struct((i % 10).alias("sub_id"), pick(["x", "y", "z"], 3).alias("sub_name")).alias("nested"),
        F.array(pick(["t1", "t2", "t3"], 3), F.lit("t4")).alias("tags"),
    )


def wide(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    columns = [(i + k).alias(f"w_int_{k:02d}") for k in range(16)]
    columns += [F.concat(F.lit(f"s{k:02d}_"), i % 10).alias(f"w_str_{k:02d}") for k in range(16)]
    columns += [((i % 1000) * 0.01 + k / 100).alias(f"w_dec_{k:02d}") for k in range(16)]
    return spark.range(ROWS, numPartitions=FILES).select(i, *columns)


def main() -> None:
    spark = SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    base = tempfile.mkdtemp(prefix="bench-")
    at = lambda name: f"{base}/{name}"
    tables = {n: spark.read.parquet(f"{SF_DIR}/{n}.parquet").repartition(int(CPUS)) for n in ("lineitem", "orders", "events")}
    made = {"narrow": narrow(spark), "wide": wide(spark)}
    seconds: dict[str, float] = {}

    def timed(name: str, run, times: int = 2) -> None:
        best = None
        for _ in range(times):
            began = time.time()
            run()
            took = time.time() - began
            best = took if best is None or took < best else best
        seconds[name] = round(best, 3)

    def sink(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    try:
        for name, df in {**tables, **made}.items():
            for binary in (False, True):
                path = at(f"{name}_{'binary' if binary else 'text'}")
                timed(f"write_{name}_{'binary' if binary else 'text'}", lambda df=df, path=path, binary=binary: write_ion(df, path, binary=binary, mode="overwrite"), 1)
        amount = {"amount": "DOUBLE", "category": "VARCHAR"}
        three = {"id": "BIGINT", **amount}
        four = {"id": "BIGINT", "w_int_00": "BIGINT", "w_str_00": "VARCHAR", "w_dec_00": "DOUBLE"}
        for kind in ("text", "binary"):
            own = LINES if kind == "text" else {}
            narrow_at, wide_at = at(f"narrow_{kind}"), at(f"wide_{kind}")
            timed(f"count_{kind}", lambda: read_ion(spark, narrow_at, select=[], columns=three, **own).count())
            timed(f"infer_count_{kind}", lambda: read_ion(spark, narrow_at, select=[], **own).count())
            timed(f"project_min_{kind}", lambda: sink(read_ion(spark, narrow_at, columns={"id": "BIGINT"}, **own)))
            timed(f"project3_{kind}", lambda: sink(read_ion(spark, narrow_at, columns=three, **own)))
            timed(f"filter_group_{kind}", lambda: read_ion(spark, narrow_at, columns=amount, **own).where("amount > 5").groupBy("category").count().collect())
            timed(f"wide_count_{kind}", lambda: read_ion(spark, wide_at, select=[], columns=four, **own).count())
            timed(f"wide_project4_{kind}", lambda: sink(read_ion(spark, wide_at, columns=four, **own)))
            lines = {"l_returnflag": "VARCHAR", "l_linestatus": "VARCHAR", "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE"}
            timed(f"lineitem_summary_{kind}", lambda: read_ion(spark, at(f"lineitem_{kind}"), columns=lines, **own).groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).collect())
            orders = lambda: read_ion(spark, at(f"orders_{kind}"), columns={"o_orderkey": "BIGINT", "o_orderpriority": "VARCHAR"}, **own)  # noqa: E731, B023
            keys = lambda: read_ion(spark, at(f"lineitem_{kind}"), columns={"l_orderkey": "BIGINT"}, **own)  # noqa: E731, B023
            timed(f"join_{kind}", lambda: keys().join(orders(), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority").count().collect())  # noqa: B023
        total = round(sum(seconds.values()), 3)
        print(json.dumps({"metric": "ion_read_write_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "rows": {"narrow": ROWS, "wide": ROWS}, "cpus": int(CPUS)}))
    finally:
        spark.stop()
        shutil.rmtree(base, ignore_errors=True)


if __name__ == "__main__":
    sys.exit(main())
