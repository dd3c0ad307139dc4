"""Whole build from files: ``full_run.py [folder] [work]``.

Writes raw snapshots derived from the generated tables as gzip JSON lines, then reads, builds,
checks, exports and publishes all tables, and prints the seconds of every stage as JSON.
"""

import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from catalog import Tables  # noqa: E402
from catalog.league import SETTINGS, SOURCES  # noqa: E402
from pitchlake.plans.checks import warehouse_report  # noqa: E402
from pitchlake.plans.warehouse import CURATED, export, publish_curated, run  # noqa: E402
from pitchlake.session import build_session  # noqa: E402
from pitchlake.sources.snapshots import read_snapshots  # noqa: E402


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    work = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("full-run", "local[8]", **{
        "spark.sql.shuffle.partitions": "16", "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds, started = {}, time.perf_counter()

    def stage(name):
        nonlocal started
        seconds[name] = round(time.perf_counter() - started, 1)
        started = time.perf_counter()

    source = Tables(spark, folder)
    for name, derive in SOURCES.items():
        (derive(source).select("value", "season").write.partitionBy("season")
         .option("compression", "gzip").text(f"{work}/raw/{name}"))
    stage("derive raw files")
    raw = {f"raw.{n}": read_snapshots(spark, f"{work}/raw/{n}/*/*") for n in SOURCES}
    tables = run(raw, f"{work}/tables", settings=SETTINGS)
    stage("build")
    failed = warehouse_report(tables, raw, F.lit(SETTINGS.as_of).cast("date")).filter(
        "failures > 0").count()
    stage("check")
    export(tables, f"{work}/csv")
    stage("export")
    publish_curated(tables, f"{work}/release", "0123abc")
    stage("publish")
    rows = {n: tables[n].count() for n in CURATED}
    print(json.dumps({"seconds": seconds, "failed_checks": failed, "rows": rows}))


if __name__ == "__main__":
    main()
