"""How tasks and time grow with the input; prints one JSON line per table folder.

Splits are set to 1 MB, so that the small test tables are split as large ones
would be with the usual 128 MB.
"""

import json
import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

from feedworks import workspace
from feedworks.operators.events import event_records
from feedworks.plans import staging
from feedworks.sinks import current_state, keyed_upsert, write_batch
from feedworks.sources import delimited, xml_records

ROOT = os.environ.get("SCALING_ROOT", "/root/testdata")


def timed(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def splits(df) -> int:
    return df.rdd.getNumPartitions()


def batch_seconds(spark, earlier: int) -> float:
    """Time of a batch to an output that has so many batches before it."""
    path = workspace.new_path(spark, "batches")
    for number in range(earlier):
        fs, folder = workspace._folder(spark, f"{path}/batch_id={number}")
        fs.mkdirs(folder)
    workspace.write_note(spark, path, "batches", {"newest": earlier - 1})
    start = time.perf_counter()
    write_batch(spark.range(1000), path, earlier)
    return round(time.perf_counter() - start, 2)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("feedworks-scaling")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="feedworks-"))
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.files.maxPartitionBytes", 1 << 20)
             .config("spark.sql.files.openCostInBytes", 1 << 16).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    batch_seconds(spark, 1)
    print(json.dumps({f"batch_sec_after_{n}": batch_seconds(spark, n) for n in (10, 10_000)}), flush=True)
    for sf in sorted(name for name in os.listdir(ROOT) if name.startswith("sf")):
        sf_dir = f"{ROOT}/{sf}"
        records = xml_records(spark, staging.events_xml(spark, sf_dir))
        flat = event_records(records)
        timed(flat)
        catalogue = delimited(spark, staging.catalogue_tsv(spark, sf_dir), sep="\t")
        target = f"lineitems_{uuid.uuid4().hex[:12]}"
        keyed_upsert(staging.table(spark, sf_dir, "lineitem"), target, "l_orderkey", ["l_linenumber"],
                     path=workspace.new_path(spark, "upsert"))
        state = current_state(spark, target, "l_orderkey")
        print(json.dumps({
            "sf": sf, "events": flat.count(), "xml_tasks": splits(records), "xml_sec": timed(flat),
            "fold_tasks": splits(catalogue), "upsert_log_tasks": splits(spark.table(f"{target}_log")),
            "upsert_state_sec": timed(state),
        }), flush=True)
    workspace.release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
