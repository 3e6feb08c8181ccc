"""Run the selection on hot-key inputs and report how evenly tasks share work.

    python tools/skew_check.py [sf_dir]

The inputs are derived from the driver tables by Spark: a third of all
images moved into one hotel, a third of all tags moved onto one image (the
"one key holds a third of all rows" case).  Partition coalescing is off so
each shuffle's partition balance is visible.  For every stage with several
tasks the event log (written to a fresh scratch folder) gives each task's
shuffle records read; the report lists the largest task's share.  A share
near 1/3 or more would mean a hot key landed in one task.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from curato.catalog import POLICY_A  # noqa: E402
from curato.operators import scoring  # noqa: E402
from curato.plans.selection import select_and_reconcile  # noqa: E402
from curato.session import ensure_checkpoint_dir  # noqa: E402
from curato.sources.tables import images_view, picks_view, tags_view  # noqa: E402

HOT_HOTEL = 1
HOT_IMAGE = 1


def skewed_inputs(spark, sf):
    images = images_view(spark, sf).withColumn(
        "hotel_id", F.when(F.col("image_id") % 3 == 0, F.lit(HOT_HOTEL)).otherwise(F.col("hotel_id")))
    tags = tags_view(spark, sf).withColumn(
        "image_id", F.when(F.hash("image_id", "version", "tag") % 3 == 0, F.lit(HOT_IMAGE))
        .otherwise(F.col("image_id")))
    return images, tags, picks_view(spark, sf, images)


def task_shares(event_dir: str, group: str):
    import zstandard
    stage_job, job_group, tasks = {}, {}, {}
    for f in glob.glob(f"{event_dir}/*/events*") + glob.glob(f"{event_dir}/*"):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb").read()
        text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode() if f.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                job_group[e["Job ID"]] = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    stage_job[s] = e["Job ID"]
            elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                m = e["Task Metrics"]
                recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                tasks.setdefault(e["Stage ID"], []).append(recs)
    out = []
    for stage, recs in sorted(tasks.items()):
        # A stage that moves no more rows than a few per partition (a ranking's slice
        # counts) is bounded by the partition count, not by the data: nothing to share.
        if job_group.get(stage_job.get(stage)) != group or len(recs) < 4 or sum(recs) <= 4 * len(recs):
            continue
        out.append((stage, len(recs), sum(recs), max(recs) / sum(recs)))
    return out


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    event_dir = tempfile.mkdtemp(prefix="skew-events-")
    spark = (SparkSession.builder.master("local[8]").appName("curato-skew")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    images, tags, picks = skewed_inputs(spark, sf)
    spark.sparkContext.setJobGroup("measured", "selection on hot-key inputs")
    sel = select_and_reconcile(images, tags, picks, POLICY_A, materialize=True)
    for df in (sel.snapshot, sel.cdc, sel.metrics, sel.updated_picks,
               scoring.rank_images(sel.scored)):
        df.write.format("noop").mode("overwrite").save()
    hot_rows = images.filter(F.col("hotel_id") == HOT_HOTEL).count()
    spark.sparkContext.setJobGroup("other", "other")
    spark.stop()
    shares = task_shares(event_dir, "measured")
    print(f"hot hotel {HOT_HOTEL}: {hot_rows} images; hot image {HOT_IMAGE}: a third of the tags")
    print("stage  tasks  shuffle-records  largest-task-share")
    for stage, n, total, share in shares:
        print(f"{stage:5d}  {n:5d}  {total:15d}  {share:8.3f}")
    worst = max((s for *_, s in shares), default=0.0)
    print(f"worst share: {worst:.3f}")
    return worst


if __name__ == "__main__":
    main(sys.argv)
