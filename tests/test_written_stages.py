"""Written stages leave nothing behind but the stage itself."""

import os
import time

from pyspark.sql import functions as F

from hourglass.session import SHUFFLE_CLEANUP, materialize


def _shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    kept = spark.range(0, 50_000, 1, 4).groupBy((F.col("id") % 1009).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = materialize(kept, "written-stage")
    for _ in range(50):  # the files are deleted in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert out.count() == 1009 and out.agg(F.sum("n")).first()[0] == 50_000
    assert kept.count() == 1009  # the frame itself can be run again
