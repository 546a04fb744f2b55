"""Where a session's checkpoints go."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def checkpoints(spark: SparkSession) -> None:
    """See that checkpoints have a folder: the one in spark.checkpoint.dir, or one of our own on a single machine."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="callweave-checkpoints-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    context.setCheckpointDir(base)
