"""What the operators of this subpackage share: session set-up, scratch tables, text rules."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
#: The white space that separates words: space and code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of an Arrow batch. Texts have no length bound, so batches are kept short.
BATCH_ROWS = "250"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package and keep Arrow batches small."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """A temporary folder for sessions without a shared one, removed at exit."""
    path = tempfile.mkdtemp(prefix="callweave-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def _home(spark: SparkSession) -> str:
    """This application's folder in the shared checkpoint folder.

    Without one, a single machine takes a temporary folder of its own; on a cluster executors could not see it."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or _own_folder()).rstrip('/')}/callweave-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession) -> str:
    """A new folder below this application's own."""
    return f"{_home(spark)}/{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove all tables that this application stored; for when results have been written out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_home(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    path = f"{scratch(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one that the scan splits into fewer tasks than there are cores, as small single files, is dealt out to all."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def word_array(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text as an array; null text gives an empty one."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(plain, " "), "")


def word_count(text: Column) -> Column:
    """Number of those words, as a bigint, without building strings for them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
