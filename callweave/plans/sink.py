"""The sink: named text files from (file, seq, value) rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_files(lines: DataFrame, path: str, gzip: bool = False) -> list[str]:
    """Write each file's lines in order; a file appears under its name only when it is whole.

    The rows of a file meet in one task in sorted order and are streamed out; files are written below a staging
    folder and renamed, so a failed or repeated run leaves no partial file."""
    spark = lines.sparkSession
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    dealt = lines.repartition("file").sortWithinPartitions("file", "seq")
    dealt.select("file", "value").write.partitionBy("file").option("compression", "gzip" if gzip else "none").text(staging)
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    for folder in fs.listStatus(jvm.Path(staging)):
        if not folder.isDirectory():
            continue
        name = folder.getPath().getName().removeprefix("file=")
        part = next(x.getPath() for x in fs.listStatus(folder.getPath()) if x.getPath().getName().startswith("part-"))
        target = jvm.Path(f"{path.rstrip('/')}/{name}")
        fs.delete(target, False)
        fs.rename(part, target)
        names.append(name)
    fs.delete(jvm.Path(staging), True)
    return sorted(names)


def contents(lines: DataFrame) -> DataFrame:
    """(file, content) for small outputs, as the files would read."""
    rows = F.array_sort(F.collect_list(F.struct("seq", "value")))
    return lines.groupBy("file").agg(F.concat(F.array_join(F.transform(rows, lambda r: r["value"]), "\n"), F.lit("\n")).alias("content"))
