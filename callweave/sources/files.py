"""Source files: listing, globs, size guard, reading."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache, reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: File extension by language, in scan order, and the default size cap.
EXTENSIONS = {"kotlin": ".kt", "java": ".java"}
MAX_FILE_BYTES = 2_000_000
#: Fixed value: how deep below its root a file may stand.
MAX_DEPTH = 64


def resolve_path(path: str, base: str) -> str:
    """An absolute path or URL as it is, others below the project's folder."""
    return path if re.match(r"[a-zA-Z][\w+.-]*:/|/", path) else str(Path(base, path))


@cache
def path_glob(glob: str) -> str:
    """A path glob as a regular expression: * and ? stay within a folder, ** crosses, {a,b} are alternatives."""
    out, depth, k = [], 0, 0
    while k < len(glob):
        c = glob[k]
        k += 1
        if c == "*":
            double = glob.startswith("*", k)
            k += double
            out.append(".*" if double else "[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "\\" and k < len(glob):
            out.append(re.escape(glob[k]))
            k += 1
        elif c == "[" and (end := glob.find("]", k + 1)) > 0:
            inner = glob[k:end].replace("\\", "\\\\")
            out.append(f"(?!/)[^{inner[1:]}]" if inner[:1] == "!" else f"(?!/)[{inner}]")
            k = end + 1
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
    return f"^{''.join(out)}$"


@cache
def loose_glob(glob: str) -> str:
    """The older text form of a glob: like path_glob, but ? also stands for a slash."""
    names = {"**": ".*", "*": "[^/]*", "?": ".", "{": "(", "}": ")", ",": "|", "[": "[", "]": "]"}
    literal = set(".()+|^$@%")
    parts = re.findall(r"\*\*|.", glob, re.S)
    return "^" + "".join(names.get(p, f"\\{p}" if p in literal else p) for p in parts) + "$"


def by_globs(files: DataFrame, include: list[str] = (), exclude: list[str] = (), column: str = "rel_path") -> DataFrame:
    """Files whose path relative to its root matches an include glob, if there is one, and no exclude glob."""

    def matches(globs) -> Column:
        return reduce(lambda a, b: a | b, (F.col(column).rlike(path_glob(g)) for g in globs))

    out = files.where(matches(include)) if include else files
    return out.where(~matches(exclude)) if exclude else out


def by_size(files: DataFrame, limit: int = MAX_FILE_BYTES, column: str = "size_bytes") -> DataFrame:
    """Files of at most `limit` bytes; a limit of 0 or less lets all pass. The test reaches the file listing."""
    return files.where(F.col(column) <= limit) if limit > 0 else files


def roots_that_exist(spark: SparkSession, roots: list[str]) -> list[str]:
    conf = spark._jsc.hadoopConfiguration()
    paths = ((r, spark._jvm.org.apache.hadoop.fs.Path(r)) for r in roots)
    return [r for r, p in paths if p.getFileSystem(conf).exists(p)]


def _local(root: str) -> str | None:
    """The path of a root in the local file system, the only one that has symbolic links to folders."""
    scheme = re.match(r"([a-zA-Z][\w+.-]*):/+", root)
    return None if scheme and scheme[1] != "file" else re.sub(r"^file:/+", "/", root).rstrip("/") or "/"


def _entries(folder: str) -> list[os.DirEntry]:
    try:
        with os.scandir(folder) as found:
            return sorted(found, key=lambda x: x.name)
    except OSError:
        return []


def walk(spark: SparkSession, root: str) -> tuple[list[str], bool]:
    """Folders below a local root that are no symbolic links nor lie behind one, and whether there are links to folders.

    A walk by frontiers: each round lists the folders of one depth on the executors."""

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(e.path, e.is_symlink()) for f in batch.column("folder").to_pylist() for e in _entries(f) if e.is_dir()]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([x for _, x in found], pa.bool_())], ["folder", "link"])

    folders, frontier, links = [root], [root], False
    for _ in range(MAX_DEPTH - 1):
        rows = spark.createDataFrame([(f,) for f in frontier], "folder string").repartition(min(len(frontier), spark.sparkContext.defaultParallelism))
        found = rows.mapInArrow(below, "folder string, link boolean").collect()
        links = links or any(r["link"] for r in found)
        frontier = sorted(r["folder"] for r in found if not r["link"])
        folders += frontier
        if not frontier:
            break
    return folders, links


def _files_of(spark: SparkSession, folders: list[str], ext: str, max_bytes: int) -> DataFrame:
    """(path, length, content) of the files right in these folders; larger ones are not read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                for e in _entries(folder):
                    if e.name.endswith(ext) and e.name[0] not in "._" and e.is_file() and not 0 < max_bytes < e.stat().st_size:
                        data = Path(e.path).read_bytes()
                        yield pa.RecordBatch.from_arrays([pa.array([e.path]), pa.array([len(data)], pa.int64()), pa.array([data], pa.binary())], ["path", "length", "content"])

    rows = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(len(folders), 4 * spark.sparkContext.defaultParallelism))
    return rows.mapInArrow(read, "path string, length long, content binary")


def list_files(spark: SparkSession, roots: list[str], language: str, max_bytes: int = 0) -> DataFrame:
    """(root, rel_path, path, language, size_bytes, content) below the roots that exist; overlapping roots repeat files.

    Folders below a root that are symbolic links are skipped, so cycles of links end; links to files are followed. The
    size limit is part of the listing, so larger files are never read; columns that are not used are not either."""
    ext = EXTENSIONS[language]
    frames = []
    for root in roots_that_exist(spark, roots):
        folders, links = walk(spark, _local(root)) if _local(root) else ([], False)
        if links:
            found = _files_of(spark, folders, ext, max_bytes)
        else:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{ext}").load(root)
        kept = found.where(F.col("length") <= max_bytes) if max_bytes > 0 else found
        plain = F.regexp_replace("path", r"^[a-zA-Z][\w+.-]*:/+", "/")
        base = re.sub(r"^[a-zA-Z][\w+.-]*:/+", "/", root).rstrip("/")
        rel = F.when(F.startswith(plain, F.lit(base + "/")), F.substring(plain, len(base) + 2, 1 << 30)).otherwise(F.element_at(F.split(plain, "/"), -1))
        kept = kept.where(F.size(F.split(rel, "/")) <= MAX_DEPTH)
        frames.append(kept.select(F.lit(root).alias("root"), rel.alias("rel_path"), plain.alias("path"), F.lit(language).alias("language"), F.col("length").alias("size_bytes"), "content"))
    if not frames:
        return spark.createDataFrame([], "root string, rel_path string, path string, language string, size_bytes bigint, content binary")
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_sources(spark: SparkSession, roots: list[str], language: str, include: list[str] = (), exclude: list[str] = (), max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Source files with their text; files that are no UTF-8 are left out."""
    files = by_globs(list_files(spark, roots, language, max_bytes), include, exclude)
    text = F.when(F.is_valid_utf8(F.col("content")), F.col("content").cast("string"))
    return files.withColumn("text", text).drop("content").where("text is not null")


def package_of(text: Column, language: str) -> Column:
    """The first package declaration, empty for the root package; found without parsing, so files can be pruned first."""
    end = r"\s*;" if language == "java" else ""
    return F.regexp_extract(text, r"(?m)^\s*package\s+([a-zA-Z0-9_.]+)" + end, 1)


def lines_of(files: DataFrame) -> DataFrame:
    """(path, n, line), lines counted from 1."""
    return files.select("path", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("k", "line")).select("path", (F.col("k") + 1).alias("n"), "line")
