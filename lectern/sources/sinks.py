"""Sinks and their readers: JSON lines, an inverted index, text bundles; and sources of files."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.canonical import canonical
from lectern.operators.intervals import ranked


def numbered_in_order(df: DataFrame, order: str | tuple[str, ...], name: str) -> DataFrame:
    """df with a position from 1 in a total order of all rows, without gathering them in one task."""
    return ranked(df, [], [order] if isinstance(order, str) else list(order), name)


def json_lines(df: DataFrame, row: Column, order: str) -> DataFrame:
    """(line): a canonical JSON record for each row, in order; write it with DataFrameWriter.text."""
    return df.select(order, canonical(row).alias("line")).sort(order).select("line")


def scan_json_lines(lines: DataFrame, schema: str) -> DataFrame:
    return lines.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def inverted_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, documents, first_id) over folded words."""
    words = F.array_distinct(F.split(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), " "))
    return docs.select(key, F.explode(words).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("documents"), F.min(key).alias("first_id"))


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, key): a row for each distinct folded word of a document; write it sorted by word."""
    words = F.array_distinct(F.split(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), " "))
    return docs.select(F.explode(words).alias("word"), key).filter("word <> ''")


def lookup(index: DataFrame, words: list[str]) -> DataFrame:
    """The rows of postings for some words, folded alike; the filter reaches the scan of an index that is written."""
    return index.filter(F.col("word").isin([w.lower() for w in words]))


def review_items(df: DataFrame, state: str) -> DataFrame:
    """The rows that were held or refused."""
    return df.filter(F.col(state).isin("held", "refused"))


def sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """(section): each text under a line that tells its key and how many characters follow, so that any text can be read back."""
    head = F.concat(F.lit("=== "), F.col(key), F.lit(" "), F.length(text).cast("string"), F.lit("\n"))
    return df.select(F.concat(head, F.col(text)).alias("section"))


def scan_sections(df: DataFrame) -> DataFrame:
    """(act_key, text) of sections; one whose length isn't as told fails the read."""
    first = F.substring_index("section", "\n", 1)
    key, told = F.split_part(first, F.lit(" "), F.lit(2)), F.split_part(first, F.lit(" "), F.lit(3)).cast("int")
    text = F.substr("section", F.length(first) + 2, F.length("section"))
    whole = F.when(F.length(text) == told, text).otherwise(F.raise_error(F.concat(F.lit("section cut off: "), key)))
    return df.select(key.alias("act_key"), whole.alias("text"))


def write_bundles(df: DataFrame, folder: str, order: str, text: str, path: str) -> None:
    """A folder of text files for each value of folder, of many rows in several; by name and within they are in order."""
    df.select(folder, order, text).repartitionByRange(folder, order).sortWithinPartitions(folder, order).select(folder, text).write.partitionBy(folder).mode("errorifexists").text(path)


class Refused(ValueError):
    """A folder that may not be read as it is."""


def walk(spark: SparkSession, folder: str, max_entries: int = 1_000_000, max_depth: int = 64) -> list[tuple[str, int]]:
    """(relative path, bytes) of the files under a folder, in order; more than the bounds, links and what is no file are refused.

    The listing is the driver's, who holds max_entries names at most.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    local = fs.getUri().getScheme() == "file"
    found, open_ = [], [(root, "", 0)]
    while open_:
        at, name, depth = open_.pop()
        for status in fs.listStatus(at):
            own = name + status.getPath().getName()
            try:
                own.encode()
            except UnicodeEncodeError:
                raise Refused(f"a name that isn't text: {own!r}") from None
            if "\ufffd" in own:
                raise Refused(f"a name that isn't text: {own!r}")
            path = status.getPath().toUri().getPath()
            if status.isSymlink() or (local and os.path.islink(path)):
                raise Refused(f"a link: {own}")
            if status.isDirectory():
                if depth >= max_depth:
                    raise Refused(f"deeper than {max_depth}: {own}")
                open_.append((status.getPath(), own + "/", depth + 1))
            elif local and not os.path.isfile(path):
                raise Refused(f"no regular file: {own}")
            else:
                found.append((own, status.getLen()))
                if len(found) > max_entries:
                    raise Refused(f"more than {max_entries} files")
    return sorted(found)


def inventory(spark: SparkSession, folder: str, max_bytes: int, max_entries: int = 1_000_000, max_depth: int = 64) -> DataFrame:
    """(relative_path, bytes, sha256) of the files under a folder, those without bytes too; see walk for what is refused.

    Refused, when they are read, are also a file larger than max_bytes and one whose bytes aren't as many as were listed.
    """
    listed = walk(spark, folder, max_entries, max_depth)
    names = spark.createDataFrame(listed, "relative_path string, listed long")
    large = [n for n, size in listed if size > max_bytes]
    if large:
        raise Refused(f"larger than {max_bytes} bytes: {large[0]}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "false").load(folder)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath()
    path = F.regexp_replace(F.col("path"), "^[a-z]+:/*" + re.escape(root.strip("/")) + "/", "")
    read = files.select(path.alias("relative_path"), F.octet_length("content").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    both = names.join(read, "relative_path", "left")  # Spark's scan passes over files without bytes
    moved = F.raise_error(F.concat(F.lit("changed while it was read: "), F.col("relative_path")))
    size = F.when(F.col("listed") == F.coalesce("bytes", F.lit(0)), F.col("listed")).otherwise(moved.cast("long"))
    return both.select("relative_path", size.alias("bytes"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("sha256"))


@contextmanager
def shared_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own under spark.checkpoint.dir, which is removed afterwards; what is returned from it has to be checkpointed.

    Only a session on one machine may have none: a folder of that machine stands in.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lectern-"))
        named = sc.getCheckpointDir()
    path = f"{named.rstrip('/')}/lectern-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def overwrite_index(df: DataFrame, path: str) -> DataFrame:
    """A derived index in the place of the one before, reread; readers see one or the other by Spark's commit."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_tree(df: DataFrame, keys: list[str], path: str) -> None:
    """An artifact table partitioned by its keys; a path that exists is refused, not merged into."""
    df.write.partitionBy(*keys).mode("errorifexists").parquet(path)


def publish_sealed(df: DataFrame, keys: list[str], path: str) -> str:
    """publish_tree, and what became of it: 'published', or 'refused' where something stands at the path, which stays as it was."""
    try:
        publish_tree(df, keys, path)
    except AnalysisException as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
        return "refused"
    return "published"
