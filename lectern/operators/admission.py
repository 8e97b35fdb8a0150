"""Admission of submitted files: a decision for every declared page, by reasons in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.intervals import running_sum
from lectern.operators.reconcile import publish
from lectern.sources.formats import sniff
from lectern.sources.structure import pages_of, structural_fault

#: Formats that hold pages.
CONTAINERS = ("pdf", "tiff")


def decision(page_index: Column, declared: Column, size: Column, digest: Column, detected: Column, pages: Column, fault: Column, max_bytes: int) -> Column:
    """(outcome, reason) of one declared page: the first of the reasons that holds, else 'admitted'.

    A changed copy is told before anything else is looked at; a container needs a page index that it has; then come
    emptiness, size, and what the file's structure says.
    """
    container = detected.isin(*CONTAINERS) & (pages > 1)
    reason = (
        F.when(declared.isNotNull() & (declared != digest), "digest-mismatch")
        .when(page_index.isNull() & F.coalesce(container, F.lit(False)), "unsupported-variant")
        .when(size == 0, "empty")
        .when(size > max_bytes, "too-large")
        .when(fault == "unknown format", "unrecognized-format")
        .when(fault.isNotNull(), F.concat(F.lit("corrupt: "), fault))
        .when(page_index >= pages, "unsupported-variant")
    )
    return F.struct(F.when(reason.isNull(), "admitted").otherwise("refused").alias("outcome"), reason.alias("reason"))


def decide(sources: DataFrame, max_bytes: int) -> DataFrame:
    """sources (content, declared_sha256, page_index, ...) with detected, digest, outcome and reason; a null content is empty."""
    data = F.coalesce("content", F.lit(bytearray()))
    rows = sources.withColumns({"detected": sniff(data), "digest": F.sha2(data, 256)})
    rows = rows.withColumns({"pages": pages_of(F.col("detected"), data), "fault": structural_fault(F.col("detected"), data)})
    d = decision(F.col("page_index"), F.col("declared_sha256"), F.octet_length(data), F.col("digest"), F.col("detected"), F.col("pages"), F.col("fault"), max_bytes)
    return rows.withColumn("d", d).select(*sources.columns, "detected", "digest", "d.outcome", "d.reason")


def expanded(sources: DataFrame, order: list[str]) -> DataFrame:
    """sources (content, ...), a row for each page: page_index is null for what is no container, ordinal counts all pages from 1.

    Files are numbered through by the pages of those before, so that a file moves once, whatever its pages, and rows of one
    order, or of none, stay apart.
    """
    c = F.col
    data = F.coalesce("content", F.lit(bytearray()))
    rows = running_sum(sources.withColumn("__pages", pages_of(sniff(data), data)), order, "__pages", "__upto")
    rows = rows.withColumn("__page", F.explode(F.sequence(F.lit(0), c("__pages") - 1)))
    numbers = [F.when(c("__pages") > 1, c("__page")).alias("page_index"), (c("__upto") - c("__pages") + c("__page") + 1).alias("ordinal")]
    return rows.select(*order, *numbers, *(k for k in sources.columns if k not in order))


def admissions(sources: DataFrame, order: list[str], max_bytes: int, stored: DataFrame) -> DataFrame:
    """One record for each declared page (order, ordinal, page_index, outcome, reason, digest) and what to do with it.

    stored: the records (key, sha256) that are there; action is 'insert', 'reuse', or 'conflict' where a record of other
    content stands under the key.
    """
    rows = decide(expanded(sources, order), max_bytes)
    sealed = F.sha2(F.concat_ws("|", "digest", "outcome", F.coalesce("reason", F.lit("")), F.coalesce(F.col("page_index").cast("string"), F.lit("-"))), 256)
    rows = rows.withColumns({"key": F.concat(F.lit("page-"), F.col("ordinal").cast("string")), "sha256": sealed})
    return publish(rows.select(*order, "ordinal", "page_index", "outcome", "reason", "digest", "key", "sha256"), stored, "key", "sha256")
