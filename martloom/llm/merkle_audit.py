"""WARC fixity by Merkle trees.

Records of an archive file stand at ordered offsets. A leaf of the file's tree is the digest of
a record with its offset and length; a node is the digest of up to FANOUT consecutive children.
The trees are written level by level, so they are computed once and later audits only read
them. Two replicas are compared from the roots down: a level's nodes are read only below nodes
that differ on the level above, and what differs among the leaves is the damage, with its file,
offset and length.

Defined cases: a file or record that one replica lacks is ``missing`` or ``extra``; records with
equal bytes are told apart by their place; a null url or html is empty, a null page_id goes to
the file -1; rows that repeat a page_id follow one another by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.scratch import materialize

FANOUT = 16
FILE_RECORDS = 1024  # page numbers of one archive file

LEAF = ["file", "seq", "offset", "length", "page_id", "sha256"]


def record(url: Column, html: Column, page_id: Column) -> Column:
    """A WARC record as bytes."""
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    name = F.coalesce(page_id.cast("string"), F.lit(""))
    lines = ["WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: ", url]
    lines += ["\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:page:", name]
    lines += [">\r\nContent-Type: text/html\r\nContent-Length: ", F.octet_length(html).cast("string")]
    lines += ["\r\n\r\n", html, "\r\n\r\n"]
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in lines]).cast("binary")


def archive(pages: DataFrame) -> DataFrame:
    """file, seq, offset, length, page_id and record, written: a file per FILE_RECORDS ids."""
    own = pages.select(
        F.coalesce(F.floor(F.col("page_id") / FILE_RECORDS), F.lit(-1)).alias("file"),
        "page_id",
        record(F.col("url"), F.col("html"), F.col("page_id")).alias("record"),
    ).withColumn("length", F.octet_length("record").cast("bigint"))
    order = Window.partitionBy("file").orderBy("page_id", F.xxhash64("record"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumns(
        {
            "seq": F.row_number().over(order) - 1,
            "offset": F.coalesce(F.sum("length").over(before), F.lit(0)),
        }
    )
    return materialize(placed.select("file", "seq", "offset", "length", "page_id", "record"), "warc")


def leaves(records: DataFrame) -> DataFrame:
    """The written fixity list of a replica: place and digest of every record, without bytes."""
    digest = F.sha2("record", 256).alias("sha256")
    return materialize(
        records.select("file", "seq", "offset", F.octet_length("record").cast("bigint").alias("length"), "page_id", digest),
        "leaves",
    )


def tree(leaf_list: DataFrame) -> list[DataFrame]:
    """Levels (file, node, digest) from the leaves up, each written; the last has the roots."""
    own = F.sha2(F.concat_ws(":", "offset", "length", "sha256"), 256)
    levels = [materialize(leaf_list.select("file", F.col("seq").cast("bigint").alias("node"), own.alias("digest")), "level")]
    widest = leaf_list.agg(F.max("seq")).first()[0] or 0
    while widest:
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))
        joined = F.concat_ws(",", F.transform(children, lambda c: F.concat_ws("=", c.node, c.digest)))
        parent = F.floor(F.col("node") / FANOUT).alias("node")
        above = levels[-1].groupBy("file", parent).agg(F.sha2(joined, 256).alias("digest"))
        levels.append(materialize(above.select("file", "node", "digest"), "level"))
        widest //= FANOUT
    return levels


def _different(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    other = theirs.withColumnRenamed("digest", "found")
    both = mine.join(other, ["file", "node"], "full_outer")
    return both.where(~F.col("digest").eqNullSafe(F.col("found"))).select("file", "node")


def damaged(mine: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """(file, node) of the leaves that differ, found from the roots down. A shorter tree's
    root is compared once its level is reached; above, only the other replica has nodes."""
    found = None
    for level in reversed(range(max(len(mine), len(theirs)))):
        sides = [t[level] if level < len(t) else t[0].limit(0) for t in (mine, theirs)]
        if found is not None:
            up = found.select("file", F.col("node").alias("_parent"))
            sides = [
                s.join(
                    up, (s["file"] == up["file"]) & (F.floor(s["node"] / FANOUT) == up["_parent"]), "left_semi"
                )
                for s in sides
            ]
        found = materialize(_different(*sides), "different")
    return found


def audit(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """Every damaged record: file, offset, length, page_id, both digests and what happened.

    ``mine`` and ``theirs`` are fixity lists from :func:`leaves`.
    """
    bad = damaged(tree(mine), tree(theirs)).withColumnRenamed("node", "seq")
    key = ["file", "seq"]
    left = bad.join(mine.select(*LEAF), key, "left")
    right = theirs.select(
        *key, F.col("offset").alias("_offset"), F.col("length").alias("found_length"),
        F.col("page_id").alias("_page_id"), F.col("sha256").alias("found_sha256"),
    )
    status = F.when(F.col("found_sha256").isNull(), "missing").when(F.col("sha256").isNull(), "extra")
    return left.join(right, key, "left").select(
        "file",
        F.coalesce("offset", "_offset").alias("offset"),
        "length",
        F.coalesce("page_id", "_page_id").alias("page_id"),
        "sha256",
        "found_length",
        "found_sha256",
        status.otherwise("altered").alias("status"),
    )


def decayed(records: DataFrame) -> DataFrame:
    """A second replica as time might leave it: by the first two hex digits of a record's
    digest, 00 has a changed last byte, 01 is lost, and 02 has lost its last ten bytes."""
    mark = F.substring(F.sha2("record", 256), 1, 2)
    size = F.octet_length("record")
    head = F.expr("substring(record, 1, octet_length(record) - 1)")
    short = F.expr("substring(record, 1, octet_length(record) - 10)")
    changed = (
        F.when(mark == "00", F.concat(head, F.lit(b"?")))
        .when((mark == "02") & (size > 10), short)
        .otherwise(F.col("record"))
    )
    return records.where(mark != "01").withColumn("record", changed)


def audit_pages(pages: DataFrame) -> DataFrame:
    """Archive the pages, let a replica decay, and report what the audit finds."""
    stored = archive(pages)
    return audit(leaves(stored), leaves(decayed(stored)))
