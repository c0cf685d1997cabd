"""Fixity audit of WARC replicas with Merkle trees over offset ranges.

A record is hashed with its headers. Above the records stands a tree per archive
whose nodes are offset ranges on a fixed grid: the lowest covers
``2 ** leaf_bits`` bytes, each further level ``2 ** fan_bits`` ranges of the one
below, the root the whole archive. A node's hash is that of its children's
offsets and hashes in order. Replicas compare roots, then only the children of
ranges that differ, down to the records. A record that is lost moves no other,
since ranges go by offset and not by count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linktally.llm.common import cut

_KEYS = ("archive", "node")


def warc_record(record_id: Column, url: Column, html: Column) -> Column:
    """A WARC response record as text: headers, an empty line, the page."""
    page = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(page).cast("string"),
        F.lit("\r\n\r\n"),
        page,
        F.lit("\r\n\r\n"),
    )


def lay_out(records: DataFrame, order: list[str], archive_records: int = 1000) -> DataFrame:
    """Deal records to archives of about ``archive_records`` and give them offsets.

    ``records`` has ``record`` (text) and the ``order`` columns, by whose values the
    archive is hashed and the records of an archive are sorted. Added are
    ``archive, offset, length, digest``; the text itself is not shuffled.
    """
    archives = max(math.ceil(records.count() / archive_records), 1)
    name = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order])
    sized = records.select(
        *order,
        F.pmod(F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long"), F.lit(archives)).alias("archive"),
        F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"),
    )
    before = (
        Window.partitionBy("archive")
        .orderBy(*[F.col(c).asc_nulls_first() for c in order], "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sized.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def leaves(replica: DataFrame) -> DataFrame:
    """``archive, node (offset), hash``: one row per offset.

    Where rows repeat an offset, the hash is of how many there are and of sums over
    all their digests, hashed again, in pieces of 64 bits: it depends on every digest
    and on no order, and no list of them is made.
    """
    digest = F.coalesce("digest", F.lit(""))
    again = F.sha2(digest, 256)
    pieces = [F.conv(F.substring(again, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17, 33, 49)]
    sums = [f"sum_{at}" for at in range(len(pieces))]
    many = F.sha2(F.concat_ws(":", *[F.col(name).cast("string") for name in sums], F.col("copies").cast("string")), 256)
    return (
        replica.groupBy("archive", F.col("offset").alias("node"))
        .agg(
            F.min(digest).alias("least"),
            F.count("*").alias("copies"),
            *[F.sum(piece).alias(name) for piece, name in zip(pieces, sums)],
        )
        .select("archive", "node", F.when(F.col("copies") == 1, F.col("least")).otherwise(many).alias("hash"))
    )


def merkle_levels(records: DataFrame, top: int, leaf_bits: int, fan_bits: int) -> list[DataFrame]:
    """Node tables from the records (level 0) up to the roots (level ``top``)."""
    levels = [records]
    for level in range(1, top + 1):
        below = levels[-1]
        if level == top:
            node = F.lit(0).cast("long")
        else:
            node = F.shiftright("node", leaf_bits if level == 1 else fan_bits)
        children = F.sort_array(F.collect_list(F.struct("child", "hash")))
        text = F.array_join(
            F.transform(children, lambda c: F.concat_ws(":", c["child"].cast("string"), c["hash"])), ","
        )
        levels.append(
            cut(
                below.select("archive", node.alias("node"), F.col("node").alias("child"), "hash")
                .groupBy("archive", "node")
                .agg(F.sha2(text, 256).alias("hash")),
                f"merkle-{level}",
            )
        )
    return levels


def _differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes whose hashes differ or that one side lacks, with both hashes."""
    a = left.select(*_KEYS, F.col("hash").alias("left_hash"))
    b = right.select(*_KEYS, F.col("hash").alias("right_hash"))
    return a.join(b, list(_KEYS), "full_outer").where(~F.col("left_hash").eqNullSafe(F.col("right_hash")))


def audit(left: DataFrame, right: DataFrame, leaf_bits: int = 14, fan_bits: int = 3) -> DataFrame:
    """``archive, offset, status`` of every record that differs between two replicas.

    A replica has ``archive, offset, digest``; further columns are not read.
    ``status`` is ``changed``, or ``missing`` or ``extra`` where only the left or
    only the right replica has a record at that offset. Rows without an archive
    or an offset cannot be placed and raise. Rows that repeat an offset count as
    one record, which differs if their number or digests do. Equal replicas, and
    two empty ones, give no rows; an archive that one side lacks is reported
    record by record.

    A range holds at most ``2 ** leaf_bits`` offsets, so no group can grow with
    the data; the number of levels follows from the largest offset.
    """
    sides = []
    placed = F.coalesce(F.raise_error("record without archive or offset").cast("long"), F.lit(0))
    for name, side in (("left", left), ("right", right)):
        given = side.select(
            F.when(F.col("archive").isNull() | F.col("offset").isNull(), placed).otherwise(F.col("archive")).alias("archive"),
            F.col("offset").cast("long").alias("offset"),
            "digest",
        )
        sides.append(cut(leaves(given), f"merkle-leaves-{name}"))
    last = max(side.agg(F.coalesce(F.max("node"), F.lit(0)).alias("last")).first()["last"] for side in sides)
    top = 1 + math.ceil(max(last.bit_length() - leaf_bits, 0) / fan_bits)
    a, b = (merkle_levels(side, top, leaf_bits, fan_bits) for side in sides)
    found = _differences(a[top], b[top])
    for level in range(top - 1, -1, -1):
        if level + 1 == top:
            parent = F.lit(0).cast("long")
        else:
            parent = F.shiftright("node", leaf_bits if level == 0 else fan_bits)
        suspect = cut(found.select("archive", F.col("node").alias("parent")), f"merkle-suspect-{level}")
        below = [
            side[level].withColumn("parent", parent).join(suspect, ["archive", "parent"], "left_semi") for side in (a, b)
        ]
        found = _differences(*below)
    return found.select(
        "archive",
        F.col("node").alias("offset"),
        F.when(F.col("right_hash").isNull(), "missing")
        .when(F.col("left_hash").isNull(), "extra")
        .otherwise("changed")
        .alias("status"),
    )


def op10_merkle_audit(spark, sf_dir: str) -> DataFrame:
    """Audit WARC archives made of all pages against a replica with damage at known pages.

    The replica lost the records of pages whose id leaves 7 modulo 211 and has a
    changed letter in those that leave 5 modulo 101.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    order = ["page_id", "url"]
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    stored = cut(lay_out(pages.select(*order, record.alias("record")), order), "warc-records")
    damaged = warc_record(
        F.col("page_id"), F.col("url"), F.concat(F.lit("~"), F.substring(F.col("html"), 2, 1 << 30))
    )
    hurt = pages.where("page_id % 101 = 5").select("page_id", F.sha2(damaged, 256).alias("hurt_digest"))
    replica = (
        stored.where("NOT coalesce(page_id % 211 = 7, false)")
        .join(hurt, "page_id", "left")
        .select("archive", "offset", F.coalesce("hurt_digest", "digest").alias("digest"))
    )
    found = audit(stored, replica)
    return stored.join(found, ["archive", "offset"], "left").select(
        "page_id",
        "archive",
        F.col("offset").alias("record_offset"),
        F.col("length").alias("record_length"),
        F.col("digest").alias("record_sha256"),
        F.coalesce("status", F.lit("ok")).alias("status"),
    )


OP10_SQL = r"""
WITH n AS (SELECT greatest(CAST(ceil(count(*) / 1000.0) AS BIGINT), 1) AS archives FROM pages), r AS (
  SELECT page_id, url, html, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html)
    || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record,
    CAST('0x' || substr(md5(page_id || chr(31) || url), 1, 8) AS BIGINT) % (SELECT archives FROM n) AS archive
  FROM pages
)
SELECT page_id, archive,
  CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id, url
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_offset,
  CAST(strlen(record) AS BIGINT) AS record_length, sha256(record) AS record_sha256,
  CASE WHEN page_id % 211 = 7 THEN 'missing' WHEN page_id % 101 = 5 AND substr(html, 1, 1) <> '~' THEN 'changed'
    ELSE 'ok' END AS status
FROM r
"""
