"""Fixity audit of web archives with Merkle trees.

Each record of an archive is hashed. Records of one range of offsets are hashed in offset
order into a leaf range, ranges into wider ranges, up to a root per archive. Two replicas
are compared at the roots, and only branches that differ are followed down, to the ranges
and then to the records that are corrupt. Ranges are cut by offset, so a damaged record
does not shift the others, and a range's children are at most `fanout`.

Defined cases: a null content hashes as an empty one; an archive or record that one replica
lacks is `missing` or `extra`; repeated rows of one offset enter the hash in hash order and
are compared as one record; empty replicas have no roots and no differences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import Scratch

RANGE_BYTES = 1 << 18
FANOUT = 16


def warc_record(record_id: Column, uri: Column, payload: Column) -> Column:
    """A response record: header lines, an empty line, the payload and two line ends."""
    payload, end = F.coalesce(payload, F.lit("")), F.lit("\r\n")
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), record_id.cast("string"), F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), end, end, payload, end, end,
    )


def measured(records: DataFrame, archive: str, order: str, record: str) -> DataFrame:
    """(archive, order, length, digest) of each record: what moves in place of the bodies."""
    body = F.coalesce(F.col(record), F.lit(""))
    return records.select(F.col(archive).alias("archive"), order, F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"))


def place_records(records: DataFrame, archive: str, order: str, record: str | None = None) -> DataFrame:
    """Add `offset` and `length`: records stand one after another in their archive, whose
    number of rows is bounded by how archives are cut. Rows that have their `length` already (see
    `measured`) need no `record`, and no body goes through the window."""
    past = Window.partitionBy(archive).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sized = records if record is None else records.withColumn("length", F.octet_length(F.coalesce(F.col(record), F.lit(""))).cast("long"))
    return sized.withColumn("offset", F.coalesce(F.sum("length").over(past), F.lit(0)).cast("long"))


def leaves(records: DataFrame, archive: str = "archive", content: str = "record") -> DataFrame:
    """(archive, offset, length, digest) of each record."""
    return records.select(F.col(archive).alias("archive"), "offset", "length", F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("digest"))


def tree(leaf: DataFrame, scratch: Scratch, depth: int, range_bytes: int, fanout: int) -> list[DataFrame]:
    """Levels from ranges up to roots: (archive, node, digest)."""
    entry = F.struct("offset", "length", "digest")
    ranges = leaf.groupBy("archive", F.floor(F.col("offset") / range_bytes).alias("node")).agg(F.sort_array(F.collect_list(entry)).alias("c"))
    text = F.transform("c", lambda x: F.concat_ws(":", x["offset"].cast("string"), x["length"].cast("string"), x["digest"]))
    levels = [scratch.keep(ranges.select("archive", "node", F.sha2(F.array_join(text, "\n"), 256).alias("digest")))]
    for _ in range(depth):
        child = F.struct("node", "digest")
        up = levels[-1].groupBy("archive", F.floor(F.col("node") / fanout).alias("up")).agg(F.sort_array(F.collect_list(child)).alias("c"))
        text = F.transform("c", lambda x: F.concat_ws(":", x["node"].cast("string"), x["digest"]))
        levels.append(scratch.keep(up.select("archive", F.col("up").alias("node"), F.sha2(F.array_join(text, "\n"), 256).alias("digest"))))
    return levels


def audit(a: DataFrame, b: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records on which two replicas differ: (archive, offset, status), where status is
    `changed`, `missing` (only in a) or `extra` (only in b). Both: (archive, offset, length, digest)."""
    scratch = Scratch(a.sparkSession)
    a, b = scratch.keep(a), scratch.keep(b)
    far = a.select("offset").unionByName(b.select("offset")).agg(F.max("offset").alias("m")).first()["m"] or 0
    depth, span = 0, far // range_bytes + 1
    while span > 1:
        depth, span = depth + 1, -(-span // fanout)
    mine, theirs = tree(a, scratch, depth, range_bytes, fanout), tree(b, scratch, depth, range_bytes, fanout)
    open_nodes = None
    for level in range(depth, -1, -1):
        x, y = mine[level], theirs[level].withColumnRenamed("digest", "other")
        if open_nodes is not None:
            parent = ["archive", F.floor(F.col("node") / fanout).alias("up"), "node"]
            x = x.select(*parent, "digest").join(open_nodes, ["archive", "up"], "left_semi").drop("up")
            y = y.select(*parent, "other").join(open_nodes, ["archive", "up"], "left_semi").drop("up")
        differ = x.join(y, ["archive", "node"], "full").where(~F.col("digest").eqNullSafe(F.col("other")))
        open_nodes = scratch.keep(differ.select("archive", F.col("node").alias("up")))
    cut = F.floor(F.col("offset") / range_bytes).alias("up")
    record = F.sort_array(F.collect_list(F.struct("length", "digest")))
    left = a.select("archive", cut, "offset", "length", "digest").join(open_nodes, ["archive", "up"], "left_semi").groupBy("archive", "offset").agg(record.alias("l"))
    right = b.select("archive", cut, "offset", "length", "digest").join(open_nodes, ["archive", "up"], "left_semi").groupBy("archive", "offset").agg(record.alias("r"))
    met = left.join(right, ["archive", "offset"], "full").where(~F.col("l").eqNullSafe(F.col("r")))
    status = F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra").otherwise("changed")
    return met.select("archive", "offset", status.alias("status"))
