"""WARC fixity audit with Merkle trees over records and ordered offset ranges.

A replica is a table of records: archive, offset, length and digest (SHA-256 of the record). Records
of one offset range form a leaf node, FANOUT neighbouring nodes the node above, up to one root for
each archive; a node's hash covers its children's places and hashes in order. The audit compares the
roots of two replicas and, level by level, only the children of nodes that differ, down to the
records. Nodes are aggregated by range, so a huge archive is many small groups.

Nulls, empties, ties: a record without archive belongs to one named ''. A null payload is an empty
one. Records that repeat an offset are told apart by digest and counted; a missing repetition is
found like any other loss. Two empty replicas agree; an archive that one replica lacks is reported
record by record. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import staged

RANGE = 1 << 16
FANOUT = 16
#: Ranges, then FANOUT times as much at each level: the root spans 2^16 * 16^6 = 2^40 bytes.
LEVELS = 6
PER_ARCHIVE = 1000


def header(url: Column, id_: Column, body: Column) -> Column:
    """The head of a WARC resource record; both line breaks are those of the format."""
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(id_.cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame) -> DataFrame:
    """Pages laid out as archives of PER_ARCHIVE page ids: archive, offset, length, digest, page_id.

    Pages without an id go to archives by their content.
    """
    body = F.coalesce("html", F.lit(""))
    record = F.concat(header(F.col("url"), F.col("page_id"), body), body, F.lit("\r\n\r\n"))
    each = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(record.cast("binary"), 256).alias("digest"), F.octet_length(record).cast("long").alias("length"))
    number = F.expr(f"page_id div {PER_ARCHIVE}").cast("string")
    each = each.withColumn("archive", F.coalesce(number, F.concat(F.lit("none-"), F.substring("digest", 1, 4))))
    # Records that agree in everything lie one behind the other; they are one row until they have offsets.
    each = each.groupBy("archive", "page_id", "digest", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("archive").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("at", F.coalesce(F.sum(F.col("n") * F.col("length")).over(before), F.lit(0)))
    each = each.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return each.select("archive", (F.col("at") + F.col("k") * F.col("length")).alias("offset"), "length", "digest", "page_id")


def tree(replica: DataFrame) -> DataFrame:
    """level, archive, node, hash, n of all levels; level 0 holds the offset ranges."""
    own = replica.select(F.coalesce("archive", F.lit("")).alias("archive"), "offset", "length", "digest")
    counted = own.groupBy("archive", "offset", "length", "digest").agg(F.count("*").alias("n"))
    node = F.expr(f"offset div {RANGE}").alias("node")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "length", "digest", "n"))), lambda x: F.concat_ws(":", x["offset"], x["length"], x["digest"], x["n"]))
    level = counted.groupBy("archive", node).agg(F.sha2(F.array_join(parts, ","), 256).alias("hash"), F.sum("n").alias("n"))
    level = staged(level.select(F.lit(0).alias("level"), "archive", "node", "hash", "n"), "ranges")
    levels = [level]
    for k in range(1, LEVELS + 1):
        above = F.expr(f"node div {FANOUT}") if k < LEVELS else F.lit(0).cast("long")
        children = F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))), lambda x: F.concat_ws(":", x["node"], x["hash"]))
        level = level.groupBy("archive", above.alias("node")).agg(F.sha2(F.array_join(children, ","), 256).alias("hash"), F.sum("n").alias("n"))
        level = level.select(F.lit(k).alias("level"), "archive", "node", "hash", "n")
        levels.append(level)
    return staged(reduce(DataFrame.union, levels), "tree")


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(archive, node) of offset ranges whose hashes differ, reached from the roots of two trees."""
    suspect = None
    for k in range(LEVELS, -1, -1):
        sides = []
        for name, t in (("a", a), ("b", b)):
            nodes = t.where(F.col("level") == k)
            if suspect is not None:  # children of nodes that differ, nothing else
                parent = F.expr(f"node div {FANOUT}") if k < LEVELS - 1 else F.lit(0).cast("long")
                nodes = nodes.withColumn("parent", parent).join(suspect, ["archive", "parent"], "left_semi")
            sides.append(nodes.select("archive", "node", F.col("hash").alias(name)))
        off = sides[0].join(sides[1], ["archive", "node"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        suspect = staged(off.select("archive", F.col("node").alias("parent")), f"suspect{k}")
    return suspect.withColumnRenamed("parent", "node")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records on which two replicas differ: archive, offset, kind, both lengths and digests.

    kind: changed (other record at this offset), missing (not in the replica), extra (only there).
    """
    bad = differing(tree(primary), tree(replica))
    sides = []
    for name, x in (("a", primary), ("b", replica)):
        own = x.select(F.coalesce("archive", F.lit("")).alias("archive"), "offset", "length", "digest", F.expr(f"offset div {RANGE}").alias("node"))
        own = own.join(bad, ["archive", "node"], "left_semi").groupBy("archive", "offset", "length", "digest").agg(F.count("*").alias("n"))
        sides.append(own.select("archive", "offset", "length", "digest", F.col("n").alias(f"n_{name}")))
    both = sides[0].join(sides[1], ["archive", "offset", "length", "digest"], "full_outer")
    a, b = F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))
    off = both.where(a != b)
    at = off.groupBy("archive", "offset").agg(
        F.max(F.when(a > b, F.struct("digest", "length"))).alias("a"), F.max(F.when(a < b, F.struct("digest", "length"))).alias("b"),
        F.sum(F.greatest(a - b, F.lit(0))).alias("lost"), F.sum(F.greatest(b - a, F.lit(0))).alias("new"),
    )
    kind = F.when(F.col("a").isNull(), "extra").when(F.col("b").isNull(), "missing").otherwise("changed")
    return at.select(
        "archive", "offset", kind.alias("kind"), F.greatest("lost", "new").alias("records"), F.col("a.digest").alias("digest"),
        F.col("b.digest").alias("replica_digest"), F.col("a.length").alias("length"), F.col("b.length").alias("replica_length"),
    )


def damaged(replica: DataFrame) -> DataFrame:
    """A replica with damage that follows from the page ids: what an audit is to find.

    Of ids divisible by 97 the record has other bytes, of those divisible by 89 it is lost; where the id
    divides by 83 a second record lies at the offset.
    """
    id_ = F.col("page_id")
    lost = replica.where(~F.coalesce(id_ % 89 == 0, F.lit(False)))
    flipped = F.when(id_ % 97 == 0, F.sha2(F.concat("digest", F.lit("!")), 256)).otherwise(F.col("digest"))
    second = replica.where(id_ % 83 == 0).withColumn("digest", F.sha2(F.concat("digest", F.lit("+")), 256))
    return lost.withColumn("digest", flipped).union(second)


def page_audit(pages: DataFrame) -> DataFrame:
    """The audit of a damaged replica of all pages, with the page that lies at each offset."""
    own = staged(records(pages), "records")
    found = audit(own, damaged(own))
    places = own.groupBy("archive", "offset").agg(F.min("page_id").alias("page_id"))
    out = found.join(places, ["archive", "offset"], "left")
    return out.select("page_id", "archive", "offset", "kind", "records", "length", "replica_length", "digest", "replica_digest")


def page_audit_sql() -> str:
    """The same by comparing every record, without trees; for tables without null or repeated ids."""
    return f"""
with body as (select page_id, coalesce(url, '') url, coalesce(html, '') html from pages),
r as (
  select page_id, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id,
    '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Length: ', octet_length(encode(html)),
    chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10)) rec
  from body
), d as (
  select page_id, cast(page_id // {PER_ARCHIVE} as varchar) archive, sha256(rec) digest, octet_length(encode(rec)) length from r
), o as (
  select *, cast(coalesce(sum(length) over (partition by archive order by page_id rows between unbounded preceding and 1 preceding), 0) as bigint) "offset" from d
), x as (
  select *, case when page_id % 89 = 0 then null when page_id % 97 = 0 then sha256(concat(digest, '!')) else digest end kept,
    case when page_id % 83 = 0 then sha256(concat(digest, '+')) end added
  from o
), y as (
  select *, kept is null or kept <> digest gone, list_filter([case when kept <> digest then kept end, added], lambda z: z is not null) news from x
)
select page_id, archive, "offset",
  case when gone and len(news) > 0 then 'changed' when gone then 'missing' else 'extra' end kind,
  cast(greatest(cast(gone as integer), len(news)) as bigint) records,
  case when gone then length end length, case when len(news) > 0 then length end replica_length,
  case when gone then digest end digest, list_max(news) replica_digest
from y where gone or len(news) > 0
"""
