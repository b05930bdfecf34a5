"""Merkle fixity audit of web archive records.

A record's digest is a leaf.  Records lie in files of a fixed number of records
with ordered offset ranges; every ``FANOUT`` neighbouring nodes have a parent
whose digest is taken over theirs, up to one root.  Two replicas are compared
at the root, and only the children of nodes that differ are looked at further,
down to the records and their byte ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occurra.llm.common import cut, pick
from occurra.llm.ordering import numbered, ordered

FANOUT = 16
FILE_RECORDS = 1000


def record_bytes(url: Column, html: Column) -> Column:
    """A response record: header lines, the page, and an empty line."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def index(records: DataFrame) -> DataFrame:
    """Places records: (record, file, start, length, digest and all other columns but ``pid``).

    ``records`` has ``page_id``, ``digest`` and ``length``; the order is by id
    (null first), then digest.  Files hold ``FILE_RECORDS`` records, so the
    window that sums their offsets is bounded whatever ids repeat.
    """
    kept = ordered(records, ["page_id", "digest"])
    rows, _, _ = numbered(kept)
    rows = rows.withColumnRenamed("rn", "record").withColumn("file", F.floor(F.col("record") / FILE_RECORDS))
    before = Window.partitionBy("file").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("pid")


def tree(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of (node, digest) from the leaves up to one root, each kept in the shared folder."""
    levels = [leaves.select("node", "digest")]
    top = leaves.agg(F.max("node")).first()[0]
    while top:
        below = levels[-1].withColumn("parent", F.floor(F.col("node") / fanout))
        level = below.groupBy("parent").agg(F.sort_array(F.collect_list(F.struct("node", "digest"))).alias("c"))
        joined = F.concat_ws("", F.transform("c", lambda x: F.concat(x["node"].cast("string"), F.lit(":"), x["digest"])))
        level = level.select(F.col("parent").alias("node"), F.sha2(joined, 256).alias("digest"))
        levels.append(cut(level))  # a sixteenth of the one below; the plan doesn't grow with the levels
        top //= fanout
    return levels


def audit(first: DataFrame, second: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Leaves (node, digest, other_digest) in which two replicas differ.

    Each replica is (node, digest), a leaf per record place, the digest of a
    missing record null.  Branches with equal digests aren't entered.

    Defined cases: a place only one replica has differs, with null for the
    other; both empty gives no rows; equal replicas stop at the root.
    """
    left = cut(first.select("node", F.coalesce("digest", F.lit("-")).alias("digest")))
    right = cut(second.select("node", F.coalesce("digest", F.lit("-")).alias("digest")))
    a, b = tree(left, fanout), tree(right, fanout)
    while len(a) < len(b):
        a.append(a[-1].limit(0))
    while len(b) < len(a):
        b.append(b[-1].limit(0))
    bad = None
    for up, down in zip(reversed(a), reversed(b)):
        if bad is not None:
            inside = F.floor(F.col("node") / fanout).alias("parent")
            parents = bad.select(F.col("node").alias("parent"))
            up = up.withColumn("parent", inside).join(parents, "parent", "left_semi").drop("parent")
            down = down.withColumn("parent", inside).join(parents, "parent", "left_semi").drop("parent")
        pair = up.join(down.withColumnRenamed("digest", "other_digest"), "node", "full_outer")
        bad = cut(pair.where(~F.col("digest").eqNullSafe(F.col("other_digest"))))  # only what differs
    none = lambda c: F.when(F.col(c) != "-", F.col(c)).alias(c)
    return bad.select("node", none("digest"), none("other_digest"))


def fixity(replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Where a replica of an archive of pages is damaged.

    ``replica`` is (page_id, url, html, copy); ``copy`` is the record that the
    replica holds in the place of the page's record (null: none).  Returns
    (page_id, file, start, length, digest, replica_digest, damage), a row per
    damaged record.

    Defined cases: null urls and pages make records with empty fields; a null
    id sorts first; repeated rows are records each; an empty table gives no
    rows; extra columns are left out.
    """
    rows = pick(replica, page_id="page_id", url="url", html="html", copy="copy")
    record = record_bytes(F.col("url"), F.col("html"))
    hashed = rows.select(
        F.col("page_id").cast("long"), F.sha2(record, 256).alias("digest"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2("copy", 256).alias("copy_digest"), F.octet_length("copy").cast("long").alias("copy_length"),
    )
    placed = cut(index(hashed))
    found = audit(
        placed.select(F.col("record").alias("node"), "digest"),
        placed.select(F.col("record").alias("node"), F.col("copy_digest").alias("digest")),
        fanout,
    )
    damage = (
        F.when(F.col("other_digest").isNull(), "missing")
        .when(F.col("copy_length") != F.col("length"), "resized").otherwise("altered")
    )
    at = placed.select(F.col("record").alias("node"), "page_id", "file", "start", "length", "copy_length")
    return found.join(at, "node").select(
        "page_id", "file", "start", "length", "digest", F.col("other_digest").alias("replica_digest"),
        damage.alias("damage"),
    )
