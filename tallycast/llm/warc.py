"""WARC records and a Merkle audit of their replicas.

Pages become WARC response records in the order of their ids. A manifest gives
each record its ordinal, byte offset and length in the whole archive. A replica
is a table of records; its tree has a leaf for each record, the hash of offset,
length and content, and above it nodes that hash ordered ranges of ``FANOUT``
children, up to one root. Equal roots end an audit. Otherwise only the children
of nodes that differ are compared, level by level, down to the records that are
damaged, missing or not expected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.session import materialise

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
DATE = "2000-01-01T00:00:00Z"
CRLF = "\r\n"


def record(url: Column, html: Column, key: Column, date: str = DATE) -> Column:
    """A WARC/1.1 response record as bytes; the record id is derived from the key and the address."""
    address = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", "")
    body = F.coalesce(html, F.lit(""))
    digest = F.md5(F.concat_ws(" ", key.cast("string"), address).cast("binary"))
    uuid = F.regexp_replace(digest, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    lines = [
        F.lit("WARC/1.1"),
        F.lit("WARC-Type: response"),
        F.concat(F.lit("WARC-Target-URI: "), address),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), body, F.lit(CRLF * 2)).cast("binary")


def write_records(pages: DataFrame, path: str) -> DataFrame:
    """Write the records of ``page_id``, ``url`` and ``html`` in order, and return them.

    Columns ``part``, ``seq`` (place of the record), ``page_id``, ``length`` and
    ``record``. Null ids come first; rows that share an id are records each, in
    an order that their content fixes; null addresses and pages are empty. An
    empty table gives no records. Other columns play no part.
    """
    key = F.col("page_id").cast("bigint")
    rows = pages.select(key.alias("page_id"), F.xxhash64("url", "html").alias("_tie"), record(F.col("url"), F.col("html"), key).alias("record"))
    ordered = rows.repartitionByRange("page_id", "_tie").sortWithinPartitions("page_id", "_tie")
    placed = ordered.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("seq"),
        "page_id",
        F.octet_length("record").cast("bigint").alias("length"),
        "record",
    )
    placed.write.option("compression", "zstd").parquet(path)
    return pages.sparkSession.read.schema(placed.schema).parquet(path)


def manifest(records: DataFrame) -> DataFrame:
    """``part``, ``seq``, ``page_id``, ``ordinal``, ``offset``, ``length`` of every record."""
    # One row for each task that wrote, so one task can add them up.
    sizes = records.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
    before = Window.orderBy("part")
    starts = sizes.select("part", (F.sum("n").over(before) - F.col("n")).alias("_n"), (F.sum("bytes").over(before) - F.col("bytes")).alias("_bytes"))
    own = Window.partitionBy("part").orderBy("seq")
    local = records.select("part", "seq", "page_id", "length").withColumns(
        {"_k": F.row_number().over(own) - 1, "_at": F.sum("length").over(own) - F.col("length")}
    )
    joined = local.join(F.broadcast(starts), "part")
    columns = [(F.col("_n") + F.col("_k")).alias("ordinal"), (F.col("_bytes") + F.col("_at")).alias("offset")]
    return materialise(joined.select("part", "seq", "page_id", *columns, "length"))


def leaves(listed: DataFrame, replica: DataFrame) -> DataFrame:
    """``node`` (ordinal), ``hash`` and ``digest`` of the records a replica holds.

    Only digests move. Records that the manifest doesn't list get negative
    nodes, and of records with one place the smallest digest counts.
    """
    digests = replica.select("part", "seq", F.sha2("record", 256).alias("digest"), F.octet_length("record").alias("_size"))
    digests = digests.groupBy("part", "seq").agg(F.min(F.struct("digest", "_size")).alias("d")).select("part", "seq", "d.*")
    joined = digests.join(listed.select("part", "seq", "ordinal", "offset"), ["part", "seq"], "left")
    node = F.coalesce("ordinal", -1 - F.pmod(F.xxhash64("part", "seq"), F.lit(1 << 40)))
    content = F.concat_ws(":", F.coalesce("offset", F.lit(-1)), "_size", "digest")
    return materialise(joined.select(node.alias("node"), F.sha2(content.cast("binary"), 256).alias("hash"), "digest"))


def tree(leaf: DataFrame, levels: int) -> list[DataFrame]:
    """``node`` and ``hash`` of all levels, leaves first; the last level is the root."""
    out = [leaf.select("node", "hash")]
    for _ in range(levels):
        above = out[-1].groupBy(F.call_function("shiftright", F.col("node"), F.lit(FANOUT_BITS)).alias("up"))
        # At most FANOUT children, in the order of their offsets.
        children = F.transform(F.sort_array(F.collect_list(F.struct("node", "hash"))), lambda c: F.concat_ws(":", c["node"], c["hash"]))
        parents = above.agg(F.sha2(F.concat_ws(";", children).cast("binary"), 256).alias("hash"))
        out.append(materialise(parents.withColumnRenamed("up", "node")))
    return out


def _different(a: DataFrame, b: DataFrame) -> DataFrame:
    other = b.select("node", F.col("hash").alias("other"))
    return a.join(other, "node", "full_outer").filter(~F.col("hash").eqNullSafe(F.col("other")))


def audit(listed: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Records in which two replicas differ: ``ordinal``, ``status``, ``digest`` and ``other_digest``.

    ``status``: ``corrupt`` (both hold it, with different bytes), ``missing``
    (only the first does) or ``extra`` (only the second does).
    """
    own, other = leaves(listed, first), leaves(listed, second)
    most = own.unionByName(other).agg(F.max("node").alias("most")).first()["most"] or 0
    levels = 1
    while most >> (FANOUT_BITS * levels):
        levels += 1
    trees = tree(own, levels), tree(other, levels)
    suspects = materialise(_different(trees[0][-1], trees[1][-1]).select("node"))
    for level in range(levels - 1, -1, -1):
        if suspects.isEmpty():
            break
        up = F.call_function("shiftright", F.col("node"), F.lit(FANOUT_BITS))
        below = [t[level].withColumn("_up", up).join(suspects.withColumnRenamed("node", "_up"), "_up", "left_semi").drop("_up") for t in trees]
        suspects = materialise(_different(*below).select("node"))
    left = own.select("node", "digest").join(suspects, "node")
    right = other.select("node", F.col("digest").alias("other_digest")).join(suspects, "node")
    both = left.join(right, "node", "full_outer")
    status = F.when(F.col("digest").isNull(), "extra").when(F.col("other_digest").isNull(), "missing").otherwise("corrupt")
    return both.select(F.col("node").alias("ordinal"), status.alias("status"), "digest", "other_digest")


def archives(listed: DataFrame, records: DataFrame, size: int = 1 << 28) -> DataFrame:
    """``archive`` and ``warc``: the bytes of archives of about ``size`` bytes, one row each."""
    joined = records.join(listed.select("part", "seq", "offset"), ["part", "seq"])
    group = joined.groupBy(F.floor(F.col("offset") / size).alias("archive"))
    ordered = F.sort_array(F.collect_list(F.struct("offset", "record")))
    return group.agg(F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x["record"])).alias("warc"))


def fixity(listed: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """The whole manifest with ``digest`` and ``status`` (``ok`` where the replicas agree)."""
    found = audit(listed, first, second).select("ordinal", "status")
    digests = first.select("part", "seq", F.sha2("record", 256).alias("digest"))
    every = listed.join(digests, ["part", "seq"], "left").join(found, "ordinal", "left")
    return every.select("page_id", "ordinal", "offset", "length", "digest", F.coalesce("status", F.lit("ok")).alias("status"))
