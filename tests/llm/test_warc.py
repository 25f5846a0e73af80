import hashlib

from pyspark.sql import functions as F

from tallycast.llm import warc
from tallycast.session import scratch_path

PAGES = [(i, f"http://h.example/{i}", f"<p>page {i}\r\n\r\nend</p>") for i in range(600)] + [
    (None, "http://none/", "x"),
    (5, None, None),
    (5, None, None),
    (7, "http://a\r\nX: y", "é" * 10),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(i, u, h, 1, "z") for i, u, h in rows], "page_id bigint, url string, html string, length int, part string")


def written(spark, rows=PAGES):
    records = warc.write_records(pages(spark, rows), scratch_path(spark, "warc-test"))
    return records, warc.manifest(records)


def test_records_and_manifest(spark):
    records, listed = written(spark)
    rows = listed.orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == list(range(len(PAGES)))
    assert [r.page_id for r in rows] == sorted((p for p, _, _ in PAGES), key=lambda p: (p is not None, p))
    assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]
    (archive,) = warc.archives(listed, records).collect()
    data = bytes(archive.warc)
    assert len(data) == sum(r.length for r in rows)
    for r in rows:
        head, _, body = data[r.offset : r.offset + r.length].partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and len(fields) == 6
        assert int(fields[b"Content-Length"]) == len(body) - 4 and body.endswith(b"\r\n\r\n")


def test_audit_finds_what_differs(spark):
    records, listed = written(spark)
    assert warc.audit(listed, records, records).collect() == []
    gone, broken = F.col("page_id") == 100, F.col("page_id") == 333
    other = records.filter(~F.coalesce(gone, F.lit(False)))
    other = other.withColumn("record", F.when(broken, F.concat("record", F.lit(b"!"))).otherwise(F.col("record")))
    strange = records.filter(F.col("page_id") == 9).withColumns({"part": F.lit(10**6), "seq": F.lit(1).cast("bigint")})
    got = warc.audit(listed, records, other.unionByName(strange)).collect()
    at = {r.page_id: r.ordinal for r in listed.collect()}
    assert {(r.ordinal, r.status) for r in got if r.ordinal >= 0} == {(at[100], "missing"), (at[333], "corrupt")}
    assert [r.status for r in got if r.ordinal < 0] == ["extra"]
    whole = {r.page_id: (r.status, r.digest) for r in warc.fixity(listed, records, other).collect()}
    assert whole[100][0] == "missing" and whole[333][0] == "corrupt" and whole[4][0] == "ok"
    (record,) = records.filter("page_id = 4").collect()
    assert whole[4][1] == hashlib.sha256(record.record).hexdigest()


def test_a_node_hashes_its_children_in_order(spark):
    leaf = spark.createDataFrame([(i, f"h{i}") for i in range(40)], "node bigint, hash string")
    levels = [{r.node: r.hash for r in t.collect()} for t in warc.tree(leaf, 2)]
    assert [len(x) for x in levels] == [40, 3, 1]
    want = hashlib.sha256(";".join(f"{i}:h{i}" for i in range(32, 40)).encode()).hexdigest()
    assert levels[1][2] == want


def test_empty_table(spark):
    records, listed = written(spark, [])
    assert warc.fixity(listed, records, records).collect() == []
