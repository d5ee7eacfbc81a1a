from __future__ import annotations

import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tablewright.llm import queries, warc


def brute(rows):
    best = {}
    for page_id, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            best[data] = max(best.get(data, page_id), page_id)
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        original = best.get(data, page_id)
        revisit = original != page_id
        out.append(
            (page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
             original if revisit else None)
        )
    return sorted(out, key=str)


def test_query(spark, tables):
    got = queries.op10_warc_revisits(spark, tables).collect()
    pages = spark.read.parquet(f"{tables}/pages.parquet").select("page_id", "html").collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(p) for p in pages])


def test_round_trip_of_odd_pages(spark, folder):
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    long, other = "é" * 700 + trap, "x" * 999
    rows = [
        (1, "http://a/ b\nc%41%zz", long, 0),
        (2, "http://a", long, 0),
        (9, None, long, 0),
        (3, "", other, 0),
        (4, "u", other, 0),
        (5, "u", None, 0),
        (6, "u", "", 0),
        (None, "u", long, 0),
        (7, "u", trap * 3000, 0),
        (2, "http://a", long, 0),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    warc.write_archives(frame, f"{folder}/w", archive_bytes=2000)
    got = warc.resolved_records(spark, f"{folder}/w").collect()
    assert sorted(map(tuple, got), key=str) == brute([(r[0], r[2]) for r in rows])
    read = warc.read_archives(spark, f"{folder}/w").where("record_type = 'response'").collect()
    assert {r.page_id: r.html for r in read} == {9: long, 3: other, 4: other, 5: "", 6: "", 7: trap * 3000}
    assert {r.url for r in read if r.page_id == 9} == {""}


def test_empty(spark, folder):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(frame, f"{folder}/w")
    assert warc.resolved_records(spark, f"{folder}/w").collect() == []


def members_of(content):
    """Each gzip member unpacked by itself, as a reader that seeks from record to record does."""
    while content:
        unpack = zlib.decompressobj(31)
        data = unpack.decompress(content) + unpack.flush()
        assert unpack.eof
        yield data
        content = unpack.unused_data


def test_every_record_is_a_member(spark, folder):
    frame = spark.range(50).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat('ab', cast(id % 7 as int) * 300)").alias("html")
    )
    frame = frame.unionAll(frame.where("page_id = 3")).unionAll(frame.limit(1).withColumn("page_id", F.lit(None).cast("long")))
    warc.write_archives(frame.coalesce(1), f"{folder}/w", archive_bytes=1500)
    contents = [r.content for r in spark.read.format("binaryFile").load(f"{folder}/w").collect()]
    ids, kinds = [], Counter()
    for content in contents:
        found = [list(warc.parse(m)) for m in members_of(content)]
        assert all(len(f) == 1 for f in found) and found[0][0][0][b"warc-type"] == b"warcinfo"
        for (fields, _, _), in found:
            ids.append(fields[b"warc-record-id"])
            kinds[fields[b"warc-type"]] += 1
    assert len(contents) > 3 and len(set(ids)) == len(ids)
    assert kinds[b"response"] + kinds[b"revisit"] == 52 and kinds[b"revisit"] == 31 and kinds[b"warcinfo"] == len(contents)


def test_archives_are_bounded_by_bytes(spark, folder):
    """Large pages among small ones do not gather in one archive."""
    page = F.when(F.col("id") % 50 == 0, F.expr("array_join(transform(sequence(1, 30000), x -> md5(cast(id * 100000 + x as string))), '')")).otherwise(F.repeat(F.lit("a"), 900))
    frame = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), page.alias("html")).coalesce(1)
    warc.write_archives(frame, f"{folder}/w", archive_bytes=600_000)
    sizes = [r.length for r in spark.read.format("binaryFile").load(f"{folder}/w").select("length").collect()]
    assert len(sizes) == 4 and max(sizes) < 700_000
    got = {r.page_id: r.payload_bytes for r in warc.resolved_records(spark, f"{folder}/w").collect()}
    assert got == {i: 960_000 if i % 50 == 0 else 900 for i in range(200)}


def test_a_record_of_over_sixteen_megabytes(spark, folder):
    """The last byte of its length is not zero."""
    huge = spark.range(1).select(F.lit(1).alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("0123456789abcdef"), 1 << 21).alias("html"))
    warc.write_archives(huge, f"{folder}/w")
    assert [(r.payload_bytes, r.record_type) for r in warc.resolved_records(spark, f"{folder}/w").collect()] == [(1 << 25, "response")]
