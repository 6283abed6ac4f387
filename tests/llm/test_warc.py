import base64
import hashlib

from pyspark.sql import functions as F

from chunkwise.config import work_dir
from chunkwise.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def expected(rows):
    leader = {}
    for page, _, html, _ in rows:
        if page is not None:
            h = html or ""
            leader[h] = min(page, leader.get(h, page))
    out = []
    for page, _, html, _ in rows:
        h = html or ""
        lead = leader.get(h)
        revisit = lead is not None and lead != page
        data = h.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", lead if revisit else None, True))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a.org/x", "<html>ü</html>", "d"),
    (3, "http://b.org/y z\n", "<html>ü</html>", "d"),
    (9, None, None, "d"),
    (2, "http://c.org", "", "d"),
    (7, "http://d.org", "line\r\n\r\nWARC/1.1\r\n\r\n" * 50, "d"),
    (8, "http://e.org", "😀" * 1000, "d"),
    (10, "http://e.org", "😀" * 1000, "d"),
    (None, "http://f.org", "<html>ü</html>", "d"),
    (None, "http://g.org", "only here", "d"),
    (3, "http://b.org/y", "<html>ü</html>", "d"),
]


def read(spark, rows, **options):
    path = work_dir(spark, "warc_test")
    warc.write_archive(spark.createDataFrame(rows, SCHEMA), path, **options)
    got = warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")
    return path, sorted(map(tuple, got.collect()), key=str)


def test_round_trip(spark):
    assert read(spark, ROWS)[1] == expected(ROWS)


def test_round_trip_in_small_chunks(spark):
    path, got = read(spark, ROWS, chunk_bytes=64)
    assert got == expected(ROWS)
    chunks = spark.read.parquet(path)
    assert chunks.agg(F.max("chunk_no")).first()[0] > 50
    assert chunks.agg(F.max(F.length("data"))).first()[0] < 1000


def test_rows_of_a_record_join_to_warc_bytes(spark):
    path, _ = read(spark, ROWS[:1], chunk_bytes=4)
    data = b"".join(bytes(r["data"]) for r in spark.read.parquet(path).orderBy("chunk_no").collect())
    head, _, block = data.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and data.endswith(b"</html>\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
    assert block[size:] == b"\r\n\r\n"


def test_damage_is_seen(spark):
    path, _ = read(spark, ROWS, chunk_bytes=64)
    chunks = spark.read.parquet(path)
    bad = work_dir(spark, "warc_bad")
    hurt = F.when((F.col("chunk_no") == 9), F.encode(F.lit("x" * 64), "utf-8")).otherwise(F.col("data"))
    chunks.withColumn("data", hurt).write.parquet(bad)
    assert warc.read_archive(spark, bad).where("NOT intact").count() > 0


def test_small_payloads_and_empty_tables(spark):
    _, got = read(spark, ROWS, min_revisit_bytes=100)
    assert {r[0] for r in got if r[3] == "revisit"} == {10}
    assert read(spark, [])[1] == []
