import base64
import hashlib

from pyspark.sql import functions as F

from civiclens.llm.common import Scratch
from civiclens.llm.warc import read_archive, record_bytes, write_archive


def digest(body):
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def archived(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest int")
    folder = f"{Scratch(spark, 'warc-test').root}/a"
    write_archive(pages, folder, **options)
    return folder, read_archive(spark, folder)


ROWS = [
    (1, "http://a/1", "<p>é</p>", "x", 1),
    (2, "http://a/2\r\nEvil: yes", "<p>é</p>", "x", 1),
    (5, None, "<p>é</p>", None, None),
    (5, None, "<p>é</p>", None, None),
    (3, "http://a/3", None, "x", 1),
    (4, "http://a/4", "", "x", 1),
    (None, "http://a/n", "<p>é</p>", "x", 1),
    (None, "http://a/m", "alone", "x", 1),
    (7, "http://a/7", "long" * 100_000, "x", 1),
]


def test_records_come_back_whole(spark):
    folder, records = archived(spark, ROWS)
    rows = records.withColumn("record", record_bytes()).collect()
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    e, n = "<p>é</p>".encode(), lambda b: (len(b), digest(b))
    assert got == sorted(
        [
            (1, *n(e), "revisit", 5),
            (2, *n(e), "revisit", 5),
            (5, *n(e), "response", None),
            (5, *n(e), "response", None),
            (3, *n(b""), "revisit", 4),
            (4, *n(b""), "response", None),
            (0, *n(e), "revisit", 5),
            (0, *n(b"alone"), "response", None),
            (7, *n(b"long" * 100_000), "response", None),
        ],
        key=str,
    )
    for r in rows:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        lines = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and b"Evil" not in lines
        assert int(lines[b"Content-Length"]) + 4 == len(block) and block.endswith(b"\r\n\r\n")
        assert r.record_type == "revisit" and block == b"\r\n\r\n" or bytes(r.payload) == block[:-4]
    assert spark.read.parquet(f"{folder}/payloads").count() == 4


def test_short_payloads_are_all_responses(spark):
    _, records = archived(spark, ROWS, min_bytes=5)
    kinds = {(r.page_id, r.record_type) for r in records.collect() if r.payload_bytes < 5}
    assert kinds == {(3, "response"), (4, "response")}


def test_damage_is_found(spark):
    folder, _ = archived(spark, ROWS)
    bad = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!")))
    bad.write.parquet(f"{folder}-bad/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}-bad/headers")
    try:
        read_archive(spark, f"{folder}-bad").collect()
    except Exception as error:
        assert "does not have its digest" in str(error)
    else:
        raise AssertionError("a damaged payload was read")


def test_no_pages(spark):
    assert archived(spark, [])[1].collect() == []
