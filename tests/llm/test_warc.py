import hashlib

from pyspark.sql import functions as F

from parlato.llm.warc import deduplicate, read_archives, records, write_archives
from parlato.session import scratch_path

SCHEMA = "key long, url string, payload binary, digest string"


def run(spark, rows):
    df = spark.createDataFrame([(k, u, p, "extra") for k, u, p in rows], SCHEMA)
    return {r["key"]: tuple(r)[1:] for r in deduplicate(df, scratch_path(spark, "warc-test")).collect()}


def test_revisits_and_edges(spark):
    large, torn = b"x" * 1000, b"a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + b"\xff" * 1200
    rows = [
        (1, "http://a/\r\nX: y", large),
        (2, None, None),
        (3, "http://c", torn),
        (4, "http://d", large),
        (5, "http://é", b"\r\n\r\n"),
        (6, "http://f", torn),
        (7, "http://g", b"x" * 999),
        (8, "http://h", b"x" * 999),
    ]
    found = run(spark, rows)
    assert set(found) == {str(k) for k, *_ in rows}
    for key, _, payload in rows:
        payload = payload or b""
        revisits = {1: "4", 3: "6"}.get(key)
        kind = "revisit" if revisits else "response"
        assert found[str(key)] == (len(payload), hashlib.sha1(payload).hexdigest(), kind, revisits)


def test_no_rows(spark):
    assert run(spark, []) == {}


def test_hot_payload(spark):
    found = run(spark, [(k, "u", b"y" * 2000) for k in range(300)])
    assert sum(v[2] == "response" for v in found.values()) == 1
    assert {v[3] for v in found.values()} == {None, "299"}


def test_foreign_archive(spark, tmp_path):
    text = (
        "WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
        "WARC/1.0\r\nwarc-type: response\r\nWARC-Target-URI:http://z\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    )
    (tmp_path / "a.warc").write_bytes(text.encode())
    rows = {r["record_type"]: (r["uri"], bytes(r["block"])) for r in read_archives(spark, str(tmp_path)).collect()}
    assert rows == {"warcinfo": (None, b"hello"), "response": ("http://z", b"abc")}


def test_uncompressed(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\nz"
    write_archives(spark.createDataFrame([(record,), (record,)], "record string"), f"{tmp_path}/out", "none")
    assert [bytes(r["block"]) for r in read_archives(spark, f"{tmp_path}/out").collect()] == [b"z", b"z"]


def test_captures_without_a_key_are_spread(spark):
    rows = [(None, f"http://{k}", b"z" * 1200) for k in range(200)] + [(1, "http://k", b"z" * 1200)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)
    revisits = spark.createDataFrame([(7, 8, "http://x")], "key long, refers_to long, refers_to_uri string").hint("merge")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = records(df.drop("digest"), revisits, "2024-01-01").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 100
    found = deduplicate(df, scratch_path(spark, "warc-test")).collect()
    assert len(found) == 201 and all(r["record_type"] == "response" for r in found)


def test_urls_make_no_headers(spark):
    page = b"p" * 500
    ends = ["\u2028", "\u2029", "\u0085", "\r", "\n", "\r\n", "\x0b", "\x0c", "\x00"]
    rows = [(k, f"http://a/{end}Content-Length: 3{end}X-Capture-Key: 99", page) for k, end in enumerate(ends)]
    found = run(spark, rows)
    assert found == {str(k): (500, hashlib.sha1(page).hexdigest(), "response", None) for k in range(len(ends))}


def test_line_characters_in_foreign_headers(spark, tmp_path):
    text = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://z\u2028Content-Length: 1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(text.encode())
    (row,) = read_archives(spark, str(tmp_path)).collect()
    assert bytes(row["block"]) == b"abc" and row["uri"] == "http://z\u2028Content-Length: 1"
