"""WARC archives: write, read, and replace repeated payloads by revisit records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.llm.common import stage, table
from parlato.session import scratch_path

# The file format.
CRLF = "\r\n"
VERSION = "WARC/1.1"
END = CRLF + CRLF
SPLIT = END + "WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Control characters, and those that some readers take for the end of a line.
CONTROL = r"[\x00-\x1f\x7f-\x9f\u2028\u2029]"

MIN_BYTES = 1000


def _urn(kind: str, key: Column, digest: Column) -> Column:
    """A record id that depends on kind, key and payload only, so a task that runs again writes the same one."""
    h = F.md5(F.concat_ws("|", F.lit(kind), key.cast("string"), digest))
    part = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def _uri(url: Column) -> Column:
    """A header value holds no control or line character: each is percent-encoded, as its bytes in UTF-8."""
    text = F.coalesce(url, F.lit(""))
    one = lambda c: F.when(
        c.rlike(CONTROL), F.concat(F.lit("%"), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)(?=.)", "$1%"))
    ).otherwise(c)
    encoded = F.array_join(F.transform(F.split(text, ""), one), "")
    return F.when(text.rlike(CONTROL), encoded).otherwise(text)


def capture_headers(captures: DataFrame) -> DataFrame:
    """Header fields of captures ``key, url, payload`` (binary): length, digest and record id, without the payload."""
    digest = F.sha1("payload")
    return captures.select(
        "key",
        _uri(F.col("url")).alias("url"),
        F.octet_length("payload").cast("long").alias("bytes"),
        digest.alias("digest"),
    )


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Which captures revisit another: ``key, refers_to, refers_to_uri``, one row per revisit.

    Only headers are shuffled, by payload digest. The largest key of a digest is
    picked with partial aggregation, so a payload that a third of all captures
    share sends one row per task; the picks are stored, which leaves the join
    with the headers as a plain one that Spark can split where a digest is hot.
    """
    large = headers.where(F.col("bytes") >= min_bytes)
    picks = (
        large.groupBy("digest")
        .agg(F.max_by(F.struct("key", "url"), "key").alias("pick"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("pick.key").alias("refers_to"), F.col("pick.url").alias("refers_to_uri"))
    )
    picks = stage(picks, "warc-picks")
    return (
        large.select("digest", "key").join(picks, "digest").where("key <> refers_to").drop("digest")
    )


def records(captures: DataFrame, revisits: DataFrame, date: str) -> DataFrame:
    """One column ``record``: each capture as a WARC record with a fresh header; revisits have no block."""
    # captures without a key meet no revisit and need not move to one partition for it
    keyless = captures.where("key is null").select("*", *[F.lit(None).cast("string").alias(c) for c in ("refers_to", "refers_to_uri")])
    met = captures.where("key is not null").join(revisits, "key", "left")
    rows = met.unionByName(keyless.select(*[F.col(c).cast(t).alias(c) for c, t in met.dtypes])).withColumn("digest", F.sha1("payload"))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", _urn("record", F.col("key"), F.col("digest"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", _uri(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.upper(F.col("digest")))),
        ("WARC-Refers-To", F.when(revisit, _urn("record", F.col("refers_to"), F.col("digest")))),
        ("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_to_uri"))),
        ("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("X-Capture-Key", F.col("key").cast("string")),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    # concat_ws leaves out the fields that are null
    lines = F.concat_ws(CRLF, F.lit(VERSION), *[F.concat(F.lit(f"{name}: "), value) for name, value in fields])
    head = F.encode(F.concat(lines, F.lit(END)), "UTF-8")
    return rows.select(F.concat(head, block).cast("string").alias("record"))


def write_archives(record_rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as archives, one file for each task, through Spark's own committer.

    The text writer puts down bytes as they are, and its line separator is the
    two line breaks that end a record.
    """
    record_rows.write.option("lineSep", END).option("compression", compression).mode("overwrite").text(path)


def _field(name: str) -> Column:
    value = F.regexp_extract("head", rf"(?imd)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1)
    return F.when(value != "", value)


def _parsed(raw: DataFrame) -> DataFrame:
    """``raw`` holds ``file, piece`` (binary from the version digit on); gives header fields and the block."""
    rows = raw.withColumn("head", F.substring_index(F.col("piece").cast("string"), END, 1))
    rows = rows.withColumn("length", _field("Content-Length").cast("long"))
    body = F.expr("substring(piece, octet_length(head) + 5, int(length))")
    return rows.select(
        "file",
        F.lower(_field("WARC-Type")).alias("record_type"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Target-URI").alias("uri"),
        F.lower(F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "")).alias("digest"),
        _field("WARC-Refers-To").alias("refers_to_id"),
        _field("X-Capture-Key").alias("key"),
        "length",
        body.alias("block"),
    )


def _pieces_by_offset(frames):
    """Records of whole archives, cut by their stated lengths alone. Gives ``file, piece``."""
    import gzip

    import pyarrow as pa

    for batch in frames:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            data = content.as_py()
            data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
            at = 0
            while (cut := data.find(b"\r\n\r\n", at)) >= 0:
                head = data[at:cut]
                length = next((int(x.split(b":", 1)[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
                end = cut + 4 + length
                yield pa.RecordBatch.from_pydict(
                    {"file": [path.as_py()], "piece": [data[at + len(b"WARC/1.") : end]]},
                    schema=pa.schema([("file", pa.string()), ("piece", pa.binary())]),
                )
                at = end + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: type, ids, uri, digest, key, length and block (binary).

    Archives are streamed and cut where a record's end meets the next one's
    version line. A payload that holds these bytes tears its record, which shows
    as a block shorter than its stated length; archives with such a record are
    cut by lengths instead, each by one task.
    """
    raw = (
        spark.read.option("lineSep", SPLIT)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    )
    # the first piece of a file still has its version line
    opening = F.expr(f"startswith(piece, cast('{VERSION[:7]}' as binary))")
    raw = raw.withColumn("piece", F.when(opening, F.expr(f"substring(piece, {len(VERSION[:7]) + 1})")).otherwise(F.col("piece")))
    found = _parsed(raw)
    torn = F.coalesce(F.octet_length("block") < F.col("length"), F.lit(True))
    files = [row["file"] for row in found.where(torn).select("file").distinct().collect()]
    if not files:
        return found
    whole = spark.read.format("binaryFile").load(files).select("path", "content")
    again = _parsed(whole.mapInArrow(_pieces_by_offset, "file string, piece binary"))
    return found.where(~F.col("file").isin(files)).unionByName(again)


def resolved(found: DataFrame) -> DataFrame:
    """Per record: ``key, payload_bytes, payload_digest, record_type, refers_to``; revisits take both payload
    figures from the response they refer to. Blocks are not shuffled."""
    responses = found.where("record_type = 'response'").select(
        "key", F.octet_length("block").cast("long").alias("bytes"), F.sha1("block").alias("sha"), "record_id"
    )
    own = responses.select("key", "bytes", "sha", F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to"))
    revisits = found.where("record_type = 'revisit'").select(F.col("key").alias("revisit"), F.col("refers_to_id").alias("record_id"))
    met = revisits.join(responses, "record_id").select(
        F.col("revisit").alias("key"), "bytes", "sha", F.lit("revisit").alias("record_type"), F.col("key").alias("refers_to")
    )
    return own.unionByName(met).withColumnsRenamed({"bytes": "payload_bytes", "sha": "payload_digest"})


def deduplicate(
    captures: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """Write captures ``key, url, payload`` to archives at ``path`` and return what is read back from them.

    Captures of equal payloads of at least ``min_bytes`` bytes are one response,
    that of the largest key, and revisits of it. A null payload is empty, a null
    url an empty one. ``key`` should be unique: rows that share a key are each
    written, none refers to another of its own key, and a revisit of such a key
    comes back once for each of its responses. Rows without a key are responses.
    Other columns are ignored; an empty table gives no rows.
    """
    captures = captures.select("key", "url", F.coalesce("payload", F.lit(b"")).alias("payload"))
    revisits = resolve_revisits(capture_headers(captures), min_bytes).distinct()
    write_archives(records(captures, revisits, date), path)
    return resolved(read_archives(captures.sparkSession, path))


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = pages.select(F.col("page_id").alias("key"), "url", F.encode("html", "UTF-8").alias("payload"))
    return deduplicate(captures, scratch_path(spark, "warc")).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS sha FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS top FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, sha AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""
