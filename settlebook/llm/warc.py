"""WARC archives with revisit records (operator 4).

Payloads are digested where they are read. Only headers (page id, digest,
length) are shuffled by digest: a digest that several records of at least
``least`` bytes share has one original, that with the largest page id, and the
records that repeat it are joined to it. Pages then meet their revisit, if any,
by page id, and fresh records are written as text files in the WARC 1.0 format
(one gzip stream a file). Every record opens with its version line and the id of
this run, which cannot occur in a payload, so Spark's text reader can cut the
archives at records wherever its splits fall, in bounded memory.

A digest can be as common as it likes: headers are counted with partial
aggregates, and both sides of the join to the originals are plain shuffles, so
that adaptive execution splits a hot one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.llm.scratch import Scratch

CRLF = "\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _opening(run: str) -> str:
    return f"WARC/1.0{CRLF}WARC-Warcinfo-ID: <urn:uuid:{run}>{CRLF}"


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line; no line if the value is null. Line ends in a value are percent-coded."""
    value = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def resolve(headers: DataFrame, scratch: Scratch, least: int = 1000) -> DataFrame:
    """``page_id, digest, refers_to`` of the records that revisit another.

    ``headers``: page_id, digest, bytes. Rows that repeat the largest page id of
    their digest are responses too; null page ids revisit a record with an id,
    if there is one.
    """
    large = headers.where(F.col("bytes") >= least)
    originals = scratch.save(large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                             .where("n > 1 AND refers_to IS NOT NULL").drop("n"), "originals")
    revisits = large.join(originals, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return scratch.save(revisits.select("page_id", "digest", "refers_to"), "revisits").distinct()


def write(pages: DataFrame, scratch: Scratch, key: str = "page_id", url: str = "url", html: str = "html",
          least: int = 1000, date: str = "1970-01-01T00:00:00Z", name: str = "archive") -> tuple[str, str]:
    """Writes one record per row and returns the archive's folder and run id.

    Payload: ``html`` in UTF-8, nothing for null. A null ``url`` gives no target
    line, a null ``key`` no page line; columns that are not named are not read.
    No rows give an archive without records.
    """
    run = str(uuid.uuid4())
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    headers = scratch.save(rows.select("page_id", "digest", "bytes"), "headers")
    revisits = resolve(headers, scratch, least).select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to")
    r = rows.join(revisits, (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_id")), "left")
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(_opening(run)),
        _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("WARC-Profile", F.when(again, F.lit(IDENTICAL))),
        _field("WARC-Refers-To", F.when(again, _record_id(F.col("refers_to"), F.col("digest")))),
        _field("X-Page-ID", F.col("page_id").cast("string")),
        _field("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit(CRLF), http, body)
    path = scratch.path(name)
    r.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)
    # the record that the others name, in a file of its own
    about = f"software: settlebook{CRLF}format: WARC File Format 1.0{CRLF}"
    info = (f"WARC/1.0{CRLF}WARC-Type: warcinfo{CRLF}WARC-Record-ID: <urn:uuid:{run}>{CRLF}WARC-Date: {date}{CRLF}"
            f"Content-Type: application/warc-fields{CRLF}Content-Length: {len(about)}{CRLF}{CRLF}{about}")
    pages.sparkSession.range(1).select(F.lit(info).alias("value")).write.mode("append").option("lineSep", CRLF + CRLF).option(
        "compression", "gzip").text(path)
    return path, run


def runs(scratch: Scratch, path: str) -> list[str]:
    """Run ids of the archives in a folder, from their warcinfo records."""
    raw = scratch.spark.read.option("lineSep", f"WARC/1.0{CRLF}WARC-Type: warcinfo{CRLF}").schema("value string").text(path)
    found = raw.select(F.regexp_extract("value", r"\AWARC-Record-ID: <urn:uuid:([0-9a-f-]{36})>", 1).alias("run")).where("run <> ''")
    return sorted(r["run"] for r in found.distinct().collect())


def read(scratch: Scratch, path: str, run: str, key_type: str = "long") -> DataFrame:
    """The records of an archive that ``write`` made: page_id, record_type,
    target_uri, payload (binary, null for revisits), payload_bytes,
    payload_digest (of the payload as read; for revisits, as stated),
    stated_digest, refers_to.
    """
    raw = scratch.spark.read.option("lineSep", _opening(run)).schema("value string").text(path).where(
        (F.col("value") != "") & ~F.startswith("value", F.lit("WARC/1.0")))  # not the warcinfo record
    split = F.instr("value", CRLF + CRLF)
    head = F.concat(F.lit(CRLF), F.substring(F.col("value"), F.lit(1), split + 1))

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract(F.col("head"), rf"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))

    r = raw.select(head.alias("head"), F.col("value").cast("binary").alias("record"))
    r = r.withColumn("block", F.substring(F.col("record"), F.octet_length("head") + 1, field("Content-Length").cast("int")))
    text = F.decode("block", "ISO-8859-1")  # a character per byte
    r = r.withColumn("http", F.substring_index(text, CRLF + CRLF, 1))
    response = field("WARC-Type") == "response"
    payload = F.when(response, F.substring(F.col("block"), F.length("http") + 5, F.octet_length("block")))
    r = r.withColumn("payload", payload).withColumn("stated_digest", F.substring_index(field("WARC-Payload-Digest"), ":", -1))
    stated = F.regexp_extract("http", r"\r\nContent-Length: ([0-9]+)", 1).cast("long")
    return r.select(
        field("X-Page-ID").cast(key_type).alias("page_id"), field("WARC-Type").alias("record_type"),
        field("WARC-Target-URI").alias("target_uri"), "payload",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(stated).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("stated_digest")).alias("payload_digest"), "stated_digest",
        field("X-Refers-To-Page-ID").cast(key_type).alias("refers_to"))
