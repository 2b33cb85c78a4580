"""Web archives: writing one record set per page, and assembling captures again.

``write_archive`` stores a page as three records of the WARC 1.1 format: the
request, the response (or, for a payload that another page's response holds,
a revisit) and a metadata record. Request and metadata name the response in
WARC-Concurrent-To. Spark's text writer ends each record with the two line
ends that the format asks for, and compresses the files, one for each task.

``read_records`` cuts archives at the version line as they stream by, many
files in parallel and those without compression by split.
A payload that holds the version line itself is written in chunked transfer
coding with a chunk border inside that line, so the cut is safe; a record
that is shorter than its Content-Length raises an error.

``captures`` joins response or revisit, request and metadata through the
concurrent-to identifiers and gives one nested row per capture. Only the
response side carries payloads; of the others one row per identifier is kept,
so repeated rows don't multiply. A revisit finds its response through
WARC-Refers-To.

Defined results: a null html is an empty payload; a null url is an empty
target; line ends in a url are percent-encoded; a null page id stays null and
counts as smaller than any other; pages equal in id and payload are one
capture each, all of them responses if their id is the largest; an empty
table gives an empty archive and no captures; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import salted_join
from strata.sources.checkpoint import materialize

CRLF = "\r\n"
VERSION = "WARC/1.1" + CRLF
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(*parts: Column) -> Column:
    """A name-based record identifier."""
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def record(kind: str, rid: Column, block: Column, content_type: str, date: str, **headers: Column) -> Column:
    """The text of a record without the two line ends behind it; a null header is left out."""
    lines = {"WARC-Type": F.lit(kind), "WARC-Record-ID": rid, "WARC-Date": F.lit(date),
             **{"WARC-" + k.replace("_", "-"): v for k, v in headers.items()},
             "Content-Type": F.lit(content_type), "Content-Length": F.octet_length(block).cast("string")}
    return F.concat(F.lit(VERSION), *[F.coalesce(F.concat(F.lit(k + ": "), v, F.lit(CRLF)), F.lit("")) for k, v in lines.items()],
                    F.lit(CRLF), block)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  revisit_bytes: int = REVISIT_BYTES, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write the records of all pages below ``path``, which executors must share."""
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), "\r", "%0D"), "\n", "%0A")
    base = pages.select(F.col(id_col).alias("id"), url.alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    base = base.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload").cast("long"))
    # the payloads that stand more than once: one row each, summed up before the shuffle
    held = (base.where(F.col("n") >= revisit_bytes).groupBy("digest").agg(
        F.max("id").alias("held_by"), F.max_by("url", "id").alias("held_url"), F.count(F.lit(1)).alias("times"))
        .where((F.col("times") > 1) & F.col("held_by").isNotNull()).drop("times"))
    full = F.col("n") >= revisit_bytes
    joined = salted_join(base.withColumn("_k", F.when(full, F.col("digest"))), held.withColumnRenamed("digest", "_k"), ["_k"], F.concat_ws(":", "id", "url"))
    revisit = F.col("held_by").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("held_by")))
    rid = record_id(F.lit("response"), F.col("id"), F.col("digest"), F.col("url"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(CRLF + CRLF))
    chunk_head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n")
    chunks = F.transform(F.split("payload", r"(?<=WARC/1)(?=\.1\r\n)", -1),
                         lambda p: F.concat(F.lower(F.hex(F.octet_length(p))), F.lit(CRLF), p, F.lit(CRLF)))
    body = F.when(F.col("payload").contains(VERSION), F.concat(chunk_head, F.array_join(chunks, ""), F.lit("0\r\n\r\n"))).otherwise(F.concat(head, F.col("payload")))
    target, digest = F.col("url"), F.concat(F.lit("sha1:"), F.col("digest"))
    host, rest = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), F.regexp_extract("url", "^[a-z]+://[^/?#]*([^#]*)", 1)
    request = record("request", record_id(F.lit("request"), F.col("id"), F.col("digest"), F.col("url")),
                     F.concat(F.lit("GET "), F.when(rest == "", "/").otherwise(rest), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(CRLF + CRLF)),
                     "application/http; msgtype=request", date, Target_URI=target, Concurrent_To=rid)
    response = F.when(revisit, record(
        "revisit", rid, head, "application/http; msgtype=response", date, Target_URI=target, Payload_Digest=digest, Profile=F.lit(PROFILE),
        Refers_To=record_id(F.lit("response"), F.col("held_by"), F.col("digest"), F.col("held_url")), Refers_To_Target_URI=F.col("held_url"))
    ).otherwise(record("response", rid, body, "application/http; msgtype=response", date, Target_URI=target, Payload_Digest=digest))
    about = record("metadata", record_id(F.lit("metadata"), F.col("id"), F.col("digest"), F.col("url")),
                   F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(CRLF)),
                   "application/warc-fields", date, Target_URI=target, Concurrent_To=rid)
    joined.select(F.explode(F.array(request, response, about)).alias("value")).write.option("lineSep", CRLF + CRLF).text(path, compression="gzip")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """head (header lines, as text) and block (bytes) of every record of the archives below ``path``."""
    parts = spark.read.text(path, lineSep=VERSION).where("value <> ''")
    head = F.substring_index("value", CRLF + CRLF, 1)
    parts = parts.select("value", head.alias("head"), header("Content-Length", head).cast("int").alias("n"))
    block = F.substring(F.col("value").cast("binary"), F.octet_length("head") + 5, F.col("n"))
    whole = F.octet_length(block) == F.col("n")
    return parts.select("head", header("WARC-Type", F.col("head")).alias("type"),
                        F.when(whole, block).otherwise(F.raise_error(F.lit("a record is shorter than its Content-Length")).cast("binary")).alias("block"))


def header(name: str, head: Column) -> Column:
    """Value of a header line, null if there is none."""
    line = F.regexp_extract(F.concat(F.lit("\n"), head), rf"(?i)\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(line != "", line)


def dechunked(body: Column) -> Column:
    """The bytes of a body in chunked transfer coding: a step of the fold takes one chunk off its front."""
    start = F.struct(body.alias("rest"), F.lit(b"").alias("out"))

    def step(state: Column, _: Column) -> Column:
        line = F.substring_index(F.substring(state["rest"], 1, 20).cast("string"), CRLF, 1)
        size = F.coalesce(F.conv(F.regexp_extract(line, "^[0-9A-Fa-f]+", 0), 16, 10).cast("int"), F.lit(0))
        at = F.octet_length(line) + 3
        return F.when(size == 0, state).otherwise(F.struct(
            F.substring(state["rest"], at + size + 2, F.octet_length(state["rest"])).alias("rest"),
            F.concat(state["out"], F.substring(state["rest"], at, size)).alias("out")))

    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.regexp_count(body.cast("string"), F.lit("\r\n"))))
    return F.aggregate(steps, start, step, lambda s: s["out"])


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, url, request, response, metadata (structs)."""
    head, text = F.col("head"), F.col("block").cast("string")
    rid, with_id = header("WARC-Record-ID", head), header("WARC-Concurrent-To", head)
    http = F.substring_index(text, CRLF + CRLF, 1)
    body = F.substring(F.col("block"), F.octet_length(http) + 5, F.octet_length("block"))
    chunked = F.lower(F.coalesce(header("Transfer-Encoding", http), F.lit(""))) == "chunked"
    held = F.col("type") == "response"
    answers = records.where(F.col("type").isin("response", "revisit")).select(
        rid.alias("capture_id"), header("WARC-Target-URI", head).alias("url"), header("WARC-Refers-To", head).alias("refers_to"), F.col("type").alias("record_type"),
        F.regexp_extract(http, r"^\S+ (\d+)", 1).cast("int").alias("status"),
        F.regexp_replace(header("WARC-Payload-Digest", head), "^sha1:", "").alias("stated_digest"),
        header("Content-Length", http).cast("long").alias("stated_bytes"),
        F.when(held, F.when(chunked, dechunked(body)).otherwise(body)).alias("payload"))
    answers = answers.withColumn("payload_digest", F.coalesce(F.sha1("payload"), F.col("stated_digest")))
    answers = answers.withColumn("payload_bytes", F.coalesce(F.octet_length("payload"), F.col("stated_bytes")).cast("long"))
    requests = records.where("type = 'request'").select(
        with_id.alias("capture_id"), F.struct(F.regexp_extract(text, r"^(\S+)", 1).alias("method"), F.regexp_extract(text, r"^\S+ (\S+)", 1).alias("path"),
                                              header("Host", http).alias("host")).alias("request")).groupBy("capture_id").agg(F.min("request").alias("request"))
    abouts = records.where("type = 'metadata'").select(
        with_id.alias("capture_id"), F.struct(header("page-id", text).try_cast("long").alias("page_id")).alias("metadata")).groupBy("capture_id").agg(F.min("metadata").alias("metadata"))
    joined = answers.join(requests, "capture_id", "left").join(abouts, "capture_id", "left")
    return joined.select("capture_id", "url", "request", F.struct("record_type", "status", "payload", "payload_digest", "payload_bytes", "refers_to").alias("response"), "metadata")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """The digest of an archive by page: what ``captures`` finds, with revisits resolved to page ids."""
    response = F.col("response")
    flat = materialize(captures(read_records(spark, path)).select(
        F.col("metadata.page_id").alias("page_id"), *[response[c].alias(c) for c in ("payload_bytes", "payload_digest", "record_type")],
        response["refers_to"].alias("_to"), F.col("capture_id").alias("_id")))
    wanted = flat.select("_to").where("_to is not null").distinct()
    held = flat.where("record_type = 'response'").select(F.col("_id").alias("_to"), F.col("page_id").alias("refers_to")).join(
        wanted, "_to", "left_semi").groupBy("_to").agg(F.max("refers_to").alias("refers_to"))
    joined = salted_join(flat, held, ["_to"], F.col("_id"))
    return joined.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(T.LongType()))
