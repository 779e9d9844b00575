"""A content-addressed archive of web records.

Three tables lie below an archive's path. ``digests`` numbers the records and holds the digests of their
payloads. ``payloads`` holds each payload's bytes once, under its SHA-256. ``records`` holds each record's
exact WARC header and the head of its HTTP block. A record as it stands in a WARC file is put together by
joining the last two. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlens.llm.common import materialize
from cardlens.operators.joins import lookup_join

# The version line, record types, profile and line ends of the WARC format.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EOL = "\r\n"
# The characters that some reader takes for the end of a line, and their UTF-8 bytes percent-encoded.
_LINE_ENDS = {
    "\n": "%0A", "\v": "%0B", "\f": "%0C", "\r": "%0D", "\x1c": "%1C", "\x1d": "%1D", "\x1e": "%1E", "\x85": "%C2%85",
    "\u2028": "%E2%80%A8", "\u2029": "%E2%80%A9",
}
_ESCAPED = "X-Target-URI-Escaped"
_HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_EOL))


def _escaped(url: Column) -> Column:
    """On one line: percent signs and line ends as their codes."""
    url = F.replace(url, F.lit("%"), F.lit("%25"))
    for end, code in _LINE_ENDS.items():
        url = F.replace(url, F.lit(end), F.lit(code))
    return url


def _plain(url: Column) -> Column:
    """What ``_escaped`` was given."""
    for end, code in _LINE_ENDS.items():
        url = F.replace(url, F.lit(code), F.lit(end))
    return F.replace(url, F.lit("%25"), F.lit("%"))


def _record_id(record: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), record.cast("string"), F.lit(">"))


def write_archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Archive a record for every row of ``pages``.

    The payload is the text in UTF-8; a null text is an empty payload, a null url an empty target. Of the
    records whose payloads are equal and have ``least`` bytes or more, the one with the largest page id (of
    rows that repeat it, the last) is a response; the others are revisits of it. All smaller ones are
    responses. A null page id is smaller than any other and is written as an empty header value. A line end
    in a url, of whatever kind, would break a header: such a url is written with its line ends and percent signs
    percent-encoded, a header says so, and ``read_archive`` gives the url back. Other urls are written as they are.

    Equal means equal SHA-256, SHA-1 and length. Only payloads that occur more than once are brought
    together, each combined before its shuffle, so a payload that fills a third of the table costs one
    row a task; the others go to the store as they are read.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    digests = materialize(
        spark,
        pages.select(
            F.monotonically_increasing_id().alias("record"),
            F.col(page_id).cast("long").alias("page_id"),
            F.coalesce(F.col(url), F.lit("")).alias("url"),
            F.sha2(body, 256).alias("sha256"),
            F.sha1(body).alias("sha1"),
            F.octet_length(body).cast("long").alias("bytes"),
        ),
        "warc-digests",
    )
    groups = digests.groupBy("sha256", "sha1", "bytes").agg(
        F.count("*").alias("n"), F.max(F.struct(F.col("page_id"), F.col("record"))).alias("owner")
    )
    repeated = materialize(spark, groups.where("n > 1"), "warc-repeated")

    bodies = pages.select(F.sha2(body, 256).alias("sha256"), body.alias("payload"), F.xxhash64(page_id, url).alias("row"))
    keys = repeated.select("sha256")
    once = lookup_join(bodies, keys, "sha256", ["row"], "left_anti")
    copies = lookup_join(bodies, keys, "sha256", ["row"], "left_semi")
    once.drop("row").unionByName(copies.groupBy("sha256").agg(F.first("payload").alias("payload"))).write.parquet(f"{path}/payloads")

    owners = repeated.where(F.col("bytes") >= least).select(
        "sha256", F.col("owner.record").alias("owner"), F.col("owner.page_id").alias("owner_page")
    )
    owned = lookup_join(digests, owners, "sha256", ["record"], "left")
    original = F.col("owner").isNull() | (F.col("owner") == F.col("record"))
    length = F.octet_length(F.lit(_HTTP_HEAD)) + F.when(original, F.col("bytes")).otherwise(0)
    broken = F.col("url").rlike(f"[{''.join(_LINE_ENDS)}]")
    header = F.concat(
        F.lit(_VERSION + _EOL),
        _line("WARC-Type", F.when(original, "response").otherwise("revisit")),
        _line("WARC-Record-ID", _record_id(F.col("record"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.when(broken, _escaped(F.col("url"))).otherwise(F.col("url"))),
        F.when(broken, _line(_ESCAPED, F.lit("yes"))).otherwise(""),
        _line("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(original, "").otherwise(
            F.concat(
                _line("WARC-Refers-To", _record_id(F.col("owner"))),
                _line("X-Refers-To-Page-ID", F.coalesce(F.col("owner_page").cast("string"), F.lit(""))),
                _line("WARC-Profile", F.lit(_PROFILE)),
            )
        ),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(_EOL),
    )
    owned.select("record", header.cast("binary").alias("header"), F.lit(_HTTP_HEAD).cast("binary").alias("block_head"), "sha256").write.parquet(
        f"{path}/records"
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive: ``record`` (its whole bytes as in a WARC file), its parsed ``page_id``,
    ``url``, ``record_type``, ``payload_digest``, ``refers_to`` (a page id) and the full ``payload``.

    A revisit has no payload of its own in its bytes; ``payload`` is that of the record it refers to. A
    payload that does not have the digests it is stored under, or is not there, is an error.
    """
    records = spark.read.parquet(f"{path}/records")
    stored = spark.read.parquet(f"{path}/payloads")
    # Payloads are large and a digest may be that of many records: a shuffle join that adaptive execution
    # splits; the narrow side is the one with the hot keys.
    joined = records.join(stored, "sha256", "left")
    text = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        # With (?d) a line ends at a line feed only, and no value holds one.
        return F.regexp_extract(F.col("text"), f"(?dm)^{name}: ([^\r\n]*)\r?$", 1)

    target = field("WARC-Target-URI")

    parsed = joined.withColumn("text", text).select(
        "header", "block_head", "payload", "sha256",
        field("X-Page-ID").try_cast("long").alias("page_id"), F.when(field(_ESCAPED) == "yes", _plain(target)).otherwise(target).alias("url"),
        field("WARC-Type").alias("record_type"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        field("X-Refers-To-Page-ID").try_cast("long").alias("refers_to"),
    )
    sound = F.coalesce((F.sha2("payload", 256) == F.col("sha256")) & (F.sha1("payload") == F.col("payload_digest")), F.lit(False))
    checked = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("bad payload "), F.col("sha256"))).cast("binary"))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    whole = F.concat("header", "block_head", body, F.lit(b"\r\n\r\n"))
    return parsed.select(
        "page_id", "url", "record_type", "payload_digest", "refers_to", checked.alias("payload"), whole.alias("record")
    )
