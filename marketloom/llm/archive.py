"""Content-addressed WARC archive: a payload is stored once, record headers exactly, records are put together by joins.

An archive is a folder of two tables. ``payloads`` holds each distinct payload once beside its SHA-256 digest. ``records``
holds a row per record: the digest and the exact bytes that stand before the payload, which are the WARC header and, in
responses, the HTTP header. ``reconstructed`` joins both to whole WARC/1.1 records again. A payload's digest, its length
and the SHA-1 that each header states are computed anew from the stored bytes whenever an archive is read; bytes that
don't agree end the run, so neither a damaged archive nor two payloads of one digest pass unseen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketloom.llm.common import stored
from marketloom.session import new_folder

WRITTEN_AT = "1970-01-01T00:00:00Z"
"""WARC-Date of the records: pages come without a time, and archives of the same pages should agree."""

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

_RECORD = "<urn:marketloom:page:%s:%s>"
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """160 bits in hexadecimal as base 32 (RFC 4648): ten hexadecimal digits are eight of base 32."""
    eight = [F.lpad(F.conv(F.substring(hexadecimal, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*eight), _DIGITS, _BASE32)


def sha1_base32(payload: Column) -> Column:
    return base32(F.sha1(payload))


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def _fields(*fields: tuple[str, Column | None]) -> Column:
    """Header lines; a field whose value is null is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields])


def _headers(url: Column, size: Column, digest: Column, record: Column, refers_to: Column) -> Column:
    """All of a record's bytes before its payload. An url that can't stand in one line is stored in base 64."""
    plain = ~F.rlike(url, F.lit(r"[\x00-\x1F\x7F]"))
    revisit = refers_to.isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END))
    block = F.when(revisit, 0).otherwise(F.octet_length(http) + size)
    warc = F.concat(F.lit("WARC/1.1\r\n"), _fields(
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", record), ("WARC-Date", F.lit(WRITTEN_AT)),
        ("WARC-Target-URI", F.when(plain, url)),
        ("WARC-Target-URI-Base64", F.when(~plain, F.replace(F.base64(F.encode(url, "utf-8")), F.lit("\r\n"), F.lit("")))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))), ("WARC-Refers-To", refers_to),
        ("Content-Type", F.when(~revisit, F.lit("application/http;msgtype=response"))),
        ("Content-Length", block.cast("string")),
    ), F.lit("\r\n"))
    return F.encode(F.concat(warc, F.when(revisit, F.lit("")).otherwise(http)), "utf-8")


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Writes ``pages`` (``page_id, url, html``) to ``folder``: a record per row, every distinct payload once.

    The payload is ``html`` in UTF-8, none if null. Of records whose payloads of at least ``least_bytes`` bytes agree the one
    with the largest ``page_id`` is the response, a null id being smallest; of rows that repeat it one is chosen. All others
    are revisits of it. A payload travels at most once per task and digest; records meet their response by small rows.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    # Numbered and stored before rows are compared, so that a repeated task can't number them anew.
    rows = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select(
        "page_id", "url", F.monotonically_increasing_id().alias("row"), F.sha2("payload", 256).alias("key"),
        sha1_base32(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("size"),
    ), "warc-rows")
    # Only what repeats is joined; both sides of the join are read from storage, so a frequent payload can be split.
    repeated = stored(
        rows.where(F.col("size") >= least_bytes).groupBy("key").agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("key", "first"), "warc-responses",
    )
    of = lambda c: F.format_string(_RECORD, _text(F.col(f"{c}page_id")), _text(F.col(f"{c}row")))
    refers_to = F.when((F.col("size") >= least_bytes) & (F.col("first.row") != F.col("row")), of("first."))
    rows.join(repeated, "key", "left").select(
        "key", _headers(F.col("url"), F.col("size"), F.col("sha1"), of(""), refers_to).alias("header")
    ).write.parquet(f"{folder}/records")
    pages.select(payload.alias("payload")).groupBy(F.sha2("payload", 256).alias("key")).agg(
        F.first("payload").alias("payload")
    ).write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read_payloads(session: SparkSession, folder: str) -> DataFrame:
    """``key, payload, size, sha1`` of an archive; a payload that isn't what its digest says ends the run."""
    stored_ = session.read.parquet(f"{folder}/payloads")
    good = F.sha2("payload", 256) == F.col("key")
    return stored_.select(
        "key", F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "key"))).alias("payload")
    ).select("key", "payload", F.octet_length("payload").cast("long").alias("size"), sha1_base32(F.col("payload")).alias("sha1"))


def _field(name: str) -> Column:
    """A header field's value, null if there is none."""
    found = F.regexp_extract(F.col("warc"), rf"(?s)\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains("warc", F.lit(f"\r\n{name}: ")), found)


def read_records(session: SparkSession, folder: str) -> DataFrame:
    """Parsed headers: ``key, header, page_id, record_id, record_type, url, digest, refers_to`` (the response's page id)."""
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:marketloom:page:(null|-?\d+):", 1), F.lit("null")).cast("long")
    # Fields are looked for in the WARC header only, which ends at the first empty line.
    lines = session.read.parquet(f"{folder}/records").withColumn(
        "warc", F.concat(F.substring_index(F.decode("header", "utf-8"), END, 1), F.lit("\r\n"))
    )
    return lines.select(
        "key", "header", _field("WARC-Record-ID").alias("record_id"), _field("WARC-Type").alias("record_type"),
        F.coalesce(_field("WARC-Target-URI"), F.decode(F.unbase64(_field("WARC-Target-URI-Base64")), "utf-8")).alias("url"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("digest"), _field("WARC-Refers-To").alias("refers"),
    ).withColumns({"page_id": page(F.col("record_id")), "refers_to": page(F.col("refers"))}).drop("refers")


def reconstructed(session: SparkSession, folder: str) -> DataFrame:
    """Every record of an archive as it stood in a WARC file: ``page_id, record_id, record``."""
    records = read_records(session, folder).select("key", "page_id", "record_id", "record_type", "header")
    end = F.encode(F.lit(END), "utf-8")
    payloads = read_payloads(session, folder).select("key", "payload")
    responses = records.where("record_type = 'response'").join(payloads, "key").select(
        "page_id", "record_id", F.concat("header", "payload", end).alias("record")
    )
    return responses.unionByName(
        records.where("record_type = 'revisit'").select("page_id", "record_id", F.concat("header", end).alias("record"))
    )


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the archive of ``pages`` and returns what it holds, read back.

    Per page ``page_id, payload_bytes, payload_digest`` (bare base-32 SHA-1), both of the stored payload, ``record_type``
    (``response`` or ``revisit``) and ``refers_to``, the response's page of a revisit. A null ``html`` is an empty payload, and
    empty payloads equal each other. Null page ids are smallest; a revisit of a page without id refers to null. Repeated
    rows and repeated ids are records of their own, one of them the response. Texts of any length are kept whole. An
    empty table gives no rows. Columns besides ``page_id``, ``url`` and ``html`` are ignored.
    """
    session = pages.sparkSession
    folder = new_folder(session, "warc")
    write_archive(pages, folder, least_bytes)
    records = read_records(session, folder).select("key", "page_id", "record_type", "refers_to", "digest")
    payloads = read_payloads(session, folder).select("key", "size", "sha1")
    agree = F.col("digest") == F.col("sha1")
    return records.join(payloads, "key").select(
        "page_id", F.col("size").alias("payload_bytes"),
        F.when(agree, F.col("sha1")).otherwise(F.raise_error(F.concat(F.lit("two payloads of digest "), "key"))).alias("payload_digest"),
        "record_type", "refers_to",
    )
