"""Content-addressed WARC archive.

Two tables make an archive. ``payloads`` holds the bytes of every distinct payload once, under
their SHA-256. ``records`` holds the exact header of every record and the SHA-256 of its
payload. Joining the two gives the original records back, byte for byte.

Defined results:
* a null html is an empty payload, a null url gives a record without a target line, line
  breaks in a url are written as %0D and %0A;
* of the records with equal payloads of at least ``least`` bytes the one with the largest id is
  a response and the others are revisits of it; rows that repeat that id are responses too, and
  rows without an id are always responses, to which nothing refers;
* an empty table gives an empty archive; other columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackmill.llm.common import shared_folder, table

LEAST = 1000
DATE = "1970-01-01T00:00:00Z"
LINE = "\r\n"


def _page_uri(number: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))


def _header(date: str) -> Column:
    revisit = F.col("type") == "revisit"
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("type")),
        F.concat(F.lit("WARC-Record-ID: "), _page_uri(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _page_uri(F.col("owner")))),
        F.when(
            revisit,
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("n_bytes"))),
    ]
    # concat_ws leaves out the lines that are null
    return F.concat(F.concat_ws(LINE, *lines), F.lit(LINE * 2))


def write_archive(pages: DataFrame, folder: str, least: int = LEAST, date: str = DATE) -> None:
    """Archive ``pages`` (page_id, url, html) as the two tables under ``folder``."""
    rows = pages.select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumn("address", F.unhex(F.sha2("payload", 256)))
    # copies merge on the map side, so a payload that a third of all rows share moves once a task
    unique = rows.groupBy("address").agg(
        F.first("payload").alias("payload"),
        F.max("page_id").alias("owner"),
        F.min(F.sha1("payload")).alias("sha1"),
        F.max(F.sha1("payload")).alias("other_sha1"),
        F.min(F.octet_length("payload")).alias("n_bytes"),
        F.max(F.octet_length("payload")).alias("other_n_bytes"),
    )
    same = (F.col("sha1") == F.col("other_sha1")) & (F.col("n_bytes") == F.col("other_n_bytes"))
    (
        unique.withColumn("sha1", F.when(same, F.col("sha1")).otherwise(
            F.raise_error(F.lit("two payloads with one SHA-256"))
        ))
        .select("address", "payload", "owner", "sha1", F.col("n_bytes").cast("long").alias("n_bytes"))
        .write.parquet(f"{folder}/payloads")
    )
    payloads = pages.sparkSession.read.parquet(f"{folder}/payloads")
    kind = F.when(
        (F.col("n_bytes") >= least) & (F.col("page_id") < F.col("owner")), F.lit("revisit")
    ).otherwise(F.lit("response"))
    (
        rows.select("page_id", "url", "address")
        .join(payloads.select("address", "owner", "sha1", "n_bytes"), "address")
        .withColumn("type", kind)
        .select("address", _header(date).alias("header"))
        .write.parquet(f"{folder}/records")
    )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: header and block as stored, the parsed fields, and the full payload.

    ``record`` is the exact record: header, block (empty for a revisit) and two line ends. The
    read fails where stored bytes do not match their address.
    """
    payloads = spark.read.parquet(f"{folder}/payloads").select("address", "payload")
    records = spark.read.parquet(f"{folder}/records")

    def field(name: str, value: str = "([^\r\n]*)") -> Column:
        found = F.regexp_extract("header", f"\r\n{name}: {value}\r\n", 1)
        return F.when(found != "", found)

    checked = F.when(
        F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload")
    ).otherwise(F.raise_error(F.lit("stored payload does not match its address")).cast("binary"))
    payloads = payloads.withColumn("payload", checked)
    block = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(
        F.lit("").cast("binary")
    )
    return records.join(payloads, "address").select(
        field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Payload-Digest", "sha1:([0-9a-f]{40})").alias("payload_digest"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
        field("Content-Length").cast("long").alias("content_length"),
        "payload",
        F.concat(F.encode("header", "UTF-8"), block, F.encode(F.lit(LINE * 2), "UTF-8")).alias("record"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder).select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


OP10_SQL = """
with p as (
    select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as d from pages
), g as (
    select d, max(page_id) as owner from p group by d
)
select page_id, n as payload_bytes, d as payload_digest,
       case when n >= 1000 and page_id < owner then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id < owner then owner end as refers_to
from p join g using (d)
"""
