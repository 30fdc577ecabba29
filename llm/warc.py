r"""WARC archives: writing, reading, and assembling transactions.

Each capture is three records: the response (or a revisit, when an earlier capture holds the same
payload), and a request and a metadata record that point at it by ``WARC-Concurrent-To``. Spark
composes the records and writes them as gzipped text whose row separator is the empty lines that
end a WARC record, so any store that Spark writes will do. Reading goes by Content-Length, so
payloads may hold anything, and takes files with one gzip member, with one per record, or with none.
``assemble`` joins the records again and gives one nested row per capture.

Payloads of at least ``MIN_REVISIT`` bytes that are equal are stored once: the smallest page_id has
the response, the others revisit it. Rows that repeat the smallest page_id are responses too. Where
all page_ids of a payload are NULL, each is a response. NULL html is an empty payload, a NULL url
leaves the target out. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.registry import query, stored, table
from tallyboard.sources.scratch import scratch_path

MIN_REVISIT = 100
RECORDS_PER_FILE = 6000
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, warc_type string, concurrent_to string, refers_to string, target_uri string, date string, "
          "payload_digest string, payload_bytes long, page_id long, http_header string, payload binary")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\t", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(kind: str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without the two line ends behind it. NULL headers are left out."""
    lines = [F.lit(f"WARC/1.1{END}WARC-Type: {kind}{END}")]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit("")) for name, value in headers]
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END), block)


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the records of all pages (page_id, url, html) below ``path``."""
    html, url = F.coalesce("html", F.lit("")), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "")
    digest = F.sha2(html, 256)
    known = pages.select("page_id", url.alias("url"), digest.alias("digest"), F.octet_length(html).alias("bytes"))
    groups = known.filter(F.col("bytes") >= MIN_REVISIT).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first_"))
    groups = stored(groups.filter((F.col("n") > 1) & F.col("first_").isNotNull()).select("digest", "first_"), "payloads")
    rows = pages.select("page_id", url.alias("url"), html.alias("html"), digest.alias("digest")).join(groups, "digest", "left")
    capture = lambda page, where: _uuid(F.lit("capture"), F.coalesce(page.cast("string"), F.lit("")), where, F.col("digest"))
    rows = rows.withColumns({"id": capture(F.col("page_id"), F.col("url")), "target": F.when(F.col("url") != "", F.col("url")),
                             "revisit": F.col("first_").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_.page_id"))})
    common = [("WARC-Target-URI", F.col("target")), ("WARC-Date", F.lit(date))]
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.octet_length("html").cast("string"), F.lit(END + END))
    main = [("WARC-Record-ID", F.col("id")), *common, ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))]
    response = _record("response", [*main, ("Content-Type", F.lit("application/http;msgtype=response"))], F.concat(http, F.col("html")))
    revisit = _record("revisit", [*main, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", capture(F.col("first_.page_id"), F.col("first_.url"))),
                                  ("Content-Type", F.lit("application/http;msgtype=response"))], http)
    beside = lambda kind: [("WARC-Record-ID", _uuid(F.lit(kind), F.col("id"))), *common, ("WARC-Concurrent-To", F.col("id"))]
    request = _record("request", [*beside("request"), ("Content-Type", F.lit("application/http;msgtype=request"))],
                      F.concat(F.lit("GET "), F.coalesce("target", F.lit("/")), F.lit(f" HTTP/1.1{END}{END}")))
    metadata = _record("metadata", [*beside("metadata"), ("Content-Type", F.lit("application/warc-fields"))],
                       F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END)))
    records = rows.select(F.explode(F.array(request, F.when(F.col("revisit"), revisit).otherwise(response), metadata)).alias("value"))
    (records.write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _unzipped(content: bytes) -> bytes:
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(parts) if parts else content


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of one file."""
    data, at = _unzipped(content), 0
    while (start := data.find(b"WARC/", at)) >= 0:
        stop = data.find(b"\r\n\r\n", start)
        if stop < 0:
            raise ValueError("a record's header has no end")
        lines = data[start:stop].decode().split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at = stop + 4 + int(headers["content-length"])
        if at > len(data):
            raise ValueError("a record is cut short")
        yield headers, data[stop + 4:at]


def read_warc(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """The records below ``path``, with digest and size of each payload as it was read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in parse_records(content.as_py()):
                    kind = h.get("warc-type")
                    digest, size, page, head, payload = (h.get("warc-payload-digest") or "").removeprefix("sha256:") or None, None, None, None, None
                    if kind in ("response", "revisit", "request"):
                        header, _, payload = block.partition(b"\r\n\r\n")
                        head = header.decode()
                    if kind == "response":
                        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
                    if kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x)
                        page = int(fields["page_id"]) if fields.get("page_id") else None
                    rows.append((h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"),
                                 h.get("warc-date"), digest, size, page, head, payload if keep_payload and kind == "response" else None))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, capture_id, target_uri, date, request, response, refers_to.

    ``response`` of a revisit has size, digest and payload of the record it refers to, whose page_id
    is ``refers_to``. A capture without request or metadata record has NULLs there.
    """
    kinds = {k: records.filter(F.col("warc_type") == k) for k in ("request", "metadata", "response", "revisit")}
    request = kinds["request"].groupBy("concurrent_to").agg(F.min(F.struct("record_id", "http_header")).alias("request"))
    metadata = kinds["metadata"].groupBy("concurrent_to").agg(F.min("page_id").alias("page_id"))
    joined = lambda main: (main.drop("page_id", "concurrent_to").join(request.withColumnRenamed("concurrent_to", "of_request"), F.col("record_id") == F.col("of_request"), "left")
                           .join(metadata.withColumnRenamed("concurrent_to", "of_metadata"), F.col("record_id") == F.col("of_metadata"), "left"))
    content = ("payload_digest", "payload_bytes", "payload")
    wanted = kinds["revisit"].select(F.col("refers_to").alias("source_id")).distinct()
    sources = (kinds["response"].join(wanted, F.col("record_id") == F.col("source_id")).groupBy("source_id")
               .agg(F.first(F.struct(*content)).alias("source"))
               .join(metadata.withColumnRenamed("concurrent_to", "of_source").withColumnRenamed("page_id", "source_page"),
                     F.col("source_id") == F.col("of_source"), "left"))
    revisits = joined(kinds["revisit"]).join(sources, F.col("refers_to") == F.col("source_id"), "left").select(
        "page_id", F.col("record_id").alias("capture_id"), "target_uri", "date", "request",
        F.struct("warc_type", "http_header", "payload_digest", F.col("source.payload_bytes").alias("payload_bytes"),
                 F.col("source.payload").alias("payload")).alias("response"), F.col("source_page").alias("refers_to"))
    responses = joined(kinds["response"]).select(
        "page_id", F.col("record_id").alias("capture_id"), "target_uri", "date", "request",
        F.struct("warc_type", "http_header", *content).alias("response"), F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)


#: What the archives must give back, from the pages themselves.
SQL = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages),
g AS (SELECT digest, min(page_id) AS first FROM p WHERE bytes >= {MIN_REVISIT} GROUP BY digest HAVING count(*) > 1)
SELECT page_id, bytes AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN g.first IS NOT NULL AND page_id IS DISTINCT FROM g.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first IS NOT NULL AND page_id IS DISTINCT FROM g.first THEN g.first END AS refers_to
FROM p LEFT JOIN g USING (digest)
"""


@query("op9_warc", SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    captures = assemble(stored(read_warc(spark, path, keep_payload=False), "records"))
    return captures.select("page_id", F.col("response.payload_bytes").alias("payload_bytes"),
                           F.col("response.payload_digest").alias("payload_digest"),
                           F.col("response.warc_type").alias("record_type"), "refers_to")
