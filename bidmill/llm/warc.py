"""WARC archives: writing pages, and reading archives by boundary-chain verification.

Reading splits the archives at the magic line of a record, wherever it stands, so a payload that
holds a magic line gives false candidates. Each candidate states by its own header where its
successor must begin. Starting at the first byte of each file, pointer jumping marks what can be
reached: each round joins the marked records with the current pointers, then doubles the pointers,
so a file of n records takes log2(n) rounds of joins on (file, offset). Only records on the chain
remain; false candidates are part of the payload they stand in.

Writing stores each payload of at least LEAST_SHARED bytes once: the page with the smallest id is
the response, other pages with equal payloads revisit it, without the payload.

Defined cases: null html is an empty payload. Pages without an id cannot be referred to, so they
revisit the page with the smallest id of those that have one, and are responses if there is none.
Rows that repeat the response's id and payload are responses too. Line breaks in URLs are
percent-encoded. Files that do not begin with a magic line have no chain and give nothing; behind
a broken record the rest of a file is not reached. No pages give no archives, and reading a folder
without archives gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidmill.llm.common import stored

MAGIC = "WARC/1.1\r\n"
LEAST_SHARED = 100
RECORDS_PER_FILE = 1000
_GAP = "\r\n\r\n"


def write_archives(pages: DataFrame, path: str) -> None:
    """A record for each row of pages (page_id, url, html), in gzipped files of bounded length."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    first = rows.where(F.octet_length("payload") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = stored(pages.sparkSession, first.where("n > 1 and first is not null").drop("n"), "payloads")
    rows = rows.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    size = F.octet_length("payload").cast("string")
    record = F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nPayload-Length: "), size,
        F.lit("\r\nContent-Length: "), F.when(revisit, "0").otherwise(size), F.lit(_GAP),
        F.when(revisit, "").otherwise(F.col("payload")), F.lit("\r\n"),
    )
    writer = rows.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)  # the separator is the last line break


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magic lines, in file order by (file, split, place)."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place")
    )


def _header(name: str, value: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?:^|\r\n){name}: *{value}", 1), F.lit(""))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place with a magic line: what its header says, where it is, and where its successor must be.

    Offsets count bytes of the uncompressed file. They come from the lengths of all chunks in front:
    those of earlier splits of the file, then those of the same split.
    """
    magic = len(MAGIC)
    head = F.when(F.contains("value", F.lit(_GAP)), F.substring_index("value", _GAP, 1))
    chunk = _chunks(spark, path).withColumn("head", head).select(
        "file", "split", "place", F.octet_length("value").cast("long").alias("size"),
        (F.octet_length("head") + len(_GAP)).cast("long").alias("body_at"),
        _header("Content-Length", r"(\d{1,18})").cast("long").alias("body_bytes"),
        _header("WARC-Type", r"([^\r]*)").alias("record_type"),
        _header("WARC-Record-ID", r"<urn:page:(-?\d{1,19})>").try_cast("long").alias("page_id"),
        _header("WARC-Refers-To", r"<urn:page:(-?\d{1,19})>").try_cast("long").alias("refers_to"),
        _header("WARC-Target-URI", r"([^\r]*)").alias("url"),
        _header("WARC-Payload-Digest", r"sha256:([0-9a-f]{64})").alias("stated_digest"),
        _header("Payload-Length", r"(\d{1,18})").cast("long").alias("stated_bytes"), "value",
    )
    stated = F.col("body_at") + F.col("body_bytes") + len(_GAP)
    whole = stated <= F.col("size")
    body = F.substring(F.col("value").cast("binary"), F.col("body_at").cast("int") + 1, F.col("body_bytes").cast("int"))
    chunk = chunk.withColumn("stated", stated).withColumn("digest", F.when(whole, F.sha2(body, 256))).drop("value")
    chunk = stored(spark, chunk, "candidates")
    splits = chunk.groupBy("file", "split").agg(F.sum(F.col("size") + magic).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "split").orderBy("place")
    so_far = F.coalesce(F.sum(F.col("size") + magic).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = chunk.withColumn("so_far", so_far).withColumn("number", F.row_number().over(inside))
    placed = numbered.join(bases, ["file", "split"]).withColumn("offset", F.col("base") + F.col("so_far") - magic)
    # The chunk in front of the first magic line has no record.
    return placed.where("offset >= 0").withColumn("next", F.col("offset") + magic + F.col("stated")).drop("base", "so_far", "stated")


def reachable(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """The (file, offset) that the chains from the starts of files reach, by pointer jumping.

    After k rounds the first 2**k records of each file are marked and pointers lead 2**k records on.
    """
    marked = stored(spark, nodes.where("offset = 0").select("file", "offset"), "marked")
    jump = nodes.select("file", "offset", "next")
    parts = [marked]
    while True:
        ahead = marked.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        new = stored(spark, ahead.join(nodes.select("file", "offset"), ["file", "offset"], "left_semi"), "marked")
        if new.isEmpty():
            return marked
        parts.append(new)
        marked = parts[0]
        for part in parts[1:]:
            marked = marked.unionAll(part)
        twice = jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.next") == F.col("b.offset")))
        jump = stored(spark, twice.select("a.file", "a.offset", "b.next"), "pointers")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder, with their whole payloads' length and digest."""
    found = stored(spark, candidates(spark, path).where("body_bytes is not null and record_type is not null or offset = 0"), "records")
    chain = reachable(spark, found.where("next is not null"))
    records = stored(spark, found.join(chain, ["file", "offset"], "left_semi"), "chain")
    broken = records.where("digest is null")
    if not broken.isEmpty():
        rest = _rejoined(spark, path, broken)
        records = records.where("digest is not null").unionByName(rest)
    revisit = F.col("record_type") == "revisit"
    result = records.select(
        "page_id", F.when(revisit, F.col("stated_bytes")).otherwise(F.col("body_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"), "record_type", "refers_to", "url", "file", "offset",
    )
    return result


def _rejoined(spark: SparkSession, path: str, broken: DataFrame) -> DataFrame:
    """Digests of records whose payload holds magic lines, from all chunks up to the successor.

    The archives are read once more; chunks are met by file, split and number in the split.
    """
    where = candidates(spark, path).select("file", "split", "number", "offset").alias("c")
    ends = broken.select("file", F.col("offset").alias("record"), "next").alias("b")
    # Each false candidate is inside of one record; equal files are met, then ranges of offsets.
    spans = where.join(ends, (F.col("c.file") == F.col("b.file")) & (F.col("c.offset") >= F.col("b.record")) & (F.col("c.offset") < F.col("b.next")))
    spans = stored(spark, spans.select("c.file", "c.split", "c.number", "c.offset", "b.record"), "spans")
    again = _chunks(spark, path).join(spans.select("file").distinct(), "file", "left_semi")
    first = again.groupBy("file", "split").agg(F.min("place").alias("first"))
    again = again.join(first, ["file", "split"]).withColumn("number", (F.col("place") - F.col("first") + 1).cast("int"))
    parts = again.join(spans, ["file", "split", "number"]).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("offset", F.col("value").cast("binary").alias("value")))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda so_far, p: F.concat(so_far, F.when(F.octet_length(so_far) > 0, F.lit(MAGIC.encode())).otherwise(F.lit(b"")), p["value"]))
    joined = parts.select("file", F.col("record").alias("offset"), whole.alias("value"))
    body = F.substring("value", F.col("body_at").cast("int") + 1, F.col("body_bytes").cast("int"))
    complete = F.octet_length("value") >= F.col("body_at") + F.col("body_bytes")
    return broken.drop("digest").join(joined, ["file", "offset"]).where(complete).withColumn("digest", F.sha2(body, 256)).drop("value")
