"""WARC archives with Spark's own readers and writers, and boundary-chain verification.

Writing: a record is one row of the text sink whose line separator is the blank line that ends a WARC
record, so Spark's commit protocol covers the archive and any store that Spark writes will do.

Reading: the text source splits files at ``WARC/1.0 CRLF``, in parallel over byte ranges. Every magic is
only a candidate: payloads may hold the same bytes. Each task gives its candidates' offsets and the
offset that their Content-Length says comes next. Those links are followed from the start of the file by
pointer jumping, and only records on that chain are kept. Neighbours that point at one another within a byte
range count as one node, so the jumps go over ranges and odd records, not over all records. Offsets come
from a running sum within a byte range and a walk over the ranges of a file; payloads take part in neither
unless they are asked for.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retort.llm.common import materialize

MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
#: Bytes of a bucket when segments look for the record around them.
BUCKET = 1 << 20


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: 5 bytes are 8 digits of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """One record for each row. Of rows with equal payloads, those with the largest id are responses and the
    others revisits of it. A null payload is empty; a null id or URI is left out of the record (a null id
    is smaller than any other); line breaks in a URI become %0A."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).alias("uri"), body.alias("body")).withColumn("digest", base32_sha1(F.col("body")))
    copies = rows.groupBy("digest").agg(F.max("id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(materialize(copies, "warc-copies"), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    maybe = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    header = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), maybe("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.lit(date)), maybe("WARC-Target-URI", F.regexp_replace("uri", "[\r\n]+", "%0A")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                 line("WARC-Refers-To", urn(F.col("first_id"))))).otherwise(line("Content-Type", F.lit("text/html; charset=utf-8"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.octet_length("body")).cast("string"), F.lit(GAP))
    record = F.concat(header.cast("binary"), F.when(revisit, F.lit(b"")).otherwise(F.col("body"))).cast("string")
    rows.select(record.alias("value")).write.option("lineSep", GAP).text(path)


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between one magic and the next, with the header fields that a record would have there; in
    order of ``mid`` within a byte range (file, block). The first of a file is what comes before any magic."""
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")).alias("block_end"),
        F.monotonically_increasing_id().alias("mid"), F.col("value").cast("binary").alias("content"),
        F.when(F.contains("value", F.lit(GAP)), F.substring_index("value", GAP, 1)).alias("header"))
    stated = F.regexp_extract("header", r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]+)[ \t]*(?:\r\n|$)", 1)
    raw = raw.withColumn("length", F.nullif(stated, F.lit("")).try_cast("long")).withColumn("head_size", F.octet_length("header").cast("long"))
    here = F.expr("substring(content, cast(head_size as int) + 5, cast(least(length, 2147483647) as int))")
    return raw.select("file", "block", "block_end", "mid", F.octet_length("content").cast("long").alias("size"), "head_size", "length", "content",
                      _field("WARC-Type").alias("record_type"), _field("WARC-Record-ID").alias("record_id"),
                      _field("WARC-Target-URI").alias("uri"), _field("WARC-Refers-To").alias("refers_to"),
                      here.alias("payload"), base32_sha1(here).alias("payload_digest"))


def starts(narrow: DataFrame) -> DataFrame:
    """(file, block, base): where in its file each byte range's first content starts.

    A range owns the contents whose magic starts in it. Where a range ends in bytes that might have been
    the start of one, the source reads a content more than the range owns. It is told by its place, which
    the ranges before give: one short walk over a file's ranges, a few numbers for each."""
    inside = _inside(narrow).withColumn("last", F.max("mid").over(Window.partitionBy("file", "block")))
    ends = inside.groupBy("file", "block", "block_end").agg(
        F.sum(F.col("size") + len(MAGIC)).alias("n"), F.sort_array(F.collect_list(F.when(F.col("mid") == F.col("last"), F.col("inside")))).alias("tail"))

    def walk(g: pd.DataFrame) -> pd.DataFrame:
        g, at, bases = g.sort_values("block"), 0, []
        for end, n, tail in zip(g["block_end"], g["n"], g["tail"]):
            bases.append(at)
            beyond = [at + int(i) for i in tail if at + int(i) - len(MAGIC) >= end]
            at = beyond[0] if beyond else at + int(n)
        return pd.DataFrame({"file": g["file"], "block": g["block"], "base": bases})

    return ends.groupBy("file").applyInPandas(walk, "file long, block long, base long")


def _inside(found: DataFrame) -> DataFrame:
    step = F.col("size") + len(MAGIC)
    return found.withColumn("inside", F.sum(step).over(Window.partitionBy("file", "block").orderBy("mid")) - step)


def located(found: DataFrame, base: DataFrame) -> DataFrame:
    """Adds ``at``, the byte offset of each candidate's content in its file; only contents that their byte
    range owns are left."""
    placed = _inside(found).join(base, ["file", "block"]).withColumn("at", F.col("base") + F.col("inside"))
    return placed.where(F.col("at") - len(MAGIC) < F.col("block_end")).drop("base", "inside", "mid")


def on_chain(meta: DataFrame) -> DataFrame:
    """The candidates that the chain from their file's start reaches. ``meta``: file, block, at, offset,
    next (null: not a record), plain (next is the following candidate or the file's end)."""
    targets = meta.where(~F.col("plain")).select("file", F.col("next").alias("offset"), F.lit(True).alias("target")).distinct()
    near = Window.partitionBy("file", "block").orderBy("at")
    head = F.col("target") | ~F.col("plain") | ~F.coalesce(F.lag("plain").over(near), F.lit(False))
    runs = meta.join(targets, ["file", "offset"], "left").fillna(False, ["target"])
    runs = runs.withColumn("head", F.when(head, F.col("offset"))).withColumn("head", F.last("head", True).over(near))
    runs = materialize(runs, "warc-runs")
    nodes = runs.groupBy("file", F.col("head").alias("offset")).agg(F.max_by("next", "offset").alias("next"))
    nodes = materialize(nodes.withColumn("reached", F.col("offset") == 0), "warc-nodes")
    count = -1
    while (now := nodes.where("reached").count()) != count:
        count = now
        marks = nodes.where("reached and next is not null").select("file", F.col("next").alias("offset"), F.lit(True).alias("mark"))
        jumps = nodes.select("file", F.col("offset").alias("next"), F.col("next").alias("further"))
        nodes = (nodes.join(marks, ["file", "offset"], "left").join(jumps, ["file", "next"], "left")
                 .select("file", "offset", F.col("further").alias("next"), (F.col("reached") | F.coalesce("mark", F.lit(False))).alias("reached")))
        nodes = materialize(nodes.distinct(), "warc-nodes")
    kept = nodes.where("reached").select("file", F.col("offset").alias("head"))
    return runs.join(kept, ["file", "head"]).drop("head", "target")


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(file, offset, record_type, record_id, uri, refers_to, payload_bytes, payload_digest[, payload]) of
    the records on the boundary chain of each file. ``file`` is a hash of its path.

    A file that does not start with a record gives none. A chain ends at the first record that is cut
    short or whose successor is no record; what follows is not read. Magic inside payloads gives no
    records. Empty payloads have 0 bytes; an empty folder gives no rows."""
    cut = segments(spark, path)
    narrow = materialize(cut.drop("payload", "content"), "warc-segments")
    base = materialize(starts(narrow), "warc-ranges")
    found = located(cut, base)
    body = F.col("at") + F.col("head_size") + 4
    meta = located(narrow, base).where(F.col("at") >= len(MAGIC)).withColumn("offset", F.col("at") - len(MAGIC))
    meta = meta.withColumn("next", body + F.col("length") + 4).withColumn("plain", F.coalesce(F.col("next") == F.col("at") + F.col("size"), F.lit(False)))
    meta = materialize(meta, "warc-candidates")
    good = materialize(on_chain(meta).where("next is not null"), "warc-records")
    odd = good.where(~F.col("plain"))
    follow = meta.select("file", F.col("offset").alias("next"))
    ends = meta.groupBy("file").agg(F.max(F.col("at") + F.col("size")).alias("next"))
    odd = odd.join(follow.union(ends), ["file", "next"], "left_semi").select("file", "at", "head_size", "length", "next")
    long = materialize(_assembled(found, meta, odd), "warc-long") if odd.limit(1).count() else None
    fields = ["file", "offset", "record_type", "record_id", "uri", "refers_to", F.col("length").alias("payload_bytes")]
    records = good.where("plain")
    if with_payload:
        records = records.drop("payload_digest").join(found.select("file", "at", "payload", "payload_digest"), ["file", "at"])
    extra = ["payload_digest", "payload"] if with_payload else ["payload_digest"]
    out = records.select(*fields, *extra)
    if long is not None:
        out = out.unionByName(good.drop("payload_digest").join(long, ["file", "at"]).select(*fields, *extra))
    return out


def _assembled(found: DataFrame, meta: DataFrame, odd: DataFrame) -> DataFrame:
    """(file, at, payload, payload_digest) of records whose payload holds separators, put together from
    their segments. A segment finds its record by equal buckets of the file; a record is one group."""
    spans = odd.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("at") / BUCKET), F.floor(F.col("next") / BUCKET))))
    part = meta.select("file", "block", F.col("at").alias("part_at"), F.floor(F.col("at") / BUCKET).alias("bucket"))
    needed = part.join(spans, ["file", "bucket"]).where("part_at >= at and part_at < next")
    needed = materialize(needed.select("file", "block", "part_at", "at", "head_size", "length"), "warc-parts")
    blocks = needed.select("file", "block").distinct()
    texts = found.join(blocks, ["file", "block"], "left_semi").select("file", F.col("at").alias("part_at"), "content")
    rows = texts.join(needed.drop("block"), ["file", "part_at"])

    def build(g: pd.DataFrame) -> pd.DataFrame:
        g, at = g.sort_values("part_at"), int(g["at"].iloc[0])
        data = bytearray()
        for place, content in zip(g["part_at"], g["content"]):
            place = int(place) - at
            if place:
                data[place - len(MAGIC) :] = MAGIC.encode()
            data[place:] = content
        start = int(g["head_size"].iloc[0]) + 4
        return pd.DataFrame({"file": [g["file"].iloc[0]], "at": [at], "payload": [bytes(data[start : start + int(g["length"].iloc[0])])]})

    whole = rows.groupBy("file", "at").applyInPandas(build, "file long, at long, payload binary")
    return whole.withColumn("payload_digest", base32_sha1(F.col("payload")))


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with revisits given the bytes and digest of the response they refer to."""
    ends = F.col("record_type") == "revisit"
    to = records.where(~ends).select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d")).groupBy("refers_to").agg(F.max("b").alias("b"), F.max("d").alias("d"))
    return records.join(to, "refers_to", "left").select(
        "file", "offset", "record_type", "record_id", "uri", "refers_to",
        F.when(ends, F.col("b")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(ends, F.col("d")).otherwise(F.col("payload_digest")).alias("payload_digest"))


def digest(records: DataFrame) -> DataFrame:
    """The contract's columns from ``resolved`` records of ``write_archive``."""
    number = lambda c: F.expr(f"try_cast(nullif(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1), '') as bigint)")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
