"""WARC archives: written from pages, read back by verified chains of record boundaries.

Writing: one record per page. Of pages with one payload the one with the largest id is a full
response; the others are revisit records that name it and carry only its HTTP header. A page
without an id never stands for others unless no page of that payload has one.

Reading: archives are split at the magic line, wherever it stands, by as many tasks as there are
file splits. Each piece is a candidate record; its header says where its successor must begin.
Only candidates on the chain that starts at byte 0 are records, and the pieces between two of
them belong to the payload of the first. Runs of candidates that follow each other are
contracted, the rest is settled by pointer jumping, which takes as many rounds as the logarithm
of the number of breaks. Offsets, not payloads, are shuffled for this.

Rows: NULL html is an empty payload, a NULL url writes no target header, line breaks and other
control characters in a url are percent-encoded. Repeated rows each have a record. An empty
table gives no record. Extra columns of ``pages`` are not read. Records behind a broken or
truncated one are not reachable and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_enough, stored

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID = "urn:x-page:"
LENGTH = r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,15})[ \t]*\r\n"
MAX_BROADCAST, MAX_FILES = 200_000, 10_000


def base32_sha1(payload: Column) -> Column:
    """Bare base-32 SHA-1: each five hexadecimal digits are four base-32 ones."""
    digest, out = F.sha1(payload), []
    for k in range(8):
        value = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substr(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _safe_url(url: Column) -> Column:
    for code in [*range(32), 127]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write ``pages(page_id, url, html)`` as WARC files below ``path``.

    Payloads shorter than ``min_bytes`` are always written in full.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("bytes", F.octet_length("html"))
    repeated = (
        rows.where(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1 AND original IS NOT NULL").drop("n")
    )
    repeated = stored(repeated, "repeated")
    if small_enough(repeated, MAX_BROADCAST):
        repeated = F.broadcast(repeated)
    joined = rows.join(repeated, "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    kind = F.when(revisit, "revisit").otherwise("response")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(GAP)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    identity = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), identity, F.lit(">"))),
        F.coalesce(line("WARC-Target-URI", _safe_url(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("html").cast("binary")))),
        F.when(
            revisit,
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
                line("WARC-Refers-To", F.concat(F.lit(f"<{ID}"), F.col("original").cast("string"), F.lit(">"))),
            ),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    joined.select(record.alias("value")).write.option("lineSep", GAP).text(path)


def _header(name: str) -> Column:
    value = F.regexp_extract("headers", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def _payload(block: Column) -> Column:
    """What follows the HTTP header, as bytes."""
    http = F.octet_length(F.substring_index(block.cast("string"), GAP, 1))
    return F.substring(block, http + len(GAP) + 1, F.octet_length(block))


def _headed(pieces: DataFrame) -> DataFrame:
    """Add ``headers``, their size ``head`` and the block ``length`` they claim, and the raw bytes."""
    return (
        pieces.withColumn("headers", F.concat(F.substring_index("value", GAP, 1), F.lit("\r\n")))
        .withColumn("head", (F.octet_length("headers") - 2 + len(GAP)).cast("long"))
        .withColumn("length", F.regexp_extract("headers", LENGTH, 1).try_cast("bigint"))
        .withColumn("raw", F.col("value").cast("binary"))
    )


def candidates(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every piece between two magic lines, with its file, split and place in the split."""
    return spark.read.option("lineSep", MAGIC).text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        F.octet_length("value").cast("long").alias("bytes"),
        "value",
    )


def _placed(pieces: DataFrame) -> DataFrame:
    """Add ``start``, the byte offset of the piece's magic line.

    Pieces of a split are added up in the split, splits in their file; a split is bounded, and
    a file has one row per split. The first piece of a file is what stands before the first
    magic line: it has no start. ``pieces`` is a stored table, so that both reads of it see the
    same splits.
    """
    length = F.col("bytes") + len(MAGIC)
    inside = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("file", "split").agg(F.sum(length).alias("size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "split", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    begun = pieces.withColumn("inside", F.coalesce(F.sum(length).over(inside), F.lit(0))).join(bases, ["file", "split"])
    start = F.col("base") + F.col("inside") - len(MAGIC)
    return begun.withColumn("start", start).drop("base", "inside").where("start >= 0")


def verified(placed: DataFrame) -> DataFrame:
    """``(file, start)`` of the candidates that the chain from byte 0 reaches.

    ``placed(file, start, next)``: where each candidate begins and where it says its successor does.
    """
    in_file = Window.partitionBy("file").orderBy("start")
    follows = F.coalesce(F.lag("next").over(in_file) == F.col("start"), F.lit(False))
    runs = placed.withColumn("broken", (~follows).cast("long")).withColumn("run", F.sum("broken").over(in_file))
    runs = stored(runs.select("file", "start", "next", "run"), "runs")
    leave = runs.groupBy("file", "run").agg(F.max_by("next", "start").alias("leave"))
    targets = leave.select("file", F.col("leave").alias("start")).distinct()
    doors = runs.join(targets, ["file", "start"], "left_semi").select("file", "start", "run")
    doors = doors.unionByName(runs.where("start = 0").select("file", "start", "run")).distinct()
    jump = doors.join(leave, ["file", "run"]).select("file", "start", F.col("leave").alias("to"))
    known = doors.select("file", F.col("start").alias("to"))
    jump = stored(jump.join(known, ["file", "to"], "left_semi").select("file", "start", "to"), "jumps")
    reached = stored(doors.where("start = 0").select("file", "start"), "reached")
    while jump.limit(1).count():
        step = jump.join(reached, ["file", "start"]).select("file", F.col("to").alias("start"))
        reached = stored(reached.unionByName(step).distinct(), "reached")
        onward = jump.select("file", F.col("start").alias("to"), F.col("to").alias("then"))
        jump = stored(jump.join(onward, ["file", "to"]).select("file", "start", F.col("then").alias("to")), "jumps")
    entry = doors.join(reached, ["file", "start"]).groupBy("file", "run").agg(F.min("start").alias("entry"))
    return runs.join(entry, ["file", "run"]).where("start >= entry").select("file", "start")


def read_archive(spark: SparkSession, path: str, derive: dict[str, Column] | None = None) -> DataFrame:
    """The records below ``path``: type, ids, target, digest, HTTP payload length, and ``derive``.

    ``derive`` maps names to expressions over ``payload`` (bytes; NULL for revisits) that are
    evaluated where a record is read, so only their values travel. The default is the payload.
    """
    derive = derive or {"payload": F.col("payload")}
    kind = _header("WARC-Type")
    number = lambda name: F.expr(f"try_cast(regexp_extract({name}, '^<{ID}(.*)>$', 1) AS BIGINT)")

    def parsed(pieces: DataFrame) -> DataFrame:
        told = pieces.withColumns(
            {"record_type": kind, "_id": _header("WARC-Record-ID"), "_to": _header("WARC-Refers-To"), "url": _header("WARC-Target-URI"),
             "payload_digest": F.replace(_header("WARC-Payload-Digest"), F.lit("sha1:"), F.lit("")),
             "_block": F.expr(f"substring(raw, CAST(head AS INT) + 1, CAST(least(length, {1 << 31} - 1) AS INT))")}
        )
        http = F.substring_index(F.col("_block").cast("string"), GAP, 1)
        size = F.regexp_extract(http, r"(?i)\r\nContent-Length:[ \t]*([0-9]{1,15})", 1)
        told = told.withColumn("payload_bytes", size.try_cast("bigint"))
        told = told.withColumn("payload", F.when(F.col("record_type") == "response", _payload(F.col("_block"))))
        return told.withColumns({"page_id": number("_id"), "refers_to": number("_to"), **derive})

    fields = list(dict.fromkeys(["record_type", "page_id", "refers_to", "url", "payload_digest", "payload_bytes", *derive]))
    pieces = parsed(_headed(candidates(spark, path))).select("file", "split", "place", "bytes", "head", "length", *fields)
    after = F.col("start") + F.col("head") + F.col("length") + len(MAGIC) + len(GAP)
    placed = stored(_placed(stored(pieces, "pieces")).withColumn("next", after), "candidates")
    real = stored(verified(placed.select("file", "start", "next")), "records")
    records = placed.join(real, ["file", "start"])
    fills = F.col("head") + F.col("length") + len(GAP) == F.col("bytes")
    whole = records.where(fills).select("file", "start", *fields)

    # a payload with the magic line in it lies in several pieces: these are put together again
    split_up = stored(records.where(~fills).select("file", "start", "next"), "split")
    files = [r.file for r in split_up.select("file").distinct().limit(MAX_FILES + 1).collect()]
    if not files:
        return whole
    again = _placed(stored(candidates(spark, files if len(files) <= MAX_FILES else path), "again"))
    opened = again.join(real.withColumn("opens", F.col("start")), ["file", "start"], "left")
    owner = F.last("opens", ignorenulls=True).over(Window.partitionBy("file").orderBy("start"))
    owned = opened.withColumn("owner", owner).select("file", "owner", "start", "value")
    parts = owned.join(split_up.select("file", F.col("start").alias("owner"), "next"), ["file", "owner"]).where("start < next")
    joined = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"))
    text = joined.select("file", F.col("owner").alias("start"), F.array_join(F.col("parts.value"), MAGIC).alias("value"))
    full = F.col("head") + F.col("length") + len(GAP) == F.octet_length("value")
    return whole.unionByName(parsed(_headed(text)).where(full).select("file", "start", *fields))
