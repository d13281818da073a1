"""WARC archives: writing with Spark's text writer, reading with boundary-chain verification.

Writing: every page becomes one record of an uncompressed archive; equal payloads
are stored once, as the response of the smallest id, and others are revisits.

Reading: the magic `WARC/1.` after a blank line may be a record's start or stand in
a payload. Spark's text reader, with the magic as its separator, deals byte ranges of the archives to tasks, whatever
a file's size; each piece between two separators that follows a blank line is a candidate, and its header's Content-Length gives its successor's offset. No end
of the magic is a beginning of it, so the reader finds every one, wherever its buffers end; blank lines, which can overlap themselves, are looked for in the pieces. Only
candidates that the chain from a file's start reaches are records. Within a range, stretches of candidates that follow each other are one link of
the chain; over the borders of ranges and past magic in payloads, pointer jumping doubles the known part of every chain each round.
A record whose payload holds the magic is put together again from its pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import drop, materialize, new_path, remove, temporary, written_bytes

DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
MAGIC = "WARC/1."
#: Bytes of the table of revisits up to which it is broadcast; a larger one is joined by a shuffle of the pages.
BROADCAST_BYTES = 64 << 20
#: Bytes of an archive in which pieces are matched with the record they belong to at once.
GRID = 1 << 24
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 40 bits are eight digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), *BASE32)


def marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, size, first_id) of every row; first_id is the smallest id of an equal payload of at least min_bytes, null where that is the row's own.

    Digests, not payloads, are shuffled unless revisits are too many to be broadcast; a payload held by a third of all rows is
    one row of the grouped side, and its rows may be split among tasks in the join.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", payload_digest(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    same = rows.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1 and first_id is not null")
    other = F.coalesce(F.col("page_id") != F.col("first_id"), F.lit(True))
    rows = rows.withColumn("mark", F.xxhash64("digest", "size"))
    copies = materialize(rows.join(same.hint("merge"), ["digest", "size"]).where(other).select("page_id", "mark", "first_id").distinct(), "warc-revisits")
    copies = F.broadcast(copies) if written_bytes(copies) <= BROADCAST_BYTES else copies.hint("merge")
    # rows of one id can differ, so the payload is a part of the key
    own = rows.alias("rows").join(copies.alias("copies"), F.expr("rows.page_id <=> copies.page_id and rows.mark = copies.mark"), "left")
    return own.select(*[F.col(f"rows.{c}") for c in ("page_id", "url", "html", "digest", "size")], "first_id")


def _uri(url: Column) -> Column:
    """A url on one header line."""
    return F.regexp_replace(url, r"[\r\n]", " ")


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write (page_id, url, html) rows as archives under `path`.

    A null html is an empty payload. A revisit has no block but the headers: the full
    payload's digest and size, and the record it refers to. Rows
    of one id are written each; all rows of a payload's smallest id are responses, as a revisit that refers to its own id would name nothing. A row with a
    null id is a revisit if a row with an id has its payload, else a response.
    The record's final blank lines are the text writer's line separator, so files
    appear through Spark's committer, on any file system Spark writes.
    """
    rows = marked(pages, min_bytes)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    revisit = F.col("first_id").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, "html"))
    common = [
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(f">{CRLF}WARC-Date: {DATE}{CRLF}WARC-Target-URI: "), _uri(F.col("url")),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"),
    ]
    refers = F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: <urn:page:"), F.col("first_id").cast("string"), F.lit(f">{CRLF}X-Payload-Length: "), F.col("size").cast("string"))).otherwise("")
    tail = [refers, F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2), block]
    record = rows.select(F.concat(*common, *tail).alias("value"))
    record.write.option("lineSep", CRLF * 2).text(path)


def candidates(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every piece of the archives under `path` between two separators: file, pos, at, stop, next, and what its header says, as if it were a record.

    pos is the magic's offset, -1 of what stands before a file's first magic, the piece's bytes are at to stop; next, null if there is no well-formed header after a blank line, is the successor's offset by the header. A response's digest and size are
    computed anew if its bytes are all in the piece (`whole`); a revisit's are those its header states. `payload` is there if asked for, null
    for revisits. Offsets are sums of what ranges hold: a range's narrow rows are summed in its group, ranges of a file in theirs.
    """
    found = materialize(_pieces(spark, path, payloads), "warc-pieces")
    inside = Window.partitionBy("file", "range").orderBy("nth")
    length = F.col("bytes") + len(MAGIC)
    # what ranges before hold, and whether the piece before a range's first ends with a blank line
    ranges = Window.partitionBy("file").orderBy("range")
    sums = found.groupBy("file", "range").agg(F.sum(length).alias("sum"), F.max_by("blank", "nth").alias("last"))
    sums = sums.select("file", "range", (F.sum("sum").over(ranges) - F.col("sum")).alias("before"), F.lag("last").over(ranges).alias("last"))
    placed = found.join(sums.hint("merge"), ["file", "range"]).withColumn("at", F.col("before") + F.sum(length).over(inside) - length)
    placed = placed.withColumn("after", F.coalesce(F.lag("blank").over(inside), F.col("last"), F.lit(False)))
    well = (F.col("after") | (F.col("at") == len(MAGIC))) & F.col("opens") & F.col("block").isNotNull()
    end = F.col("at") + F.col("head") + F.col("block") + 4
    columns = ["kind", "record_id", "refers_to", "digest", "payload_bytes", "whole", *["payload"] * payloads]
    placed = placed.select(
        "file", "range", "nth", "mark", "at", (F.col("at") + F.col("bytes")).alias("stop"), F.greatest(F.col("at") - len(MAGIC), F.lit(-1)).cast("long").alias("pos"), F.when(well, end).alias("next"), "head", "block", *columns
    )
    out = materialize(placed, "warc-candidates")
    drop(found)
    return out


def _pieces(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """(file, range, nth, mark, bytes, blank, opens, head, block, and what the header says) of each piece; range is where its byte range starts, nth its order there, blank whether it ends with a blank line."""
    rows = spark.read.option("lineSep", MAGIC).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))
    rows = rows.withColumn("nth", F.monotonically_increasing_id())
    # functions of strings that find ASCII, and substrings of the bytes: pieces need not be valid UTF-8
    header = F.substring_index("value", CRLF * 2, 1)
    raw = F.col("value").cast("binary")
    field = lambda name: F.regexp_extract("header", rf"(?is)\n{name}[ \t]*:[ \t]*([^\r\n]*?)[ \t]*(?:\r\n|\z)", 1)
    number = lambda c: F.when(c.rlike(r"\A\d{1,18}\z"), c).cast("long")
    rows = rows.withColumn("header", header).withColumns({"head": F.octet_length("header").cast("long") + 4, "bytes": F.octet_length("value").cast("long"), "block": number(field("content-length")), "kind": field("warc-type")})
    rows = rows.withColumn("whole", F.coalesce(F.col("head") + F.col("block") <= F.col("bytes"), F.lit(False)))
    payload = F.when(F.col("whole") & (F.col("kind") == "response"), _payload(raw, F.col("head"), F.col("block")))
    rows = rows.withColumn("payload", payload)
    none = F.lit(None).cast("string")
    stated = F.regexp_replace(field("warc-payload-digest"), "^sha1:", "")
    return rows.select(
        "file", "range", "nth", F.xxhash64("value").alias("mark"), "bytes", (F.substring(raw, -4, 4) == F.lit(b"\r\n\r\n")).alias("blank"), F.col("value").rlike(r"\A[01]\r\n").alias("opens"), "head", "block",
        *[F.when(c != "", c).otherwise(none).alias(n) for n, c in (("kind", F.col("kind")), ("record_id", field("warc-record-id")), ("refers_to", field("warc-refers-to")))],
        F.when(F.col("payload").isNotNull(), payload_digest(F.col("payload"))).otherwise(stated).alias("digest"),
        F.when(F.col("payload").isNotNull(), F.octet_length("payload").cast("long")).otherwise(F.coalesce(number(field("x-payload-length")), F.lit(0))).alias("payload_bytes"),
        "whole", *["payload"] * payloads,
    )


def _payload(raw: Column, head: Column, block: Column) -> Column:
    """What follows the HTTP header in a record's block; empty if there is no end of one."""
    content = F.substring(raw, (head + 1).cast("int"), block.cast("int"))
    http = F.octet_length(F.substring_index(content.cast("string"), CRLF * 2, 1))
    return F.substring(content, http + 5, F.greatest(block.cast("int") - http - 4, F.lit(0)))


def reachable(chain: DataFrame) -> DataFrame:
    """The rows (file, range, pos, next) that their file's start, offset 0, reaches.

    A stretch of rows in one range, each the successor of the one before, is one link: what reaches its first row
    reaches all. Stretches also begin where a successor out of turn leads. Links of many ranges are joined by pointer jumping: after round k the known
    set holds the first 2^k links of every chain, and each link's `jump` leads 2^k links on. A file that
    does not begin with a record, or whose chain breaks, keeps what its start reaches.
    """
    order = Window.partitionBy("file", "range").orderBy("pos")
    rows = chain.where("next is not null").select("file", "range", "pos", "next")
    rows = rows.withColumn("follows", F.coalesce(F.lag("next").over(order) == F.col("pos"), F.lit(False))).withColumn("last", F.coalesce(F.lead("pos").over(order) != F.col("next"), F.lit(True)))
    rows = materialize(rows, "warc-rows")
    targets = rows.where("last").select("file", F.col("next").alias("pos")).distinct().withColumn("led_to", F.lit(True))
    begins = F.col("led_to").isNotNull() | ~F.col("follows")
    rows = materialize(rows.join(targets.hint("merge"), ["file", "pos"], "left").withColumn("stretch", F.max(F.when(begins, F.col("pos"))).over(order)).select("file", "range", "pos", "next", "stretch"), "warc-stretches")
    jumps = materialize(rows.groupBy("file", F.col("stretch").alias("pos")).agg(F.max("next").alias("jump")), "warc-jumps")
    known = materialize(jumps.where("pos = 0").select("file", "pos"), "warc-known")
    n = known.count()
    while n:
        landed = known.join(jumps.hint("merge"), ["file", "pos"]).select("file", F.col("jump").alias("pos"))
        # a jump must land on a link
        landed = landed.join(jumps.select("file", "pos").hint("merge"), ["file", "pos"], "left_semi")
        more = materialize(known.unionByName(landed).distinct(), "warc-known")
        m = more.count()
        drop(known)
        known = more
        if m == n:
            break
        n = m
        ahead = jumps.select("file", F.col("pos").alias("jump"), F.col("jump").alias("far"))
        longer = materialize(jumps.join(ahead.hint("merge"), ["file", "jump"], "left").select("file", "pos", F.coalesce("far", F.lit(-1)).cast("long").alias("jump")), "warc-jumps")
        drop(jumps)
        jumps = longer
    return rows.join(known.withColumnRenamed("pos", "stretch").hint("merge"), ["file", "stretch"], "left_semi").select("file", "pos", "next")


def _mended(spark: SparkSession, path: str, chain: DataFrame, true: DataFrame) -> DataFrame:
    """(file, pos, payload) of the records in `true` that are responses in several pieces, read again and joined.

    Within each GRID bytes of a file, a piece that is no record belongs to the record before it. Only these pieces are fetched.
    """
    grid = lambda c: F.floor(c / GRID)
    broken = true.where("not whole").select("file", "pos", "next", "at", "head", "block")
    cells = broken.withColumn("cell", F.explode(F.sequence(grid(F.col("pos")), grid(F.col("next") - 1))))
    starts = cells.select("file", "cell", F.greatest("pos", F.col("cell") * GRID).alias("place"), F.lit(0).alias("is_piece"), F.struct("pos", "next").alias("owner"), *[F.lit(None).cast("long").alias(c) for c in ("range", "mark", "stop")])
    own = chain.select("file", grid(F.col("pos")).alias("cell"), F.col("pos").alias("place"), F.lit(1).alias("is_piece"), F.lit(None).cast("struct<pos: bigint, next: bigint>").alias("owner"), "range", "mark", "stop")
    order = Window.partitionBy("file", "cell").orderBy("place", "is_piece").rowsBetween(Window.unboundedPreceding, 0)
    parts = starts.unionByName(own).withColumn("owner", F.last("owner", ignorenulls=True).over(order)).where("is_piece = 1 and place < owner.next")
    parts = materialize(parts.select("file", "range", "mark", "place", F.col("owner.pos").alias("pos")), "warc-parts")
    bytes_of = spark.read.option("lineSep", MAGIC).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))
    bytes_of = bytes_of.withColumn("mark", F.xxhash64("value")).join(parts.select("file", "range", "mark").distinct().hint("merge"), ["file", "range", "mark"], "left_semi").dropDuplicates(["file", "range", "mark"])
    whole = parts.join(bytes_of.hint("merge"), ["file", "range", "mark"]).groupBy("file", "pos").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("parts"))
    whole = whole.join(broken.select("file", "pos", "head", "block").hint("merge"), ["file", "pos"])
    return whole.select("file", "pos", _payload(F.array_join(F.col("parts.value"), MAGIC).cast("binary"), F.col("head"), F.col("block")).alias("mended"))


def read(spark: SparkSession, path: str, payloads: bool = True, broken: str = "raise") -> DataFrame:
    """The records of all archives under `path`: file, pos, next, kind, record_id, refers_to, digest, payload_bytes and, if asked for, payload.

    Files may have any size and lie wherever Spark reads text. A file whose chain of records does not reach its end raises ValueError; with
    `broken="keep"` it gives the complete records that its start reaches. An empty file has no record. A record of more than 2 GB is beyond a row of Spark.
    """
    if broken not in ("raise", "keep"):
        raise ValueError(f"broken is {broken!r}, not raise or keep")
    chain = candidates(spark, path, payloads)
    ends = chain.groupBy("file").agg(F.max("stop").alias("file_end"))
    reached = materialize(reachable(chain), "warc-reached")
    if broken == "raise":
        last = reached.groupBy("file").agg(F.max("next").alias("last"))
        cut = ends.join(last, "file", "left").where("last is null or last <> file_end").select("file").limit(5).collect()
        if cut:
            raise ValueError(f"the records do not reach the end of {', '.join(r['file'] for r in cut)}")
    true = chain.join(reached.select("file", "pos").hint("merge"), ["file", "pos"], "left_semi")
    # what the header announces must be there
    true = true.join(ends.hint("merge"), "file").where(F.col("next") <= F.col("file_end"))
    if not true.where("not whole").isEmpty():
        mended = materialize(_mended(spark, path, chain, true), "warc-mended")
        true = true.join(mended.hint("merge"), ["file", "pos"], "left")
        again = (F.col("kind") == "response") & F.col("mended").isNotNull()
        new = {"digest": payload_digest(F.col("mended")), "payload_bytes": F.octet_length("mended").cast("long"), **({"payload": F.col("mended")} if payloads else {})}
        true = true.withColumns({c: F.when(again, v).otherwise(F.col(c)) for c, v in new.items()})
    return true.select("file", "pos", "next", "kind", "record_id", "refers_to", "digest", "payload_bytes", *["payload"] * payloads)


def round_trip(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write pages to archives and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to) of each record.

    Without a path the archives go again once they are read.
    """
    spark = pages.sparkSession
    place = path or new_path(spark, "warc")
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    known = lambda c: F.when(number(c) != "", number(c)).cast("long")
    with temporary():
        write(pages, place, min_bytes)
        found = read(spark, place, payloads=False).select(known("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), known("refers_to").alias("refers_to"))
        out = materialize(found, "warc-result", keep=True)
    if path is None:
        remove(spark, place)
    return out
