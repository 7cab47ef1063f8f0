"""WARC archives: a writer that stores equal payloads once, and a reader that verifies record boundaries.

Writing: each page is a record of its own; of records with equal payloads (at
least ``min_dedup_bytes`` long) the one with the largest id is a ``response``,
the others are ``revisit`` records that name it and carry no payload.

Reading: files are cut at every place where a record could begin (the bytes
``CR LF CR LF WARC/1.``, or the file's start), however Spark splits the
file.  Each candidate names its successor's offset from its own Content-Length;
pointer jumping from the file's start keeps the candidates that are reached, so
the same bytes inside a payload begin no record, even where the payload holds a
whole archive.  Stretches in which each candidate's successor is just the next
one are jumped over as one pointer, so the rounds grow with the logarithm of
the number of places where that fails.  Offsets are shuffled, payloads are not,
but for those that were cut by such bytes.

Defined cases: a null html has an empty payload; null page ids and urls are
written as empty header values and read back as null; repeated rows are records
of their own (of equal payload and id, one is the response); an empty table
gives an empty archive, and that an empty table; a file that breaks off in a
record ends before that record; columns other than the three named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

MAGIC = "WARC/1.0\r\n"
VERSION = "WARC/1."      # of both versions read, 1.0 and 1.1
CUT = "\r\n\r\n" + VERSION
RECORDS_PER_FILE = 50_000
SALTS = 8
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 (five hex digits are four base32 digits)."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def _clean(value: Column) -> Column:
    """A header value: no line ends; null is empty."""
    return F.coalesce(F.regexp_replace(value, r"[\r\n]+", " "), F.lit(""))


def write_warc(pages: DataFrame, path: str, *, min_dedup_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as uncompressed WARC files under ``path``."""
    rows = pages.select(F.col("page_id").cast("string").alias("id"), F.col("page_id").alias("key"),
                        _clean(F.col("url")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"bytes": F.octet_length("html"), "digest": sha1_base32(F.col("html").cast("binary"))})
    # What a row is follows from its values alone, so that computing the rows again changes nothing.
    own = ["key", "id", "url", "digest", "bytes"]
    small = stage(rows.groupBy(*own).agg(F.count("*").alias("n")), "warc-digests")
    # Grouping by digest and length: one row per payload that occurs twice or more.
    shared = (small.where(F.col("bytes") >= min_dedup_bytes).groupBy("digest", "bytes")
              .agg(F.sum("n").alias("all"), F.max(F.struct("key", "url")).alias("first"))
              .where("all > 1").select("digest", "bytes", F.col("first.key").alias("first_key"),
                                       F.col("first.url").alias("first_url")))
    first = F.col("key").eqNullSafe(F.col("first_key")) & (F.col("url") == F.col("first_url"))
    marked = stage(small.join(shared, ["digest", "bytes"]).select(*own, "n", "first_key", first.alias("first"))
                   .where("not first or n > 1"), "warc-marks")
    # Joined by the whole small row: no id or payload alone gathers rows in one task.
    marks = marked.select(*[F.col(c).alias(f"_{c}") for c in own], "first", "first_key")
    joined = rows.join(marks, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in own], "left").drop(*[f"_{c}" for c in own])
    twins = marked.where("first")
    if not twins.isEmpty():         # rows repeated to the last value: one is the response
        one = joined.where("first").groupBy(*own).agg(F.first("html").alias("html"))
        more = twins.select(*own, "first_key", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))).alias("_k"))
        joined = (joined.where("first is null or not first")
                  .unionByName(one.withColumns({"first": F.lit(None).cast("boolean"), "first_key": F.lit(None).cast(
                      rows.schema["key"].dataType)}))
                  .unionByName(more.drop("_k").withColumns({"html": F.lit(""), "first": F.lit(False)})))
    revisit = F.col("first").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c, F.lit("")), F.lit(">"))
    block = F.when(revisit, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("html")))
    head = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("id"))), line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Refers-To", urn(F.col("first_key").cast("string"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    # The line end the writer adds is the record's last one.
    (joined.select(F.concat(head, block, F.lit("\r\n")).alias("value"))
     .write.option("lineSep", "\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at every possible record start: file, block (of the split), seq (in the split), data."""
    cut = spark.read.option("lineSep", CUT).text(path)
    return cut.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_size").alias("size"),
                      F.col("value").cast("binary").alias("data"))


def _parsed(segments: DataFrame) -> DataFrame:
    """What a segment says if a record begins with it; payload figures where it holds the whole record."""
    text = F.col("data").cast("string")
    head = F.substring_index(text, "\r\n\r\n", 1)
    field = lambda name: F.nullif(F.trim(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)), F.lit(""))
    kind = lambda name: F.lower(field(name))
    urn = lambda name: F.regexp_extract(field(name), r"^<urn:page:(.*)>$", 1)
    length = F.try_to_number(F.nullif(F.regexp_extract(field("Content-Length"), r"^([0-9]{1,15})$", 1), F.lit("")),
                             F.lit("9" * 15)).cast("long")
    p = segments.withColumns({"bytes": F.octet_length("data"), "head_bytes": F.octet_length(head)})
    return p.withColumns({"length": length, "type": kind("WARC-Type"), "id": urn("WARC-Record-ID"),
                          "uri": field("WARC-Target-URI"), "refers": urn("WARC-Refers-To"),
                          "digest_header": field("WARC-Payload-Digest"),
                          "opens": text.rlike(r"^WARC/1\.[01]\r\n"), "goes_on": text.rlike(r"^[01]\r\n"),
                          "http": F.coalesce(kind("Content-Type").startswith("application/http"), F.lit(False))})


def _payload(data: Column, start: Column, length: Column, http: Column) -> Column:
    """The payload of a block of ``length`` bytes at ``start`` (0-based): without the HTTP header, if there is one."""
    block = F.substring(data, (start + 1).cast("int"), length.cast("int"))
    # Latin-1 has one character for each byte, so places in it are byte places.
    gap = F.locate("\r\n\r\n", F.decode(block, "ISO-8859-1"))
    body = F.substring(block, gap + 4, F.octet_length(block))
    return F.when(http & (gap > 0), body).otherwise(block)


def _reached(spots: DataFrame) -> DataFrame:
    """Of candidates (file, offset, succ), those on the chain from each file's start.

    ``succ`` is null where a candidate is no record.  Stretches of neighbours are
    entered only at their heads: a place that its neighbour before does not name,
    or that some candidate further away names.
    """
    by_file = Window.partitionBy("file").orderBy("offset")
    spots = spots.withColumn("next", F.lead("offset").over(by_file))
    far = (spots.where(F.col("succ").isNotNull() & ~F.col("succ").eqNullSafe(F.col("next")))
           .select("file", F.col("succ").alias("offset")).distinct().withColumn("named", F.lit(True)))
    marked = spots.join(far, ["file", "offset"], "left")
    neighbour = F.lag(F.col("succ")).over(by_file).eqNullSafe(F.col("offset"))
    headed = marked.withColumn("head", F.col("named").isNotNull() | ~neighbour | (F.col("offset") == 0))
    run = stage(headed.withColumn("run", F.max(F.when(F.col("head"), F.col("offset"))).over(
        by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))), "warc-chain")
    # One pointer for each stretch: from its head to what its last member names.
    jump = run.groupBy("file", "run").agg(F.max_by("succ", "offset").alias("to"))
    jump = stage(jump.select("file", F.col("run").alias("at"), "to"), "warc-jumps")
    seen = stage(jump.where("at = 0").select("file", "at"), "warc-seen")
    found = seen.count()
    while True:
        more = (seen.join(jump, ["file", "at"]).select("file", F.col("to").alias("at")).where("at is not null")
                .join(jump.select("file", "at"), ["file", "at"], "left_semi"))
        seen = stage(seen.union(more).distinct(), "warc-seen")
        now = seen.count()
        if now == found:
            break
        found = now
        twice = jump.join(jump.select("file", F.col("at").alias("to"), F.col("to").alias("further")), ["file", "to"], "left")
        jump = stage(twice.select("file", "at", F.col("further").alias("to")), "warc-jumps")
    return run.join(seen.withColumnRenamed("at", "run"), ["file", "run"], "left_semi").select("file", "offset", "succ")


class BrokenArchive(ValueError):
    """A file's records do not follow each other up to its end."""


def read_warc(spark: SparkSession, path: str, *, payloads: bool = True, broken: str = "raise") -> DataFrame:
    """The records of all archives (WARC 1.0 or 1.1, uncompressed) under ``path``.

    Columns: file, offset, type, id, uri, refers_to, digest_header, payload
    (binary; a revisit's own, so empty), payload_bytes, payload_digest.
    ``payloads=False`` leaves the payload column out, and so the second reading
    it takes; length and digest are still those of the payloads read.
    """
    if broken not in ("raise", "keep"):
        raise ValueError(f"broken must be 'raise' or 'keep', not {broken!r}")
    packed = spark.read.format("binaryFile").load(path).select("path").where(F.col("path").rlike(r"(?i)\.(gz|zst|bz2)$")).take(1)
    if packed:
        raise ValueError(f"{packed[0]['path']} is compressed; unpack it first")
    parsed = _parsed(_segments(spark, path))
    cut, body = len(CUT), F.col("head_bytes") + 4
    payload = _payload(F.col("data"), body, F.col("length"), F.col("http"))
    alone = F.col("bytes") >= body + F.col("length")        # the segment holds the whole block
    facts = ["type", "id", "uri", "refers", "digest_header", "http", "length", "head_bytes"]
    rows = stage(parsed.select("file", "block", "seq", "bytes", "size", "opens", "goes_on", *facts,
                               F.when(alone, F.octet_length(payload).cast("long")).alias("payload_bytes"),
                               F.when(alone, sha1_base32(payload)).alias("payload_digest")), "warc-segments")
    # Places in the file: sums within a split, then over the splits' totals.
    split = Window.partitionBy("file", "block").orderBy("seq")
    placed = rows.withColumn("within", F.sum(F.col("bytes") + cut).over(split.rowsBetween(Window.unboundedPreceding, -1)))
    totals = (rows.groupBy("file", "block").agg(F.sum(F.col("bytes") + cut).alias("total")).withColumn(
        "base", F.coalesce(F.sum("total").over(Window.partitionBy("file").orderBy("block").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).select("file", "block", "base"))
    # A segment starts after the cut; its record starts with the version, the last of the cut.
    begin = F.col("base") + F.coalesce("within", F.lit(0))
    placed = placed.join(totals, ["file", "block"]).withColumn("begin", begin)
    offset = F.when(F.col("begin") == 0, F.lit(0)).otherwise(F.col("begin") - len(VERSION))
    end = F.col("begin") + body + F.col("length") + 4       # two line ends after the block
    starts = F.when(F.col("begin") == 0, F.col("opens")).otherwise(F.col("goes_on"))
    placed = stage(placed.withColumns({
        "offset": offset, "succ": F.when(starts & F.col("length").isNotNull() & (end <= F.col("size")), end)}), "warc-places")
    return _assemble(parsed, placed, facts, body, payloads, broken)


def _assemble(parsed: DataFrame, placed: DataFrame, facts: list[str], body: Column, payloads: bool, broken_files: str) -> DataFrame:
    """Keep the verified chain's records; put payloads that were cut together again."""
    chain = _reached(placed.select("file", "offset", "succ"))
    if broken_files == "raise":
        # A place reached that is no record, or a record whose end is neither a candidate nor the file's end.
        ends = placed.select("file", F.col("offset").alias("succ"), F.lit(True).alias("there"))
        size = placed.groupBy("file").agg(F.max("size").alias("size"))
        lost = (chain.join(ends, ["file", "succ"], "left").join(size, "file")
                .where(F.col("succ").isNull() | (F.col("there").isNull() & (F.col("succ") != F.col("size"))))
                .select("file", "offset").take(1))
        if lost:
            raise BrokenArchive(f"{lost[0]['file']}: no whole record follows at byte {lost[0]['offset']}")
    kept = placed.join(chain.where("succ is not null").select("file", "offset"), ["file", "offset"], "left_semi")
    whole = kept.where("payload_digest is not null")
    key = ["file", "block", "seq"]
    data = parsed.select(*key, "data")
    payload = _payload(F.col("data"), body, F.col("length"), F.col("http"))
    one = whole.join(data, key).withColumn("payload", payload) if payloads else whole
    # Cut payloads: every segment up to the record's end belongs to it, with the cut bytes between.
    broken = kept.where("payload_digest is null").select(
        "file", "offset", "begin", *facts, (F.col("begin") + body + F.col("length")).alias("stop"))
    parts = (broken.alias("r").join(placed.select("file", "begin", "block", "seq").alias("s"),
                                    (F.col("r.file") == F.col("s.file")) & (F.col("s.begin") >= F.col("r.begin"))
                                    & (F.col("s.begin") <= F.col("r.stop")))
             .select("r.*", F.col("s.begin").alias("at"), F.col("s.block").alias("block"), F.col("s.seq").alias("seq")))
    parts = stage(parts, "warc-parts")          # its size is known then, and is small unless magic bytes are common
    glued = (parts.join(data, key).groupBy("file", "offset", *facts)
             .agg(F.array_sort(F.collect_list(F.struct("at", "data"))).alias("parts"))
             .withColumn("data", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["data"])),
                                                      CUT.encode().hex().upper())))
             .withColumn("payload", payload)
             .withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                           "payload_digest": sha1_base32(F.col("payload"))}))
    out = ["file", "offset", "type", "id", "uri", F.col("refers").alias("refers_to"), "digest_header",
           *["payload"] * payloads, "payload_bytes", "payload_digest"]
    empty = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    both = one.select(*out) if parts.isEmpty() else one.select(*out).unionByName(glued.select(*out))
    return both.withColumns({"id": empty("id"), "refers_to": empty("refers_to")})


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give each revisit the payload figures of the record it refers to: that of this id and of the digest it names
    itself (several records may share an id)."""
    said = F.regexp_replace(F.col("digest_header"), "(?i)^sha1:", "")
    figures = records.where("type != 'revisit'").select(
        F.col("id").alias("refers_to"), F.col("payload_digest").alias("_said"), F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest")).dropDuplicates(["refers_to", "_said"])
    revisits = records.where("type = 'revisit'").withColumn("_said", said)
    # A payload that makes up much of the table is named by many revisits: each of them meets one of SALTS copies of its record.
    figures = figures.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("file", "offset"), F.lit(SALTS)).cast("int")
    told = (revisits.withColumn("_salt", salt).join(figures, ["refers_to", "_said", "_salt"], "left")
            .withColumns({"payload_bytes": F.coalesce("_bytes", "payload_bytes"),
                          "payload_digest": F.coalesce("_digest", "payload_digest")})
            .drop("_bytes", "_digest", "_said", "_salt"))
    return records.where("type != 'revisit'").unionByName(told.select(*records.columns))
