"""WARC records and a Merkle fixity audit of archive replicas.

Pages become resource records, laid out one behind the other in archive files. An audit
hashes each replica's records, hashes ordered offset ranges of each file from them, and
joins FANOUT neighbours to a node until one root is left. Two replicas with equal roots
are equal; else only the children of nodes that differ are compared, level by level, and
only the records of ranges that differ are held side by side.

`store` writes the files, and `stored_hashes` hashes the bytes that stand in them at the
index's places, for an audit of what is really there. In the audit itself only hashes move
between tasks, never payloads. A node has a bounded number of children
at every level, so a large host or file is no large group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.llm.common import settled

#: Records in an archive file, bytes in a range, children of a node.
RECORDS_PER_FILE, RANGE_BYTES, FANOUT = 4096, 1 << 18, 16
#: The date of records whose time of capture is not known.
CAPTURED = "1970-01-01T00:00:00Z"


def record(key: Column, url: Column, payload: Column, date: Column | None = None) -> Column:
    """A page as a WARC 1.0 resource record.

    A null payload counts as empty, a null or empty address as the record's own name; line
    ends in an address are percent-encoded, so that no address adds fields. `date` is the
    time of capture as UTC text (2024-01-31T00:00:00Z); CAPTURED where none is known.
    """
    body = F.coalesce(payload, F.lit(""))
    name = F.concat(F.lit("urn:page:"), F.coalesce(key.cast("string"), F.lit("")))
    plain = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = {
        "WARC-Type": F.lit("resource"),
        "WARC-Record-ID": F.concat(F.lit("<"), name, F.lit(">")),
        "WARC-Date": F.lit(CAPTURED) if date is None else F.coalesce(date, F.lit(CAPTURED)),
        "WARC-Target-URI": F.when(plain != "", plain).otherwise(name),
        "Content-Type": F.lit("text/html"),
        "Content-Length": F.octet_length(body).cast("string"),
    }
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in fields.items()]
    return F.concat(F.lit("WARC/1.0\r\n"), *lines, F.lit("\r\n"), body, F.lit("\r\n\r\n"))


def payload_of(text: Column) -> Column:
    """The payload of a record: the inverse of `record` for its body."""
    head = F.instr(text, "\r\n\r\n") + 4
    return F.substring(text, head, F.length(text) - head - 3)


def layout(records: DataFrame, per_file: int = RECORDS_PER_FILE, extra: str | None = None) -> DataFrame:
    """page_id, sha, bytes -> one row per different record: page_id, copies, file, offset,
    bytes, sha, and `extra`, a column that the record determines.

    Files are named by a hash of the record, so they hold about `per_file` different
    records each, whatever the key; records stand in order of page_id and sha. Repeated
    rows are one record with their count in `copies`, stored once.
    """
    more = [extra] if extra else []
    once = settled(records.groupBy("page_id", "sha", "bytes", *more).agg(F.count("*").alias("copies")))
    files = max(1, math.ceil(once.count() / per_file))
    file = F.conv(F.substring("sha", 1, 8), 16, 10).cast("long") % files
    order = Window.partitionBy("file").orderBy("page_id", "sha").rowsBetween(Window.unboundedPreceding, -1)
    return once.withColumn("file", file).select(
        "page_id", "copies", "file", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("offset"), "bytes", "sha", *more
    )


def store(records: DataFrame, folder: str) -> None:
    """Writes archive files: file, offset, record (text) of every place of an index, once
    each. One task writes a file, its records in order of offset, byte for byte."""
    # a record ends with the line end that the writer puts behind every row
    body = F.expr("left(record, length(record) - 1)").alias("value")
    dealt = records.repartition("file").sortWithinPartitions("file", "offset")
    dealt.select("file", body).write.partitionBy("file").option("lineSep", "\n").text(folder)


def stored_hashes(index: DataFrame, folder: str) -> DataFrame:
    """file, offset, sha of the bytes in the folder's files at the places (file, offset,
    bytes) of an index; a place that a file does not reach, or whose file is not there, has
    no row. A file is read by one task, once."""
    spark = index.sparkSession
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    number = F.regexp_extract("path", r"/file=(\d+)/[^/]*$", 1).cast("long")
    place = F.struct(F.col("offset").cast("long").alias("offset"), F.col("bytes").cast("long").alias("bytes"))
    places = index.groupBy("file").agg(F.collect_set(place).alias("places"))
    reached = F.filter("places", lambda p: p["offset"] + p["bytes"] <= F.octet_length("content"))

    def hashed(p: Column) -> Column:
        own = F.substring(F.col("content"), (p["offset"] + 1).cast("int"), p["bytes"].cast("int"))
        return F.struct(p["offset"].alias("offset"), F.sha2(own, 256).alias("sha"))

    found = files.select(number.alias("file"), "content").join(places, "file")
    return found.select("file", F.inline(F.transform(reached, hashed)))


def leaves_of(records: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, offset, sha -> file, node (the offset range) and hash. Records at the same
    place count in order of their hash."""
    own = F.concat_ws(":", F.col("offset").cast("string"), "sha")
    at = F.struct(F.col("offset"), F.col("sha"), own.alias("own"))
    return settled(
        records.groupBy("file", F.floor(F.col("offset") / range_bytes).alias("node")).agg(
            _hashed(F.collect_list(at)).alias("hash")
        )
    )


def tree(leaves: DataFrame, ranges: int, files: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels over `leaves`, from them to the root: frames of file, node, hash, and of
    up_file and up_node, the parent. Above the files, file is -1 and node counts groups of
    files. `ranges` (of the longest file) and `files` bound the tree's height, so replicas
    given the same bounds have trees of the same shape."""
    found, level = [], leaves
    while True:
        if ranges > 1:
            up_file, up_node = F.col("file"), F.floor(F.col("node") / fanout)
            ranges = math.ceil(ranges / fanout)
        else:
            place = F.when(F.col("file") < 0, F.col("node")).otherwise(F.col("file"))
            up_file, up_node = F.lit(-1), F.floor(place / fanout)
            files = 0 if files <= 1 else math.ceil(files / fanout)
        level = level.select(
            "file", "node", "hash", up_file.cast("long").alias("up_file"), up_node.cast("long").alias("up_node")
        )
        found.append(level)
        if files == 0:
            return found
        child = F.struct("file", "node", F.concat_ws(":", "file", "node", "hash").alias("own"))
        level = level.groupBy(F.col("up_file").alias("file"), F.col("up_node").alias("node")).agg(
            _hashed(F.collect_list(child)).alias("hash")
        )


def _hashed(items: Column) -> Column:
    parts = F.transform(F.sort_array(items), lambda x: x["own"])
    return F.sha2(F.array_join(parts, "\n").cast("binary"), 256)


def _placed(replica: DataFrame) -> DataFrame:
    rows = replica.where("file IS NOT NULL AND offset IS NOT NULL")
    return rows.select("file", "offset", F.coalesce("sha", F.lit("")).alias("sha"))


def differing(one: DataFrame, two: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """file and node of the offset ranges in which two replicas (file, offset, sha)
    differ: from the root down, only children of nodes that differ are compared.

    An empty replica differs in every range of the other, and two empty ones in none. Rows
    with a null file or offset take no part; a null hash counts as an empty one."""
    one, two = (_placed(x) for x in (one, two))
    both = [leaves_of(one, range_bytes), leaves_of(two, range_bytes)]
    widths = [x.agg(F.max("node"), F.max("file")).first() for x in both]
    ranges, files = (max((w[i] or 0) for w in widths) + 1 for i in range(2))
    wrong: DataFrame | None = None
    ours, theirs = (tree(x, ranges, files, fanout) for x in both)
    for mine, other in zip(ours[::-1], theirs[::-1], strict=True):
        if wrong is not None:
            above = wrong.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
            mine, other = (x.join(above, ["up_file", "up_node"], "left_semi") for x in (mine, other))
        a = mine.select("file", "node", F.col("hash").alias("a"))
        b = other.select("file", "node", F.col("hash").alias("b"))
        pairs = a.join(b, ["file", "node"], "full_outer")
        wrong = settled(pairs.where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node"))
    return wrong


def audit(one: DataFrame, two: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """file, offset, status of every record that two replicas do not share: changed,
    missing (in the second) or extra (only there). Each replica has one row per place. Nulls
    and empty replicas as in `differing`."""
    one, two = (_placed(x) for x in (one, two))
    ranges = differing(one, two, range_bytes, fanout).select(F.col("file").alias("rf"), F.col("node").alias("rn"))
    here = (F.col("file") == F.col("rf")) & (F.floor(F.col("offset") / range_bytes) == F.col("rn"))
    a = one.join(ranges, here, "left_semi").select("file", "offset", F.col("sha").alias("a"))
    b = two.join(ranges, here, "left_semi").select("file", "offset", F.col("sha").alias("b"))
    status = (
        F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") != F.col("b"), "changed")
    )
    return a.join(b, ["file", "offset"], "full_outer").select("file", "offset", status.alias("status")).where("status IS NOT NULL")
