import random
import re

from pyspark.sql import functions as F

from loanpanel.llm import warc


def records(spark, n, change=(), lose=(), per_file=50):
    rows = [(f, o * 100, f"{f}-{o}" + ("!" if (f, o) in change else "")) for f in range(n // per_file) for o in range(per_file) if (f, o) not in lose]
    return spark.createDataFrame(rows, "file long, offset long, sha string").repartition(3)


def test_record_round_trip(spark):
    row = spark.createDataFrame([(7, "http://x/", "<p>é\r\n\r\n</p>"), (8, None, None)], "page_id long, url string, html string")
    record = warc.record(F.col("page_id"), F.col("url"), F.col("html"))
    found = row.select(record.alias("r")).select("r", warc.payload_of(F.col("r")).alias("html")).collect()
    assert [r.html for r in found] == ["<p>é\r\n\r\n</p>", ""]
    assert "Content-Length: 13\r\n" in found[0].r


def parse(data):
    """A strict reader of WARC 1.0 records: (fields, block) of the record at the front."""
    head, rest = data.split(b"\r\n\r\n", 1)
    version, *lines = head.split(b"\r\n")
    assert version == b"WARC/1.0"
    fields = {}
    for line in lines:
        name, value = line.split(b": ", 1)
        assert re.fullmatch(rb"[A-Za-z-]+", name) and name not in fields
        fields[name.decode()] = value.decode()
    for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Target-URI"):
        assert fields[name]
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
    assert re.fullmatch(r"<urn:[^>\s]+>", fields["WARC-Record-ID"])
    size = int(fields["Content-Length"])
    assert rest[size : size + 4] == b"\r\n\r\n"
    return fields, rest[:size], rest[size + 4 :]


PAGES = [
    (1, "http://x/", "<p>é\r\n\r\n</p>"), (2, None, None), (3, "http://y/\r\nWARC-Type: fake", "x" * 70_000), (4, "", ""),
    (5, "http://z/ä", "\n\n"), *((i, f"http://h/{i}", f"<p>{i}</p>" * i) for i in range(6, 60)),
]


def archive(spark, pages=PAGES, per_file=8):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = rows.withColumn("record", warc.record(F.col("page_id"), F.col("url"), F.col("html")))
    data = F.col("record").cast("binary")
    rows = rows.select("page_id", F.sha2(data, 256).alias("sha"), F.octet_length("record").cast("long").alias("bytes"), "record")
    return warc.layout(rows, per_file, extra="record")


def test_stored_files_are_valid_records_at_their_offsets(spark, tmp_path):
    index = archive(spark)
    warc.store(index, f"{tmp_path}/a")
    data = {int(p.parent.name[5:]): p.read_bytes() for p in (tmp_path / "a").glob("file=*/*.txt")}
    places, by_id = index.collect(), {p[0]: p for p in PAGES}
    assert len(data) == len({r.file for r in places}) > 3
    for r in places:
        fields, block, rest = parse(data[r.file][r.offset :])
        assert len(data[r.file]) - r.offset - len(rest) == r.bytes
        assert fields["WARC-Record-ID"] == f"<urn:page:{r.page_id}>"
        assert block.decode() == (by_id[r.page_id][2] or "")
    for whole in data.values():  # and from front to end, without an index
        while whole:
            _, _, whole = parse(whole)


def test_audit_of_stored_bytes(spark, tmp_path):
    index = archive(spark)
    warc.store(index, f"{tmp_path}/a")
    stored = lambda: warc.stored_hashes(index.select("file", "offset", "bytes"), f"{tmp_path}/a")
    assert stored().count() == len(PAGES)
    assert warc.audit(index, stored()).count() == 0
    # one byte changes, one file loses its end, one is gone
    files = sorted((tmp_path / "a").glob("file=*/*.txt"), key=lambda p: int(p.parent.name[5:]))
    places = {}
    for r in sorted(index.collect(), key=lambda r: r.offset):
        places.setdefault(r.file, []).append(r.offset)
    (one, two, gone), names = files[:3], [int(p.parent.name[5:]) for p in files[:3]]
    for path in tmp_path.glob("a/file=*/.*.crc"):
        path.unlink()
    data = bytearray(one.read_bytes())
    data[places[names[0]][1] + 3] ^= 1
    one.write_bytes(data)
    two.write_bytes(two.read_bytes()[:-1])
    gone.unlink()
    found = {(r.file, r.offset): r.status for r in warc.audit(index, stored()).collect()}
    assert found == {
        (names[0], places[names[0]][1]): "changed",
        (names[1], places[names[1]][-1]): "missing",
        **{(names[2], o): "missing" for o in places[names[2]]},
    }


def test_nulls_and_clashing_columns_in_an_audit(spark):
    schema = "file long, offset long, sha string, status string, node long, hash string"
    rows = [(0, 0, "a", "", 0, ""), (0, 10, None, "", 0, ""), (None, 5, "x", "", 0, ""), (1, None, "y", "", 0, "")]
    one, two = spark.createDataFrame(rows, schema), spark.createDataFrame([(0, 0, "b", "", 0, ""), (0, 10, None, "", 0, "")], schema)
    assert [tuple(r) for r in warc.audit(one, two).collect()] == [(0, 0, "changed")]
    assert warc.audit(one, one).count() == 0


def test_equal_replicas(spark):
    one, two = records(spark, 600), records(spark, 600)
    assert warc.audit(one, two, range_bytes=300, fanout=2).count() == 0


def test_locates_damage(spark):
    rng = random.Random(2)
    places = [(f, o) for f in range(12) for o in range(50)]
    picked = rng.sample(places, 9)
    change, lose, extra = set(picked[:4]), set(picked[4:7]), set(picked[7:])
    one = records(spark, 600, lose=extra)
    two = records(spark, 600, change=change, lose=lose)
    found = {(r.file, r.offset // 100): r.status for r in warc.audit(one, two, range_bytes=300, fanout=2).collect()}
    assert found == {**dict.fromkeys(change, "changed"), **dict.fromkeys(lose, "missing"), **dict.fromkeys(extra, "extra")}


def test_only_ranges_with_damage(spark):
    ranges = warc.differing(records(spark, 600), records(spark, 600, change={(3, 10)}), range_bytes=300, fanout=2)
    assert [(r.file, r.node) for r in ranges.collect()] == [(3, 3)]


def test_replica_without_a_file_and_empty_ones(spark):
    one = records(spark, 200)
    two = one.where("file < 3")
    assert warc.audit(one, two).count() == 50
    assert warc.audit(one, one.limit(0)).count() == 200
    assert warc.audit(one.limit(0), one.limit(0)).count() == 0


def test_layout(spark):
    rows = [(i, f"{i:08x}" + "0" * 56, 10) for i in range(20)] + [(3, f"{3:08x}" + "0" * 56, 10)] * 5
    rows += [(None, "0" * 64, 4)]
    found = warc.layout(spark.createDataFrame(rows, "page_id long, sha string, bytes long"), per_file=6).collect()
    assert len(found) == 21
    assert {r.page_id: r.copies for r in found}[3] == 6
    for file in {r.file for r in found}:
        own = sorted((r.offset, r.bytes) for r in found if r.file == file)
        assert [o for o, _ in own] == [sum(b for _, b in own[:i]) for i in range(len(own))]
    assert warc.layout(spark.createDataFrame([], "page_id long, sha string, bytes long")).count() == 0
