"""Archives as an exact round trip, by the index and by ordinary readers."""

import glob
import gzip
import hashlib
import random

import pytest

from targetlens.llm.warc import RecordReader, archived, inflated, member, members_of, normalise

SCHEMA = "page_id long, url string, html string, archive string"
BIG = "<p>é\r\n\r\nWARC/1.1\r\n" + "x" * 1_200
PAGES = [
    (1, "http://a/1", "<p>small</p>"), (2, "http://a/2", "<p>small</p>"), (3, None, BIG), (4, "u", BIG),
    (9, "u\r\nX: y", BIG), (5, "u", None), (6, "u", ""), (None, "u", BIG), (None, "n", "alone" * 300),
    (8, "u", "y" * 999), (10, "u", "y" * 999), (11, "u", "z" * 3_000_000), (9, "twice", BIG),
]


def expected():
    found = []
    for key, _, html in PAGES:
        data = (html or "").encode()
        keepers = [k for k, _, h in PAGES if h == html and k is not None]
        keeper = max(keepers, default=None) if len(data) >= 1_000 else None
        revisit = keeper is not None and key != keeper
        found.append(
            (key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
             keeper if revisit else None)
        )
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc"))
    df = spark.createDataFrame([(*row, "x") for row in PAGES], SCHEMA).repartition(3)
    return archived(df, folder + "/out"), folder + "/out"


def test_read_back(archive):
    index, _ = archive
    rows = index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, rows.collect()), key=repr) == expected()


def test_each_record_is_a_member_at_its_offset(archive):
    index, folder = archive
    payloads = {(k, (h or "").encode()) for k, _, h in PAGES}
    for row in index.collect():
        with open(row.archive.removeprefix("file:"), "rb") as file:
            file.seek(row.offset)
            data = gzip.decompress(file.read(row.length))
        (record,) = RecordReader().feed(data)
        if row.record_type == "response":
            assert (row.page_id, record.body) in payloads
        else:
            assert record.body == b"" and record.headers["warc-type"] == "revisit"


def test_monolithic_archives_are_one_member_with_the_same_records(archive):
    _, folder = archive
    whole, split = [], []
    for path in glob.glob(f"{folder}/monolithic/*.gz"):
        data = open(path, "rb").read()
        whole += [r.raw for r in RecordReader().feed(gzip.decompress(data))]
    for path in glob.glob(f"{folder}/records/*/part-*"):
        split += [r.raw for r in RecordReader().feed(gzip.decompress(open(path, "rb").read()))]
    assert len(whole) == len(PAGES) and sorted(whole) == sorted(split)


def test_index_is_written(spark, archive):
    index, folder = archive
    assert spark.read.parquet(f"{folder}/index").count() == index.count() == len(PAGES)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert archived(df).collect() == []


def test_streams_in_any_parts():
    rng = random.Random(1)
    records = [f"WARC/1.1\r\nContent-Length: {n}\r\n\r\n".encode() + bytes(rng.choices(b"\r\nab", k=n)) + b"\r\n\r\n"
               for n in [0, 1, 70_000, 5, 300]]
    data = b"".join(records[:2]) + b"".join(records[2:])
    packed = member(data[:100]) + member(b"") + member(data[100:])
    chunks = [packed[i : i + 7] for i in range(0, len(packed), 7)]
    reader, found = RecordReader(), []
    for part in inflated(iter(chunks)):
        found += [r.raw for r in reader.feed(part)]
    assert found == records
    split = b"".join(member(r) + member(b"") for r in records)
    assert [r.raw for *_, r in members_of(split)] == records


@pytest.mark.parametrize("kept", [0.3, 0.871, -1])
def test_archives_that_are_cut_off_are_an_error(spark, tmp_path, kept):
    records = [f"WARC/1.1\r\nContent-Length: {n}\r\n\r\n".encode() + b"x" * n + b"\r\n\r\n"
               for n in range(50, 90)]
    whole = gzip.compress(b"".join(records), mtime=0)
    cut = whole[: int(kept * len(whole)) if kept > 0 else kept]
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "one.warc.gz").write_bytes(cut)
    with pytest.raises(Exception, match="cut off"):
        normalise(spark, str(tmp_path / "source"), str(tmp_path / "target"))
    members = b"".join(map(member, records))
    with pytest.raises(ValueError, match="cut off"):
        list(members_of(members[: int(kept * len(members)) if kept > 0 else kept]))


def test_a_record_that_is_cut_off_within_a_whole_stream_is_an_error(spark, tmp_path):
    record = b"WARC/1.1\r\nContent-Length: 9\r\n\r\n123456789\r\n\r\n"
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "one.warc.gz").write_bytes(gzip.compress(record + record[:-6]))
    with pytest.raises(Exception, match="cut off"):
        normalise(spark, str(tmp_path / "source"), str(tmp_path / "target"))
    with pytest.raises(ValueError, match="cut off"):
        list(members_of(member(record) + member(record[:-6])))
