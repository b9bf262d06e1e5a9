import hashlib
import io
import os
import random

import pytest
import zstandard
from pyspark.sql import types as T

from oracle_check import check, duck
from tallyward.llm import warc as W
from tallyward.llm.queries import ORACLE_SQL, op12_warc

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType()), ("payload", T.StringType()), ("digest", T.StringType()), ("first", T.StringType()))])
LONG = "a page of more than a hundred bytes " * 4


def odd_pages():
    rnd = random.Random(2)
    pages = [(i, f"http://h{i % 3}/{i}", f"<html>{i} {rnd.random()} " + "word " * rnd.randrange(200)) for i in range(60)]
    pages += [(100 + i, "http://copies/", LONG) for i in range(30)] + [(90, "http://copies/first", LONG), (90, "http://copies/first", LONG), (None, "http://copies/", LONG)]
    pages += [(200 + i, None, "short") for i in range(5)] + [(300, "http://n", None), (301, "http://n", ""), (302, "http://x/\r\nWARC-Type: info ü", "ü中" * 50), (303, "u", "z" * 3_000_000)]
    pages += [(None, None, "no id " * 40)] * 2 + [(400, "http://copies/", LONG + "é"), (401, "http://copies/", LONG + "é")]
    return pages + [(500, "u", "a" * 200 + "P*M\x18\x00\x00\x00\x00" * 3 + "\r\n\r\nWARC/1.1"), (501, "u", "P*M\x18\x00\x00\x00\x00P*M\x18\x00\x00\x00\x00")]


def slow(pages):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) by plain loops."""
    rows, first = [], {}
    for page_id, _, html in pages:
        payload = (html or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        rows.append((page_id, len(payload), digest))
        if len(payload) >= 100 and page_id is not None:
            first[digest] = min(page_id, first.get(digest, page_id))
    out = []
    for page_id, size, digest in rows:
        to = first.get(digest) if size >= 100 else None
        out.append((page_id, size, digest, "response" if to in (None, page_id) else "revisit", None if to == page_id else to))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*p, "x", "y", "z") for p in odd_pages()], SCHEMA).repartition(6)


@pytest.fixture(scope="module")
def archive(spark, frame):
    from tallyward.session import fresh_dir

    path = fresh_dir(spark, "warc-test")
    W.write_warc(frame, path)
    return path


def files(path):
    path = path.removeprefix("file:")
    return [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part-")]


def test_records_are_those_of_plain_loops(spark, archive):
    key = lambda r: tuple(map(str, r))
    rows = W.read_warc(spark, archive).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=key) == sorted(slow(odd_pages()), key=key)
    texts = {(p, (h or "").encode()) for p, _, h in odd_pages()}
    assert all((r.page_id, bytes(r.payload)) in texts for r in rows if r.record_type == "response")
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert W.broken_revisits(W.read_warc(spark, archive, payloads=False)).isEmpty()
    one = [r for r in rows if r.page_id == 302]
    assert one[0].url == "http://x/%0D%0AWARC-Type:%20info%20ü"


def test_files_are_streams_of_frames_with_their_dictionary(archive):
    """A plain Zstandard reader, with the dictionary from a file's own first frame."""
    n = 0
    for name in files(archive):
        data = open(name, "rb").read()
        assert data.startswith(W.DICTIONARY_MAGIC)
        dictionary = zstandard.ZstdCompressionDict(W.dictionary_of(data))
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(data), read_across_frames=True)
        text = reader.read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        n += text.count(b"\r\nWARC-Type: response\r\n") + text.count(b"\r\nWARC-Type: revisit\r\n")
        for line in data.split(W.LINE_END):
            if line.startswith(W.FRAME_MAGIC):
                assert zstandard.get_frame_parameters(line).dict_id == dictionary.dict_id()
    assert n == len(odd_pages())


def test_large_files_are_read_in_splits(spark, archive):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert W.read_warc(spark, archive, payloads=False).count() == len(odd_pages())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_hot_payloads_and_others_are_labelled_alike(spark, frame, monkeypatch):
    rows = W._pages(frame, "page_id", "url", "html")
    pick = lambda df: sorted(map(str, df.select("page_id", "digest", "size", "refers_to").collect()))
    expected = pick(W.with_first(rows, 100))
    for share in (0, 3, 10**9):
        monkeypatch.setattr(W, "HOT_SHARE", share)
        assert pick(W.with_first(rows, 100)) == expected
    monkeypatch.setattr(W, "HOT_SHARE", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert pick(W.with_first(rows, 100)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_dictionary_makes_small_records_smaller():
    records = [W.page_record(i, f"http://host/{i}", b"<html><head><title>t</title></head> %d" % i, 40, "0" * 64, None, False) for i in range(400)]
    dictionary = W.build_dictionary(records)
    assert len(W.Frames(dictionary).frame(records[3])) < 0.6 * len(W.Frames(b"").frame(records[3]))
    assert W.dictionary_of(W.dictionary_frame(dictionary)) == dictionary


def test_wrong_bytes_and_missing_responses_are_found(spark):
    record = W.page_record(1, "u", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None, False)
    assert W.read_page(record)[0] == 1
    with pytest.raises(ValueError):
        W.read_page(record.replace(b"payload", b"Payload"))
    with pytest.raises(ValueError):
        W.parse_record(record[:-6])
    rows = [("response", "a", None, "d", 1), ("revisit", "b", "a", "d", 1), ("revisit", "c", "x", "d", 1)]
    records = spark.createDataFrame(rows, "record_type string, record_id string, refers_to_id string, payload_digest string, payload_bytes long")
    assert [r.refers_to_id for r in W.broken_revisits(records).collect()] == ["x"]


def test_empty_table_and_one_row(spark):
    assert W.archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.payload_bytes for r in W.archive_pages(spark.createDataFrame([(1, "u", "h", "", "", "")], SCHEMA)).collect()] == [1]


def test_query_equals_its_sql(spark):
    ok = check(spark, duck(SF), SF, "op12", op12_warc, ORACLE_SQL["op12_warc"])
    assert ok[0], ok
