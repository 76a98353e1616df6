import base64
import hashlib
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from jobloom.llm import archive

SCHEMA = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def plain(rows):
    out = []
    for key, _, html in rows:
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        first = min(same, default=None)
        revisit = first is not None and key != first
        out.append((key, len((html or "").encode()), digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def odd_pages():
    r = random.Random(1)
    texts = [None, "", "a", "é\r\n\r\nWARC/1.1\r\n", "x" * 700_000, "<p>Ü</p>", "same"] + ["".join(r.choice("ab\r\n: é") for _ in range(r.randrange(400))) for _ in range(150)]
    rows = [(k, f"http://h.example/é a%20b?{k}\r\n" if k % 3 else None, r.choice(texts)) for k in range(400)]
    r.shuffle(rows)
    return rows + [rows[0], (rows[1][0], "other", rows[1][2]), (None, "u", "same"), (None, None, "alone"), (None, None, "alone"), (1000, "u", "same")]


def found(rows):
    return sorted([tuple(r) for r in rows], key=repr)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(archive, "FRAME_BYTES", 3000)
    monkeypatch.setattr(archive, "BUNDLE_BYTES", 5000)


@pytest.mark.parametrize("sent", [archive.MOST_SENT, 0])
def test_result_equals_loops(spark, small, monkeypatch, sent):
    monkeypatch.setattr(archive, "MOST_SENT", sent)
    rows = odd_pages()
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("x"), "payload": F.lit(1), "original": F.lit(2), "sha1": F.lit(3)})
    assert found(archive.archive_pages(pages.repartition(3)).collect()) == plain(rows)


def test_round_trip_index_and_any_reader(spark, small):
    rows = odd_pages()
    bundles = spark.createDataFrame(archive.write_records(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect(), archive.BUNDLES)
    records = archive.read_records(bundles).collect()
    assert len(records) == len(rows)
    whole = {(r["key"], r["payload_digest"]): bytes(r["payload"]) for r in records if r["record_type"] == "response"}
    by_id = {r["record_id"]: r for r in records}
    back = []
    for r in records:  # a revisit's payload is that of the record it names
        holder = r if r["record_type"] == "response" else by_id[r["refers_to_id"]]
        payload = whole[holder["key"], holder["payload_digest"]]
        assert len(payload) == r["payload_bytes"] and digest(payload.decode()) == r["payload_digest"]
        back.append((None if r["key"] is None else int(r["key"]), r["url"], payload.decode()))
    assert sorted(back, key=repr) == sorted([(k, u, h or "") for k, u, h in rows], key=repr)

    asked = archive.index(bundles).where("length < 600").select("record_id")
    got = archive.find_records(bundles, asked.union(asked)).drop("payload").collect()
    wanted = {r["record_id"] for r in asked.collect()}
    assert found(got) == found([r for r in archive.read_records(bundles).drop("payload").collect() if r["record_id"] in wanted])

    for row in bundles.collect():  # a reader that knows no seek table, and places in the plain frames
        content = bytes(row["content"])
        stream = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
        frames = [archive.frame(content, place) for place in archive.frames_of(content)]
        assert b"".join(frames) == stream
        assert [len(f) for f in frames] == [size for *_, size in archive.frames_of(content)]
        for r in row["records"]:
            fields, *_, stop = archive.parse_record(frames[r["frame"]], r["offset"])
            assert fields["warc-record-id"] == f"<{r['record_id']}>" and stop == r["offset"] + r["length"]
        for number, plain_frame in enumerate(frames):  # only a record longer than a frame makes a longer one
            assert len(plain_frame) <= 3000 or sum(r["frame"] == number for r in row["records"]) == 1


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    bundles = archive.write_records(spark.createDataFrame(rows, SCHEMA), least_bytes=3)
    kinds = {r["key"]: r["record_type"] for r in archive.read_records(bundles).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_damage_is_an_error():
    bundler = archive.Bundler("b")
    bundler.add("id", archive.warc_record("1", "u", b"payload", 7, digest("payload"), None))
    content = bundler.finish()["content"]
    assert archive.frames_of(content)[0][0] == 0
    with pytest.raises(ValueError, match="seek table"):
        archive.frames_of(content[:-1])
    with pytest.raises(ValueError, match="damaged"):
        archive._record(archive.warc_record("1", "u", b"payloae", 7, digest("payload"), None), 0, "b", 0)


def test_empty_table_and_text_keys(spark):
    assert archive.archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([("b:%/", "u", "t"), ("", "u", "t"), ("a", None, "v")], "page_id string, url string, html string")
    assert found(archive.archive_pages(rows).select("page_id", "record_type", "refers_to").collect()) == [
        ("", "response", None), ("a", "response", None), ("b:%/", "revisit", "")
    ]
