"""CSV records against Python's reader, over blocks of a few bytes."""

import bz2
import csv
import gzip
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from jobloom.queries import postings
from jobloom.sources import files, records


@pytest.fixture
def tiny_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def text_of(rows, end):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def odd_rows(seed, n=60):
    r = random.Random(seed)
    fields = ["a", "b c", "x,y", 'say "no"', "two\nlines", "\r\n", "three\n\nlines, \"and\"\n", "é🙂", "w" * 90, '"', "1\n" * 30]
    return [[str(k), r.choice(fields), r.choice(fields)] for k in range(n)]


def found(df):
    return sorted(([r[c] for c in ("k", "one", "other")] for r in df.collect()), key=lambda r: int(r[0]))


@pytest.mark.parametrize("seed,end,header", [(1, "\n", "one"), (2, "\r\n", "one"), (3, "\n", 'a "long"\nname, of two lines' + "w" * 100)])
def test_records_equal_a_plain_reader(spark, tmp_path, tiny_blocks, seed, end, header):
    parts = [odd_rows(seed), odd_rows(seed + 10, 15)]
    for k, rows in enumerate(parts):
        rows = [[str(int(key) + 1000 * k), *rest] for key, *rest in rows]
        parts[k] = rows
        names = ["k", header, "other"] if k else ["other", "k", header]
        ordered = rows if k else [[c, a, b] for a, b, c in rows]
        (tmp_path / f"{k}.csv").write_bytes(text_of([names, *ordered], end).encode())
    back = files.read_csv(spark, str(tmp_path), f"k string, `{header}` string, other string").toDF("k", "one", "other")
    assert found(back) == [r for rows in parts for r in rows]
    assert files.lines(spark, str(tmp_path)).select("block").distinct().count() > 20


def test_joined_states_equal_sent_ones(spark, tmp_path, tiny_blocks, monkeypatch):
    rows = odd_rows(5)
    (tmp_path / "a.csv").write_bytes(text_of([["k", "one", "other"], *rows], "\n").encode())
    monkeypatch.setattr(records, "MOST_SENT", 0)
    assert found(files.read_csv(spark, str(tmp_path), "k string, one string, other string")) == rows


def test_quotes_inside_plain_fields_open_nothing(spark, tmp_path, tiny_blocks):
    (tmp_path / "a.csv").write_text('k,one,other\n1,5" pipe,x\n2,"a" b,y\n\n3, "q,z\n')
    assert found(files.read_csv(spark, str(tmp_path), "k string, one string, other string")) == [
        ["1", '5" pipe', "x"], ["2", '"a" b', "y"], ["3", ' "q', "z"]
    ]


def test_a_field_that_is_never_closed(spark, tmp_path, tiny_blocks):
    (tmp_path / "a.csv").write_text("k,one,other\n1,a,b\n2,c," + '"open\n' + "3,d,e\n" * 40)
    back = found(files.read_csv(spark, str(tmp_path), "k string, one string, other string"))
    assert [r[0] for r in back] == ["1", "2"] and back[1][2].startswith("open\n3,d,e")


def test_what_a_line_does(monkeypatch):
    assert not records.ends_inside('a,"b",c', False) and records.ends_inside('a,"b', False)
    assert not records.ends_inside('b",c', True) and records.ends_inside('b",""",', True) and records.ends_inside('b""', True)
    assert not records.ends_inside('a,b"c', False) and records.ends_inside("plain", True)


def test_every_codec_and_good_compressed_files(spark, tmp_path):
    plain = b"k,one,other\n" + b"1,a,b\n" * 3000
    packers = {"gz": gzip.compress, "bz2": bz2.compress, "deflate": zlib.compress}
    for end, pack in packers.items():
        (tmp_path / f"good.csv.{end}").write_bytes(pack(plain))
        (tmp_path / f"cut + 1.csv.{end}").write_bytes(pack(plain)[:-20])
        (tmp_path / f"no.csv.{end}").write_bytes(b"not compressed at all")
    good, bad = files.read_csv_checked(spark, str(tmp_path), "k string, one string, other string")
    assert good.groupBy("file_name").count().orderBy("file_name").collect() == [(f"good.csv.{end}", 3000) for end in sorted(packers)]
    wanted = [(f"{name}.csv.{end}", "file cannot be read") for name in ("cut + 1", "no") for end in packers]
    assert sorted((r["urls"], r["msg"]) for r in bad.collect()) == sorted(wanted)


def test_too_many_damaged_files_to_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "MOST_LEFT_OUT", 0)
    (tmp_path / "a.csv").write_text("k\n1\n")
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(b"k\n2\n" * 5000)[:-12])
    good, bad = files.read_csv_checked(spark, str(tmp_path), "k string")
    assert [r["k"] for r in good.collect()] == ["1"] and [r["msg"] for r in bad.collect()] == ["file cannot be read"]


def test_no_list_of_files_in_the_plan(spark, tmp_path):
    for k in range(30):
        (tmp_path / f"{k}.csv").write_text(f"k,n\n{k},1\n")
    good, bad = files.read_csv_checked(spark, str(tmp_path), "k string, n int")
    assert good.agg(F.sum("n")).first()[0] == 30 and bad.count() == 0


def test_no_task_reads_the_whole_table_of_the_quoted_breaks(spark, tmp_path, monkeypatch):
    rows = [(k, f'a, "b"\n{k}', "en", "web", 9) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    written = []
    write = files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path: (written.append(path), write(df, path)))
    default = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        back = postings.csv_quoted_breaks(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", default)
    assert sorted((r["doc_id"], r["label"], r["body"]) for r in back) == sorted((k, 'web, "en"', t + '\n"\r\nweb') for k, t, *_ in rows)
    assert spark.read.format("binaryFile").load(f"{written[0]}/*.csv").count() == 4
