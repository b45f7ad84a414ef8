"""Quoted CSV read in splits, against Spark's whole-file reader."""

import random

import pytest

from tradeloom.sources import quoted
from tradeloom.sources.files import BAD_ROW, CSV, Manifest, ManifestEntry, read_inferred, read_table
from tradeloom.sources.specs import TABLES
from tradeloom.warehouse.loading import load_manifest


@pytest.fixture
def tiny_splits(spark):
    """Splits of 700 bytes, so that values lie across borders."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def whole(spark, path, schema):
    return spark.read.options(**CSV, header=True, multiLine=True, columnNameOfCorruptRecord=BAD_ROW).schema(f"{schema}, {BAD_ROW} STRING").csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def value(rng):
    kind = rng.randrange(12)
    if kind < 3:
        return str(rng.randrange(1000))
    if kind == 3:
        return ""
    if kind == 4:
        return 'in"ch ' + "x" * rng.randrange(9)  # a quote that opens nothing
    text = "".join(rng.choice(["a", "é", " ", ",", "\n", '""', "\r\n", "日", "; ", "word "]) for _ in range(rng.choice([0, 3, 20, 60, 700 if kind == 11 else 30])))
    return f'"{text}"'


def write(path, n, seed, end="\n", last_end=True):
    rng = random.Random(seed)
    lines = ["id,b,c,d"] + [",".join([str(i), *(value(rng) for _ in range(3))]) for i in range(n)]
    path.write_bytes((end.join(lines) + (end if last_end else "")).encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(2))
def test_like_the_whole_file_reader(spark, tmp_path, tiny_splits, seed, end):
    for i in range(2):
        write(tmp_path / f"part-{i}.csv", 60, 10 * seed + i, end, last_end=i != 1)
    schema = "id STRING, b STRING, c STRING, d STRING"
    expected = whole(spark, str(tmp_path), schema)
    got = read_inferred(spark, str(tmp_path), multi_line=True, keep_bad_rows=True)
    assert got.rdd.getNumPartitions() > 10
    got_rows = rows(got.select(*[got[c].cast("string") for c in got.columns]))
    if end == "\r\n":  # the whole-file reader of files with such line ends shortens those in values as well
        got_rows = sorted((tuple(v and v.replace("\r\n", "\n") for v in r) for r in got_rows), key=str)
    assert got_rows == rows(expected)
    assert got.schema["id"].dataType.simpleString() == "int"


def test_without_splits_it_is_the_same(spark, tmp_path):
    for i in range(2):
        write(tmp_path / f"part-{i}.csv", 200, i, last_end=i == 0)
    got = read_inferred(spark, str(tmp_path), multi_line=True, keep_bad_rows=True)
    assert rows(got.select(*[got[c].cast("string") for c in got.columns])) == rows(whole(spark, str(tmp_path), "id STRING, b STRING, c STRING, d STRING"))


def test_a_value_over_many_splits(spark, tmp_path, tiny_splits):
    text = "\n".join(f"line {i}, with \"\"quotes\"\"" for i in range(120))
    (tmp_path / "x.csv").write_text(f'"id","t"\n1,"{text}"\n2,"{text}"\n3,short\n')
    got = {r["id"]: r["t"] for r in read_inferred(spark, str(tmp_path / "x.csv"), multi_line=True).collect()}
    assert got == {1: text.replace('""', '"'), 2: text.replace('""', '"'), 3: "short"}


def test_a_header_over_many_splits(spark, tmp_path, tiny_splits):
    name = "long\n" * 100 + "name"
    (tmp_path / "x.csv").write_text(f'id,"{name}"\n1,2\n3,4\n')
    df = read_inferred(spark, str(tmp_path / "x.csv"), multi_line=True)
    assert df.columns == ["id", name] and rows(df) == [(1, 2), (3, 4)]


def test_open_value_at_the_end_mark_and_blank_lines(spark, tmp_path, tiny_splits):
    for name, text in {"open": 'a,b\n1,"x\ny\n' + "z" * 500, "bom": '﻿"a",b\n1,"x\ny"\n', "blank": '\n\na,b\n\n1,"x\n\ny"\n\n2,z\n', "header": "a,b\n"}.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        path = str(tmp_path / f"{name}.csv")
        got = read_inferred(spark, path, multi_line=True)
        assert got.columns == ["a", "b"], name
        assert rows(got.select(*[got[c].cast("string") for c in got.columns])) == rows(whole(spark, path, "a STRING, b STRING").drop(BAD_ROW)), name


def test_a_header_row_repeated_as_data_stays(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"x\ny"\na,b\n')
    assert rows(read_inferred(spark, str(tmp_path / "x.csv"), multi_line=True)) == [("1", "x\ny"), ("a", "b")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_columns_of_part_files_are_never_swapped(spark, tmp_path, multi_line):
    (tmp_path / "part-0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "part-1.csv").write_text("b,a\n20,10\n")
    with pytest.raises(Exception, match="header"):
        read_inferred(spark, str(tmp_path), multi_line=multi_line).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_surplus_fields_are_counted(spark, tmp_path, multi_line):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3,4,5\n6\n")
    got = read_inferred(spark, str(tmp_path / "x.csv"), multi_line=multi_line, keep_bad_rows=True)
    assert rows(got) == [(1, 2, None), (3, 4, "3,4,5"), (6, None, "6")]


def test_manifest_counts_bad_rows_and_loads_the_others(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,2\n3,4,5\n"6\n7",8\n')
    (tmp_path / "swapped").mkdir()
    (tmp_path / "swapped/part-0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "swapped/part-1.csv").write_text("b,a\n20,10\n")
    (tmp_path / "plain.csv").write_text("1,2\n3,4\n")
    entries = (ManifestEntry("x.csv", "mx"), ManifestEntry("swapped", "ms"), ManifestEntry("none.csv", "mn"), ManifestEntry("plain.csv", "mp", header=False))
    summary = {r["table_name"]: r for r in load_manifest(spark, Manifest(entries, "quoted_manifest"), str(tmp_path)).collect()}
    assert [(summary[t]["status"], summary[t]["rows"], summary[t]["bad_rows"]) for t in ("mx", "ms", "mn", "mp")] == [("SUCCESS", 3, 1), ("FAILED", None, None), ("FAILED", None, None), ("SUCCESS", 2, 0)]
    assert rows(spark.table("quoted_manifest.mx")) == [("1", "2"), ("3", "4"), ("6\n7", "8")]
    assert rows(spark.table("quoted_manifest.mp")) == [("1", "2"), ("3", "4")]


def test_reviews_in_splits(spark, tmp_path, tiny_splits):
    spec = TABLES["order_reviews"]
    names = list(spec.columns)
    comment = next(c for c in names if "message" in c)
    lines = [",".join(f'"{i}\nsecond, ""line"" {i}"' if c == comment else f'"{i}"' if c.endswith("_id") else "5" if "score" in c else "2018-01-02 03:04:05" if c.endswith(("date", "timestamp")) else "" for c in names) for i in range(100)]
    (tmp_path / "shop_order_reviews_dataset.csv").write_text(",".join(f'"{c}"' for c in names) + "\n" + "\n".join(lines) + "\n")
    df = read_table(spark, str(tmp_path / "shop_order_reviews_dataset.csv"), spec)
    assert df.rdd.getNumPartitions() > 10
    assert {r[comment] for r in df.select(comment).collect()} == {f'{i}\nsecond, "line" {i}' for i in range(100)}


def test_states_compose_like_one_scan():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(1)
    lines = pa.array([",".join(value(rng) for _ in range(3)).encode() for _ in range(300)], pa.binary())
    pieces = b"\n".join(lines.to_pylist()).split(b"\n")
    ends = quoted._ends(pa.array(pieces, pa.binary()))
    for begin in (False, True):
        expected, now = [begin], begin
        for out, within in zip(*ends, strict=True):
            now = bool(within if now else out)
            expected.append(now)
        assert quoted._states(*ends, begin).tolist() == expected
    assert isinstance(ends[0], np.ndarray)
