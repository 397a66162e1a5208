"""Quoted line breaks in split files, and rejected records, against a single-threaded reader."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from ledgerlift.schemas import DOMAINS
from ledgerlift.sources.csv_records import read_csv_records, records, rejected_findings

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("more", T.StringType())])


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "199")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def written(folder, rows, name="a.csv", end="\n", header=True):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    if header:
        writer.writerow(["id", "text", "more"])
    writer.writerows(rows)
    (folder / name).write_bytes(out.getvalue().encode())
    return out.getvalue()


@pytest.mark.parametrize("seed", range(2))
def test_as_a_single_threaded_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choices(["a", "ü", '"', "\n", ",", " ", "\n\n", '""', "word "], k=rng.choice([1, 6, 30, 150])))
    files = {}
    for n in range(3):
        rows = [(n * 1000 + i, text(), rng.choice(["x", "last\nline", '"'])) for i in range(rng.randint(1, 18))]
        files[f"{n}.csv"] = written(tmp_path, rows, f"{n}.csv", end=rng.choice(["\n", "\r\n"]))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    want = sorted((int(r[0]), r[1], r[2]) for t in files.values() for r in csv.reader(io.StringIO(t, newline="")) if r and r[0] != "id")
    loaded = read_csv_records(spark, str(tmp_path), SCHEMA)
    assert sorted(tuple(r) for r in loaded.rows.collect()) == want
    assert loaded.rejected.count() == 0


def test_lines_of_records_and_a_quote_never_closed(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('id,text,more\n1,"x\ny",z\n\n2,plain,z\n3,"open,' + "w" * 300 + "\n4,b,c\n")
    got = sorted((r["line"], r["record"][:6]) for r in records(spark, str(tmp_path)).collect())
    assert got == [(0, "id,tex"), (1, '1,"x\ny'), (3, ""), (4, "2,plai"), (5, '3,"ope')]
    with pytest.raises(Exception, match="a record of more than 100 characters"):
        records(spark, str(tmp_path), longest=100).collect()


def test_rejected_records_are_kept_with_their_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,more\n1,a,b\nx,"not\na number",b\n2,too few\n3,too,many,fields\n4,,""\n')
    loaded = read_csv_records(spark, str(tmp_path), SCHEMA)
    assert sorted(tuple(r) for r in loaded.rows.collect()) == [(1, "a", "b"), (4, None, "")]
    bad = {r["line"]: r["record"] for r in loaded.rejected.collect()}
    assert bad == {2: 'x,"not\na number",b', 4: "2,too few", 5: "3,too,many,fields"}
    findings = rejected_findings(loaded.rejected, DOMAINS["finance"]).collect()
    assert {r["row_identifier"] for r in findings} == {"a.csv:2", "a.csv:4", "a.csv:5"}
    assert {r["table_name"] for r in findings} == {"legacy_finance"}
    with pytest.raises(ValueError, match="line 2 of"):
        read_csv_records(spark, str(tmp_path), SCHEMA, mode="fail")
    with pytest.raises(ValueError):
        read_csv_records(spark, str(tmp_path), SCHEMA, mode="odd")


def test_an_empty_file_and_a_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,text,more\n")
    loaded = read_csv_records(spark, str(tmp_path), SCHEMA)
    assert loaded.rows.count() == 0 and loaded.rejected.count() == 0
