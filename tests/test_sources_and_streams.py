import json

import pandas as pd
import pytest

from linkloom.operators import blocking, matching
from linkloom.sources import tables
from linkloom.streaming import arrivals

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def test_read_tsv(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text(HEAD + 'S1-1\tCafé "X"\tNA\t\nS1-2\t"tab\there"\t\tUS\n', encoding="utf-8")
    rows = tables.read_tsv(spark, str(path)).orderBy("entity_id").collect()
    assert [tuple(r) for r in rows] == [("S1-1", 'Café "X"', "NA", ""), ("S1-2", "tab\there", "", "US")]
    rows = tables.read_tsv(spark, str(path), na_mode="pandas").orderBy("entity_id").collect()
    assert rows[0]["business_address"] is None and rows[0]["country"] is None
    for k in (1, 2, 3):
        (tmp_path / f"train_source{k}.tsv").write_text(HEAD + f"S{k}-1\ta\tb\tc\n")
        (tmp_path / f"test_source{k}.tsv").write_text(HEAD)
    (tmp_path / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\n")
    assert [f.count() for f in tables.read_training(spark, str(tmp_path))] == [1, 1, 1, 1]
    assert [f.count() for f in tables.read_test(spark, str(tmp_path))] == [0, 0, 0]
    (tmp_path / "bad.tsv").write_text(HEAD + "S1-1\ta\tb\tc\nS1-2\ta\tb\tc\textra\n")
    (tmp_path / "bad.tsv").write_text(HEAD + "S1-1\ta\tb\tc\nS1-2\ta\tb\tc\textra\nS1-3\ta\nS1-4\ta\tb\tc\t\nS1-5\ta\tb\tc\td\te\n")
    for bad in ("skip", "warn"):
        rows = tables.read_tsv(spark, str(tmp_path / "bad.tsv"), bad_lines=bad).collect()
        assert {tuple(r) for r in rows} == {("S1-1", "a", "b", "c"), ("S1-3", "a", "", ""), ("S1-4", "a", "b", "c")}
    with pytest.raises(Exception, match="too many fields"):
        tables.read_tsv(spark, str(tmp_path / "bad.tsv")).collect()


def test_write_tsv_round_trip(spark, tmp_path):
    rows = [("S1-1", ' "q" and ""', "a, b'", None), ("S1-2", "", " lead", "x"), ("S1-3", "NA", "\\ back", "#")]
    tables.write_tsv(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"), str(tmp_path / "t"))
    found = {tuple(r) for r in tables.read_tsv(spark, str(tmp_path / "t")).collect()}
    assert found == {tuple(x or "" for x in r) for r in rows}
    missing = {r["entity_id"]: r for r in tables.read_tsv(spark, str(tmp_path / "t"), na_mode="pandas").collect()}
    assert missing["S1-3"]["business_name"] is None and missing["S1-1"]["country"] is None and missing["S1-2"]["business_name"] is None


def test_write_lists(spark, tmp_path):
    lists = spark.createDataFrame([("S1-1", 'S2-1,S2-"2'), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string").coalesce(1)
    tables.write_lists(lists, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == 'source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-"2\nS1-2\t\n'
    tables.write_lists(lists, str(tmp_path / "crlf"), "\r\n")
    text = "".join(p.read_bytes().decode() for p in sorted((tmp_path / "crlf").glob("part-*")))
    assert text == 'source1_entity_id\tmatched_entity_ids\r\nS1-1\tS2-1,S2-"2\r\nS1-2\t\r\n'


def test_index_report_chunks_and_first_rows(spark, tmp_path):
    chunks = [pd.DataFrame([["S2-1", "a", None, "UK"]], columns=tables.RECORD), pd.DataFrame([["S3-1", "b", "x", "UK"]], columns=tables.RECORD)]
    rows = tables.from_chunks(spark, chunks)
    assert sorted(r["entity_id"] for r in rows.collect()) == ["S2-1", "S3-1"]
    assert tables.first_rows(rows, 1).first()["entity_id"] == "S2-1"
    assert tables.first_per_id(rows.unionByName(rows), ["business_name"]).count() == 2
    tables.save_exact_index(matching.exact_forms(rows), str(tmp_path / "index"))
    assert tables.read_exact_index(spark, str(tmp_path / "index")).count() == 2
    tables.write_report({"ö": {"a": 1}}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"ö": {"a": 1}} and "ö" in (tmp_path / "r.json").read_text()


def test_stream(spark, tmp_path):
    schema = "entity_id string, business_name string, business_address string, country string"
    s23 = spark.createDataFrame([("S2-1", "Baker", "x", "UK"), ("S2-2", "Other", "y", "UK")], schema)
    folder = str(tmp_path / "in")
    spark.createDataFrame([("S1-1", "BAKER", "q", "uk"), ("S1-2", "none", "y", "uk")], schema).write.parquet(folder)
    stream = arrivals.arrivals(spark, folder)
    query = arrivals.exact_name_pairs(stream, s23).writeStream.format("memory").queryName("pairs").outputMode("append").trigger(
        availableNow=True).start()
    query.awaitTermination(120)
    assert [tuple(r) for r in spark.table("pairs").collect()] == [("S1-1", "S2-1")]
    batch = arrivals.link_batches(
        arrivals.arrivals(spark, folder), lambda b: blocking.candidates(b, s23), str(tmp_path / "out"), str(tmp_path / "state"))
    batch.awaitTermination(120)
    assert sorted(r["candidate_entity_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["S2-1", "S2-2"]
