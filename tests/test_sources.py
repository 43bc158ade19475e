"""Readers and the prediction sink on small files."""

import gzip
import json

import pytest
from pyspark.sql import types as T

from featloom.sources import readers


def test_shards_merge_by_name(spark, tmp_path):
    (tmp_path / "train-1.csv").write_text(",tconst,numVotes\n0,tt1,5\n")
    (tmp_path / "train-2.csv").write_text(",numVotes,tconst,label\n0,7,tt2,True\n")
    out = readers.read_csv_shards(spark, f"{tmp_path}/train-*.csv")
    assert set(out.columns) == {"tconst", "numVotes", "label"}
    got = {r["tconst"]: (r["numVotes"], r["label"]) for r in out.collect()}
    assert got == {"tt1": (5, None), "tt2": (7, True)}
    schema = T.StructType([T.StructField("numVotes", T.LongType()), T.StructField("label", T.BooleanType())])
    typed = readers.read_csv_shards(spark, f"{tmp_path}/train-*.csv", schema)
    assert dict(typed.dtypes) == {"tconst": "string", "numVotes": "bigint", "label": "boolean"}
    assert {r["tconst"]: r["numVotes"] for r in typed.collect()} == {"tt1": 5, "tt2": 7}


def test_no_match_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_csv_shards(spark, f"{tmp_path}/none-*.csv")


def test_metadata(spark, tmp_path):
    path = tmp_path / "movies_metadata.csv"
    path.write_text('title,budget,runtime,overview\n" A ",12,x,"two\nlines, ""quoted"""\nB,,90,\n')
    rows = readers.read_metadata(spark, str(path)).orderBy("title").collect()
    assert [(r["title"], r["budget"], r["runtime"]) for r in rows] == [("a", 12.0, 0.0), ("b", 0.0, 90.0)]
    assert rows[0]["overview"] == 'two\nlines, "quoted"' and rows[1]["overview"] is None
    assert readers.read_metadata(spark, str(tmp_path / "absent.csv")) is None


def test_links_in_both_layouts(spark, tmp_path):
    records = tmp_path / "records.json"
    records.write_text("\n".join(json.dumps({"movie": f"tt{i}", "director": f"nm{i}"}) for i in range(3)))
    columns = tmp_path / "columns.json"
    columns.write_text(json.dumps({"movie": {str(i): f"tt{i}" for i in range(3)}, "director": {str(i): f"nm{i}" for i in range(3)}}))
    expected = [("tt0", "nm0"), ("tt1", "nm1"), ("tt2", "nm2")]
    for path, layout in ((records, "records"), (columns, "columns")):
        out = readers.read_links(spark, str(path), "director", layout)
        assert out.columns == ["tconst", "director"] and sorted(map(tuple, out.collect())) == expected
    assert readers.read_links(spark, str(tmp_path / "absent.json"), "director") is None
    array = tmp_path / "array.json"
    array.write_text(json.dumps([{"movie": f"tt{i}", "director": f"nm{i}"} for i in range(3)], indent=2))
    assert sorted(map(tuple, readers.read_links(spark, str(array), "director", "array").collect())) == expected
    for path, layout in ((array, "records"), (columns, "records"), (columns, "array")):
        with pytest.raises(Exception):
            readers.read_links(spark, str(path), "director", layout).collect()
    with pytest.raises(ValueError):
        readers.read_links(spark, str(array), "director", "pretty")


def test_packed_shards(spark, tmp_path):
    for name, body in (("train-1.csv.gz", ",tconst,numVotes\n0,tt1,5\n"), ("train-2.csv.gz", "numVotes,tconst\n7,tt2\n")):
        (tmp_path / name).write_bytes(gzip.compress(body.encode()))
    schema = T.StructType([T.StructField("numVotes", T.LongType())])
    out = readers.read_csv_shards(spark, f"{tmp_path}/train-*.csv.gz", schema)
    assert sorted((r["tconst"], r["numVotes"]) for r in out.collect()) == [("tt1", 5), ("tt2", 7)]


def test_uneven_columns(spark):
    uneven = [({"a": "tt1", "b": "tt2"}, {"b": "nm2", "c": "nm3"})]
    raw = spark.createDataFrame(uneven, "movie map<string,string>, director map<string,string>")
    rows = readers.explode_columns(raw, "movie", "director").collect()
    assert sorted(map(tuple, rows), key=str) == [("tt1", None), ("tt2", "nm2")]


def test_catalogue(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text("movieId,title,genres\n1,Red Car (1999) ,Drama|Action\n2,Blue (2001),Drama\n")
    out = {r["movieId"]: (r["title"], r["genres"]) for r in readers.read_catalogue(spark, str(path)).collect()}
    assert out["2"] == ("blue", "drama") and out["1"][1] == "drama|action"


def test_predictions_keep_their_key(spark, tmp_path):
    df = spark.createDataFrame([("tt1", True, 0.9), ("tt2", False, 0.1)], "tconst string, prediction boolean, p double")
    readers.write_predictions(df, str(tmp_path / "out"))
    back = readers.read_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == [("tt1", True), ("tt2", False)]


def test_views_and_sql(spark):
    df = spark.range(3)
    readers.register_views({"some_view": df})
    assert spark.sql("SELECT count(*) FROM some_view").first()[0] == 3
    assert readers.run_sql(spark, "SELECT max(id) AS m FROM {t}", t=df).first()["m"] == 2
