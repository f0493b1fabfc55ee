import json

import pytest

from immolytics.sources.files import load_table, read_file


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_csv_json_txt_shapes(spark, tmp_path):
    csv = _write(tmp_path, "a.csv", "prix,id_ville,ville\n100000,1,Paris\n200000,2,Lyon\n")
    df = load_table(spark, csv, delimiter=",")
    assert (df.count(), len(df.columns)) == (2, 3)
    js = _write(tmp_path, "a.json", json.dumps([{"prix": 100000, "id_ville": 1, "ville": "Paris"},
                                                {"prix": 200000, "id_ville": 2, "ville": "Lyon"}]))
    df = load_table(spark, js)
    assert (df.count(), len(df.columns)) == (2, 3)
    assert df.columns == ["prix", "id_ville", "ville"]          # allow-list order
    txt = _write(tmp_path, "a.txt", "prix;id_ville;ville\n100000;1;Paris\n200000;2;Lyon\n")
    df = load_table(spark, txt)
    assert (df.count(), len(df.columns)) == (2, 3)


def test_unsupported_extensions(spark, tmp_path):
    for name in ("a.xlsx", "a.xls", "a.foo"):
        with pytest.raises(ValueError):
            read_file(spark, _write(tmp_path, name, "x"))


def test_parquet_column_list(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "id * 2 AS prix", "'x' AS other")
    path = str(tmp_path / "t.parquet")
    df.write.parquet(path)
    out = read_file(spark, path, columns=["prix"])
    assert out.columns == ["prix"]
    assert "ReadSchema: struct<prix:bigint>" in out._jdf.queryExecution().executedPlan().toString()


RECORDS = [{"prix": 100000.0, "id_ville": 1, "ville": "Paris"}, {"prix": 200000.0, "id_ville": 2, "ville": "Lyon"}]


def test_json_layouts(spark, tmp_path):
    layouts = {"indented": json.dumps(RECORDS, indent=2), "blank": "\n  \n" + json.dumps(RECORDS, indent=1),
               "lines": "\n".join(map(json.dumps, RECORDS)), "one": json.dumps(RECORDS[:1], indent=2)}
    for name, text in layouts.items():
        df = load_table(spark, _write(tmp_path, f"{name}.json", text))
        assert df.columns == ["prix", "id_ville", "ville"], name
        assert df.count() == (1 if name == "one" else 2), name


def test_json_array_writer(spark, tmp_path):
    from immolytics.sources.files import write_json_array
    df = spark.createDataFrame([(float(i), i, f"v{i}") for i in range(10)], "prix double, id_ville long, ville string").repartition(3)
    path = write_json_array(df, str(tmp_path / "out.json"))
    assert sorted(r["prix"] for r in load_table(spark, path).collect()) == [float(i) for i in range(10)]


def test_names_are_stripped_nan_is_null_and_unknown_files_raise(spark, tmp_path):
    df = load_table(spark, _write(tmp_path, "n.csv", " prix ; ville\n1.5;Paris\nNaN;Lyon\n"))
    assert df.columns == ["prix", "ville"]
    assert sorted((r["prix"] is None, r["ville"].strip()) for r in df.collect()) == [(False, "Paris"), (True, "Lyon")]
    with pytest.raises(ValueError, match="known columns"):
        load_table(spark, _write(tmp_path, "u.csv", "a;b\n1;2\n"))
