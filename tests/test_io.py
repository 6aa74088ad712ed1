from sparkpanel.sources import io


def test_cr_only_file_with_mark(spark, tmp_path):
    p = tmp_path / "v.csv"
    p.write_bytes("﻿FNID,V\rA1,V1\rA2,NA\r".encode())
    df = io.read_table(spark, str(p), fmt="csv", line_sep="\r")
    assert df.columns == ["FNID", "V"] and {tuple(r) for r in df.collect()} == {("A1", "V1"), ("A2", None)}


def test_folder_with_names_in_columns(spark, tmp_path):
    for m, v in (("HDDS_clust", 1), ("rCSI_TA", 2)):
        (tmp_path / f"{m}_pair.csv").write_text(f"x\n{v}.5\n")
    df = io.read_dir(spark, str(tmp_path / "*.csv"), r"^(\w+?)_(\w+)_pair\.csv$", ["measure", "level"], "x double")
    assert {tuple(r) for r in df.collect()} == {(1.5, "HDDS", "clust"), (2.5, "rCSI", "TA")}


def test_sheet_drops_title_rows(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("Some title,,\nsecond,,\nid,name,n\n1,a,3\n2,b,4\n")
    assert {tuple(r) for r in io.read_sheet(spark, str(p), "id", ["id", "name", "n"]).collect()} == {("1", "a", "3"), ("2", "b", "4")}


def test_sheet_keeps_rows_with_empty_cells(spark, tmp_path):
    (tmp_path / "s1.csv").write_text("Some title,,total\nid,name,n\n1,a,\n,b,4\n,,\nid,c,5\n")
    (tmp_path / "s2.csv").write_text("id,name,n\n7,x,9\n")
    got = io.read_sheet(spark, str(tmp_path / "*.csv"), "id", ["id", "name", "n"]).collect()
    assert {tuple(r) for r in got} == {("1", "a", None), (None, "b", "4"), ("id", "c", "5"), ("7", "x", "9")}


def test_group_sink_and_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("201001", 1), ("201001", 2), ("201002", 3)], "ym string, v int")
    io.write_groups(df, str(tmp_path / "g"), ["ym"])
    assert sorted(p.name for p in (tmp_path / "g").glob("ym=*")) == ["ym=201001", "ym=201002"]
    io.write_table(df, str(tmp_path / "t"))
    assert io.read_table(spark, str(tmp_path / "t")).exceptAll(df).count() == 0


def test_stacking(spark):
    a = spark.createDataFrame([(1, "x")], "id int, p string")
    b = spark.createDataFrame([(2, 5)], "id int, q int")
    assert {tuple(r) for r in io.append_years([a, b]).collect()} == {(1, "x", None), (2, None, 5)}
    m1 = spark.createDataFrame([("A", "jan", 1.0), ("B", "jan", None)], "m string, t string, v double")
    m2 = spark.createDataFrame([("A", "jan", 2.0), ("A", "feb", 3.0)], "m string, t string, v double")
    assert {tuple(r) for r in io.merge_monthly([m1, m2], ["m", "t"], "v").collect()} == {("A", "jan", 1.0), ("A", "feb", 3.0)}
