"""CSV ingest, guards and sinks."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from cardlens.schemas import RAW_IDENTITY_SCHEMA, RAW_TRANSACTION_SCHEMA, TX_COLUMNS
from cardlens.session import scratch_path
from cardlens.sources import files as FS
from cardlens.sources import guards as GD
from cardlens.sources import sinks as SK


def _write_text(spark, lines: list[str]) -> str:
    path = scratch_path(spark, "csv-src")
    spark.createDataFrame([(ln,) for ln in lines], "value STRING").coalesce(1).write.text(path)
    return path


def test_csv_ingest_drops_malformed_and_reads_flags(spark):
    header = ",".join(TX_COLUMNS)

    # id, label, time, amount, then empty fields except the M1 flag
    def row(tid, amt, m1):
        vals = [""] * len(TX_COLUMNS)
        vals[:4] = [str(tid), "0", "3600", amt]
        vals[TX_COLUMNS.index("M1")] = m1
        return ",".join(vals)
    lines = [header, row(1, "10.5", "T"), row(2, "abc", "F"), row(3, "7", "maybe"), row(4, "8", "")]
    src = _write_text(spark, lines)
    df, counts = FS.ingest_csv(spark, src, scratch_path(spark, "ingested"), RAW_TRANSACTION_SCHEMA)
    got = {r["TransactionID"]: r for r in df.collect()}
    assert counts == {"file": src.rsplit("/", 1)[-1], "rows": 3, "malformed": 1}
    assert sorted(got) == [1, 3, 4]
    assert got[1]["M1"] is True and got[3]["M1"] is None and got[4]["M1"] is None
    assert dict(df.dtypes)["M1"] == "boolean" and dict(df.dtypes)["M4"] == "string"
    assert FS.source_row_count(spark, src, RAW_TRANSACTION_SCHEMA).first().asDict() == \
        {"file_name": src.rsplit("/", 1)[-1], "row_count": 3, "malformed_rows": 1}


def test_ingest_with_limit_keeps_first_keys(spark):
    lines = ["TransactionID,DeviceType,DeviceInfo"] + [f"{i},desktop,x" for i in (5, 3, 9, 1)]
    src = _write_text(spark, lines)
    df, counts = FS.ingest_csv(spark, src, scratch_path(spark, "idn"), T.StructType(
        [f for f in RAW_IDENTITY_SCHEMA.fields if f.name != "id_01"]), bool_columns=[], limit=2)
    assert sorted(r[0] for r in df.select("TransactionID").collect()) == [1, 3]
    assert counts["rows"] == 2


def test_guards(spark):
    with pytest.raises(GD.MissingInputError, match="extract"):
        GD.require_paths(spark, {"tx": "/nonexistent/cardlens/tx.csv"}, "extract")
    with pytest.raises(GD.MissingInputError, match="transform"):
        GD.require_tables(spark, ["no_such_table_xyz"], "transform")
    rep = GD.input_report(spark, {"events": "/root/testdata/sf0.001/events.parquet"}, "extract").first()
    assert rep["row_count"] == 1000


def test_sinks_report_rows_and_replace_is_idempotent(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    info = SK.write_parquet(df, scratch_path(spark, "pq"))
    assert info["rows"] == 10 and info["columns"] == 1
    path = scratch_path(spark, "tbl")
    SK.replace_table(df, "t_idem", path=path)
    SK.replace_table(df, "t_idem", path=path)
    assert spark.table("t_idem").count() == 10
    csv = scratch_path(spark, "csv")
    assert SK.write_csv(df, csv)["rows"] == 10
    assert spark.read.option("header", True).csv(csv).count() == 10
    loaded = SK.warehouse_load(spark, info["path"], "t_loaded", path=scratch_path(spark, "wh")).first()
    assert (loaded["rows"], loaded["columns"]) == (10, 1)


def test_bucketed_sources_merge_without_shuffle(spark):
    from cardlens.operators.merge import merge_identity
    from tests.conftest import BASE_ROWS, make_identity, make_tx
    tx_csv, id_csv = scratch_path(spark, "b-tx"), scratch_path(spark, "b-id")
    make_tx(spark, BASE_ROWS).write.option("header", True).csv(tx_csv)
    make_identity(spark).write.option("header", True).csv(id_csv)
    ident_schema = T.StructType([f for f in RAW_IDENTITY_SCHEMA.fields if f.name != "id_01"])
    tx, _ = FS.ingest_csv(spark, tx_csv, scratch_path(spark, "b-tx-t"), RAW_TRANSACTION_SCHEMA,
                          table="b_raw_tx", buckets=4)
    idn, _ = FS.ingest_csv(spark, id_csv, scratch_path(spark, "b-id-t"), ident_schema,
                           bool_columns=[], table="b_raw_id", buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_identity(tx, idn)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert merged.count() == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


SMALL = T.StructType([T.StructField("TransactionID", T.LongType()), T.StructField("C1", T.DoubleType()),
                      T.StructField("C2", T.DoubleType())])


def _ingest(spark, lines, **kw):
    return FS.ingest_csv(spark, _write_text(spark, lines), scratch_path(spark, "named"), SMALL, bool_columns=[], **kw)


def test_columns_bind_by_name_and_extra_ones_stay(spark):
    df, counts = _ingest(spark, ["V9,C2,TransactionID,C1,note", "x,22,1,11,a", ",2.5,2,,\"b,c\""])
    assert df.columns == ["V9", "C2", "TransactionID", "C1", "note"]
    assert sorted((r.TransactionID, r.C1, r.C2, r.V9, r.note) for r in df.collect()) == \
        [(1, 11.0, 22.0, "x", "a"), (2, None, 2.5, None, "b,c")]
    assert counts["malformed"] == 0


def test_headers_that_cannot_be_bound(spark):
    with pytest.raises(FS.SourceError, match="C2"):
        _ingest(spark, ["TransactionID,C1", "1,2"])
    df, _ = _ingest(spark, ["TransactionID,C1", "1,2"], required=["TransactionID"])
    assert df.columns == ["TransactionID", "C1"]
    with pytest.raises(FS.SourceError, match="repeats"):
        _ingest(spark, ["TransactionID,C1,C2,C1", "1,2,3,4"])
    with pytest.raises(FS.SourceError, match="lacks"):
        _ingest(spark, [])


def test_mostly_malformed_sources_fail(spark):
    lines = ["TransactionID,C1,C2", "1,x,1", "2,y,1", "3,1,1"]
    with pytest.raises(FS.SourceError, match="2 of 3"):
        _ingest(spark, lines)
    assert _ingest(spark, lines, max_malformed_share=0.7)[1]["rows"] == 1


def test_part_files_with_other_headers_fail(spark):
    path = scratch_path(spark, "two-headers")
    for a, b in (("C1", "C2"), ("C2", "C1")):
        spark.createDataFrame([(f"TransactionID,{a},{b}",), ("1,2,3",)], "value STRING").coalesce(1) \
            .write.mode("append").text(path)
    with pytest.raises(Exception, match="(?i)header"):
        FS.ingest_csv(spark, path, scratch_path(spark, "named"), SMALL, bool_columns=[])


@pytest.mark.parametrize("n", [0, 1, 7, 500, 1999, 2000, 5000])
def test_sample_limit_takes_the_smallest_keys(spark, n, monkeypatch):
    import numpy as np
    keys = [int(x) for x in np.random.default_rng(1).integers(-10**12, 10**12, 1500)] + [5] * 400 + [None] * 100
    df = spark.createDataFrame([(k, "x") for k in keys], "k BIGINT, v STRING").repartition(4)
    monkeypatch.setattr(FS, "EXACT_ROWS", 50)
    got = sorted((r.k for r in FS.sample_limit(df, n, "k").collect()), key=lambda k: (k is None, k))
    assert got == sorted(keys, key=lambda k: (k is None, k or 0))[:n]


def test_limited_ingest_is_not_one_task(spark):
    src = scratch_path(spark, "limit-src")
    spark.range(0, 20_000, 1, 8).selectExpr("id AS TransactionID", "1.0 AS C1", "2.0 AS C2") \
        .write.option("header", True).csv(src)
    dest = scratch_path(spark, "limit-dest")
    df, counts = FS.ingest_csv(spark, src, dest, SMALL, bool_columns=[], limit=10_000)
    assert counts["rows"] == 10_000 and df.agg({"TransactionID": "max"}).first()[0] == 9_999
    assert len(df.inputFiles()) > 1


def test_bucketed_ingest_writes_one_file_per_bucket(spark):
    src = scratch_path(spark, "bucket-src")
    spark.range(0, 4_000, 1, 16).selectExpr("id AS TransactionID", "1.0 AS C1", "2.0 AS C2") \
        .write.option("header", True).csv(src)
    df, _ = FS.ingest_csv(spark, src, scratch_path(spark, "bucket-dest"), SMALL, bool_columns=[],
                          table="one_file_per_bucket", buckets=8)
    assert df.count() == 4_000 and len(df.inputFiles()) == 8


# --- types of columns that the schema does not know --------------------------

def test_unknown_columns_take_the_narrowest_type(spark):
    header = "TransactionID,C1,C2,b,l,d,mix,big,day,time,both,none,text,late,word,num"
    rows = ["1,1,1,true,1,1.5,1,9223372036854775807,2024-01-31,2024-01-31 10:00:00,2024-01-31,,x,1,true,nan",
            "2,1,1,F,-7,2,2.5,9223372036854775808,2024-02-29,2024-01-31T10:00:01.25,2024-01-31 08:00,,1,2,1,-1e3",
            "3,1,1,,007,.5,,1,,,,,2024-01-31,3,,Infinity"]
    late = [f"{k},1,1,false,{k},{k}.0,{k},1,2024-01-01,2024-01-01 00:00:00,2024-01-01,,{k},{k},true,1" for k in range(4, 400)]
    late[-1] = late[-1].replace(",399,true", ",2.25,true")
    df, counts = _ingest(spark, [header, *rows, *late])
    assert counts["rows"] == 399
    kinds = {c: t for c, t in df.dtypes if c not in SMALL.names}
    assert kinds == {"b": "boolean", "l": "bigint", "d": "double", "mix": "double", "big": "double", "day": "date",
                     "time": "timestamp_ntz", "both": "timestamp_ntz", "none": "string", "text": "string",
                     "late": "double", "word": "string", "num": "double"}
    first = {r.TransactionID: r for r in df.where("TransactionID < 4").collect()}
    assert first[3].l == 7 and first[3].b is None and first[2].b is False and first[3].d == 0.5
    assert first[2].time.microsecond == 250_000 and str(first[1].both) == "2024-01-31 00:00:00"
    assert str(first[2].day) == "2024-02-29" and first[1].word == "true"


def test_impossible_dates_and_long_numbers_stay_what_they_are(spark):
    df, _ = _ingest(spark, ["TransactionID,C1,C2,d,n,e", "1,1,1,2023-02-29,12345678901234567890123,", "2,1,1,2024-01-01,1,\"\""])
    assert {c: t for c, t in df.dtypes if c in "dne"} == {"d": "string", "n": "double", "e": "string"}


# --- quoted line breaks -------------------------------------------------------

def _write_bytes(spark, parts: list[str]) -> str:
    """Part files with exactly these characters."""
    folder = scratch_path(spark, "csv-raw")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k, text in enumerate(parts):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/part-{k}.csv")
        out = path.getFileSystem(conf).create(path)
        out.write(bytearray(text.encode()))
        out.close()
    return folder


NOTES = ["plain", "a\nb", "\n", "two\n\nbreaks, \"quoted\"", "ends with \"", "\"starts", "\"", "\"\"", "a,b\n\",\"\nc",
         "5\" pipe\nnext", "x" * 300 + "\n" + "y" * 300, "é\nü", None, "tab\tand\r\nreturn"]


def _quoted(v):
    if v is None:
        return ""
    return '"' + v.replace('"', '""') + '"' if set(v) & set('",\n') else v


@pytest.fixture()
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, n) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("split", [150, 1 << 20])
def test_records_with_line_breaks_load_once(spark, tiny_splits, split):
    rows = [(k, NOTES[k % len(NOTES)]) for k in range(120)]
    body = [f"{k},{_quoted(v)},{k}.5,1\n" for k, v in rows]
    header = "TransactionID,note,C1,C2\n"
    src = _write_bytes(spark, [header + "".join(body[:70]), header + "".join(body[70:]).rstrip("\n"), header])
    tiny_splits(split)
    df, counts = _ingest_from(spark, src)
    want = {k: v.replace("\r\n", "\n") if v else v for k, v in rows}
    assert counts["rows"] == 120 and counts["malformed"] == 0
    assert {r.TransactionID: r.note for r in df.collect()} == want
    assert all(r.C1 == r.TransactionID + 0.5 for r in df.collect())
    got = FS.source_row_count(spark, src, SMALL).first()
    assert (got.row_count, got.malformed_rows) == (120, 0)


def _ingest_from(spark, src, **kw):
    return FS.ingest_csv(spark, src, scratch_path(spark, "broken"), SMALL, bool_columns=[], **kw)


def test_field_that_spans_whole_splits(spark, tiny_splits):
    long = "\n".join(f"line {k}" for k in range(400))
    src = _write_bytes(spark, [f'TransactionID,C1,C2,note\n1,1,1,"{long}"\n2,1,1,after\n3,x,1,"bad\nrow"\n4,1,1,"{long}"'])
    tiny_splits(900)
    df, counts = _ingest_from(spark, src)
    assert {r.TransactionID: r.note for r in df.collect()} == {1: long, 2: "after", 4: long}
    assert counts["rows"] == 3 and counts["malformed"] == 1


def test_quotes_that_never_close_cost_their_lines_only(spark):
    src = _write_bytes(spark, ['TransactionID,C1,C2,note\n1,1,1,"open\n2,1,1,fine\n3,1,1,5" pipe\n',
                               'TransactionID,C1,C2,note\n4,1,1,"a\nb"\n'])
    df, counts = _ingest_from(spark, src)
    got = {r.TransactionID: r.note for r in df.collect()}
    assert {k: got[k] for k in (2, 3, 4)} == {2: "fine", 3: '5" pipe', 4: "a\nb"}


def test_broken_records_need_equal_headers(spark):
    src = _write_bytes(spark, ['TransactionID,C1,C2,note\n1,1,1,"a\nb"\n', 'TransactionID,C2,C1,note\n2,1,1,x\n'])
    with pytest.raises(FS.SourceError, match="header"):
        _ingest_from(spark, src)


def test_known_single_line_sources_skip_the_look(spark, monkeypatch):
    src = _write_bytes(spark, ["TransactionID,C1,C2\n1,1,1\n"])
    monkeypatch.setattr(FS, "split_states", lambda lines: pytest.fail("quotes were counted"))
    assert _ingest_from(spark, src, line_breaks=False)[1]["rows"] == 1


# --- tables replaced by versions ------------------------------------------------

def _versions(spark, path):
    from cardlens.session import list_folder
    return [n for n, _ in list_folder(spark, path)]


def test_failed_load_leaves_the_old_rows(spark):
    from pyspark.sql import functions as F
    path = scratch_path(spark, "versions")
    SK.replace_table(spark.range(100).withColumnRenamed("id", "k"), "t_versions", path=path)
    bad = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("k"))
    with pytest.raises(Exception, match="lost"):
        SK.replace_table(bad, "t_versions", path=path)
    assert spark.table("t_versions").count() == 100
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("t_versions_loading")]
    SK.replace_table(spark.range(7).withColumnRenamed("id", "k"), "t_versions", path=path)
    assert spark.table("t_versions").count() == 7


def test_replacing_keeps_one_old_version_and_follows_the_schema(spark):
    path = scratch_path(spark, "versions")
    for n in (1, 2, 3, 4):
        SK.replace_table(spark.range(n), "t_sweep", path=path)
        assert spark.table("t_sweep").count() == n and len(_versions(spark, path)) == min(n, 2)
    reader = spark.table("t_sweep")
    SK.replace_table(spark.range(5).selectExpr("id", "'x' AS name"), "t_sweep", path=path, bucket_by=(2, "id"))
    assert reader.count() == 4  # planned before the swap: its files are kept
    assert spark.table("t_sweep").columns == ["id", "name"] and spark.table("t_sweep").count() == 5
    SK.replace_table(spark.range(6).selectExpr("id", "'x' AS name"), "t_sweep", path=path, bucket_by=(2, "id"))
    assert spark.table("t_sweep").count() == 6
    assert "Exchange" not in spark.table("t_sweep").groupBy("id").count()._jdf.queryExecution().executedPlan().toString()


def test_table_without_a_path_lives_in_the_warehouse(spark):
    for n in (3, 4):
        assert SK.replace_table(spark.range(n), "t_managed")["rows"] == n
        assert spark.table("t_managed").count() == n
    assert len(_versions(spark, spark.conf.get("spark.sql.warehouse.dir") + "/t_managed.versions")) == 2


def test_put_if_absent_has_one_winner(spark):
    from concurrent.futures import ThreadPoolExecutor

    from cardlens.session import put_if_absent
    path = scratch_path(spark, "claims") + "/1"
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda _: put_if_absent(spark, path), range(16))) == 1


@pytest.mark.parametrize("stage", ["transform", "validate", "load", "build_marts", "experiments"])
def test_every_stage_names_its_missing_input(spark, stage):
    from cardlens.plans import etl
    run = {"transform": etl.run_transform, "validate": etl.validate, "load": etl.load,
           "build_marts": lambda s, root: etl.build_marts(s, None, root), "experiments": etl.experiments}[stage]
    with pytest.raises(GD.MissingInputError, match=stage):
        run(spark, "/nonexistent/cardlens")


# --- first rows by keys of any type ------------------------------------------------

def _keys(kind):
    import datetime as dt
    import random
    rng = random.Random(3)
    if kind == "STRING":
        return ["".join(rng.choice("abé\U0001f600") for _ in range(rng.randint(0, 6))) for _ in range(900)] \
            + ["same" * 20] * 200 + ["same" * 20 + x for x in "xyz"]
    if kind == "BINARY":
        return [bytes(rng.randrange(256) for _ in range(rng.randint(0, 3))) for _ in range(900)]
    if kind == "TIMESTAMP":
        return [dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**13)) for _ in range(900)]
    if kind == "DATE":
        return [dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(90)) for _ in range(900)]
    if kind == "BOOLEAN":
        return [rng.random() < 0.5 for _ in range(900)]
    return [2**63 - 1 - k for k in range(600)] + [-2**63 + k for k in range(300)]


@pytest.mark.parametrize("kind", ["STRING", "BINARY", "TIMESTAMP", "DATE", "BOOLEAN", "BIGINT"])
@pytest.mark.parametrize("n", [1, 450, 1000, 5000])
def test_sample_limit_by_keys_of_any_type(spark, kind, n, monkeypatch):
    keys = _keys(kind) + [None] * 30
    df = spark.createDataFrame([(k, 1) for k in keys], f"k {kind}, v INT").repartition(4)
    monkeypatch.setattr(FS, "EXACT_ROWS", 40)
    got = [r.k for r in FS.sample_limit(df, n, "k").collect()]
    order = (lambda k: (k is None, k.encode() if isinstance(k, str) else k if k is not None else 0))
    if kind == "BINARY":
        got = [bytes(k) if k is not None else None for k in got]
        order = (lambda k: (k is None, k or b""))
    assert sorted(got, key=order) == sorted(keys, key=order)[:n]
