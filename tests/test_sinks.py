import csv
import gzip
import json
import uuid
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import ferry
from conftest import DATA
from ferry.sinks import Target, arrow, write, written_bytes
from ferry.sinks.files import PARQUET_CODECS, TEXT_CODECS


def files(folder, pattern="part-*"):
    return sorted(p for p in Path(folder).rglob(pattern) if p.is_file() and not p.name.startswith((".", "_")))


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def typed(spark):
    df = spark.sql("""
        SELECT cast(id AS smallint) s, cast(id AS int) i, id b, cast(id AS float) r, cast(id AS double) d,
               cast(id AS decimal(9,2)) n9, cast(id AS decimal(18,4)) n18, cast(id AS decimal(38,15)) n38,
               concat('a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a1', id) u, DATE'2024-10-08' day,
               TIMESTAMP_NTZ'2024-10-08 17:22:00' ts, TIMESTAMP'2024-10-08 17:22:00Z' tz, 'v' v, '{"key": "value"}' j,
               array('a', null) l, id % 2 = 0 f, cast(null AS string) nothing
        FROM range(0, 5, 1, 2)""")
    return ferry.override(df, [
        {"name": "u", "type": "UUID"}, {"name": "j", "type": "JSONB"}, {"name": "v", "type": "VARCHAR", "length": 10},
        {"name": "nothing", "type": "UUID", "position": 40},
    ])


def test_parquet_footer(spark, typed, tmp_path):
    write(typed, "parquet", Target(str(tmp_path / "p")))
    meta = pq.ParquetFile(files(tmp_path / "p")[0]).metadata
    columns = {meta.schema.column(i).name: meta.schema.column(i) for i in range(meta.num_columns)}
    physical = {name: c.physical_type for name, c in columns.items()}
    assert [physical[n] for n in ("s", "i", "b", "r", "d")] == ["INT32", "INT32", "INT64", "FLOAT", "DOUBLE"]
    assert [physical[n] for n in ("n9", "n18", "n38")] == ["INT32", "INT64", "FIXED_LEN_BYTE_ARRAY"]
    assert columns["n38"].length == 16 and columns["day"].logical_type.type == "DATE"
    for name, adjusted in (("ts", "false"), ("tz", "true")):
        assert physical[name] == "INT64"
        logical = str(columns[name].logical_type)
        assert f"isAdjustedToUTC={adjusted}" in logical and "microseconds" in logical
    assert {meta.row_group(0).column(i).compression for i in range(meta.num_columns)} == {"SNAPPY"}
    stored = json.loads(meta.metadata[b"org.apache.spark.sql.parquet.row.metadata"])
    noted = {f["name"]: f["metadata"] for f in stored["fields"]}
    assert (noted["v"]["logical_type"], noted["v"]["length"], noted["j"]["logical_type"]) == ("VARCHAR", 10, "JSONB")
    schema = pq.ParquetFile(files(tmp_path / "p")[0]).schema_arrow
    ids = [int(f.metadata[b"PARQUET:field_id"]) for f in schema]
    assert ids == [*range(16), 40]


@pytest.mark.parametrize("precision, size", [(19, 9), (20, 9), (22, 10), (28, 12), (30, 13), (35, 15), (38, 16)])
def test_decimal_bytes(spark, tmp_path, precision, size):
    df = spark.sql(f"SELECT cast(x AS decimal({precision},2)) x FROM VALUES ('-1.5'), ('123.45') t(x)").coalesce(1)
    write(df, "parquet", Target(str(tmp_path / "d")))
    file = pq.ParquetFile(files(tmp_path / "d")[0])
    assert file.schema.column(0).length == size
    assert [str(v) for v in file.read()["x"].to_pylist()] == ["-1.50", "123.45"]


def test_parquet_values(spark, typed, tmp_path):
    write(typed, "parquet", Target(str(tmp_path / "t")))
    write(typed, "parquet", Target(str(tmp_path / "b"), uuid_as="bytes"))
    row = pq.read_table(tmp_path / "t").sort_by("i").to_pylist()[1]
    assert (row["u"], row["j"], row["l"], row["nothing"]) == (
        "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11", '{"key": "value"}', '["a",null]', None
    )
    assert pq.read_table(tmp_path / "b").sort_by("i")["u"][1].as_py() == uuid.UUID(row["u"]).bytes
    again = spark.read.parquet(str(tmp_path / "b"))
    assert [c.type for c in ferry.columns_of(again)][8] == "UUID"
    assert row["u"] in ferry.csv_lines(again.where("i = 1")).first().value


def test_arrow_stream(spark, typed, tmp_path):
    write(typed, "arrow", Target(str(tmp_path / "a")))
    tables = [pa.ipc.open_stream(p).read_all() for p in files(tmp_path / "a")]
    schema = tables[0].schema
    kinds = [str(t) for t in schema.types]
    assert kinds == [
        "int16", "int32", "int64", "float", "double", "decimal128(9, 2)", "decimal128(18, 4)", "decimal128(38, 15)",
        "fixed_size_binary[16]", "date32[day]", "timestamp[us]", "timestamp[us, tz=UTC]", "string", "string", "string", "bool",
        "fixed_size_binary[16]",
    ]
    assert all(f.nullable for f in schema)
    assert schema.field("v").metadata == {b"name": b"v", b"type": b"VARCHAR", b"length": b"10"}
    rows = sorted((r for t in tables for r in t.to_pylist()), key=lambda r: r["i"])
    assert [r["i"] for r in rows] == list(range(5)) and rows[3]["u"] == uuid.UUID("a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a13").bytes
    assert rows[0]["l"] == '["a",null]' and rows[0]["nothing"] is None and int(rows[0]["ts"].timestamp()) > 0
    assert rows[0]["tz"].timestamp() * 1e6 == 1728408120000000
    assert (tmp_path / "a" / "_SUCCESS").exists() and len(list((tmp_path / "a").glob("_manifest*"))) == 1


def test_arrow_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "a")
    for table in ("documents", "lineitem"):
        df = spark.read.parquet(f"{DATA}/{table}.parquet").repartition(3)
        write(df, "arrow", Target(path, rows_per_file=700))
    arrow.register(spark)
    back = spark.read.format("ferry_arrow").load(path)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert len(files(path)) == 9 and back.select("l_orderkey").count() == df.count()
    assert max(pa.ipc.open_stream(p).read_all().num_rows for p in files(path)) == 700
    assert all(b <= 700 for b in [pa.ipc.open_stream(p).read_all().num_rows for p in files(path)])


@pytest.mark.parametrize("codec", ["gzip", "lz4", "zstd", "snappy", "none"])
def test_arrow_codecs(spark, tmp_path, codec):
    df = spark.range(1000).coalesce(1)
    write(df, "arrow", Target(str(tmp_path / "a"), codec))
    file = files(tmp_path / "a")[0]
    source = gzip.open(file) if codec == "gzip" else open(file, "rb")
    with source:
        assert pa.ipc.open_stream(source).read_all().num_rows == 1000
    arrow.register(spark)
    assert spark.read.format("ferry_arrow").load(str(tmp_path / "a")).count() == 1000


def test_arrow_survives_a_failed_attempt(spark, tmp_path):
    """Rows that a lost attempt had written count once."""

    def break_once(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")

    df = spark.range(0, 30000, 1, 3).mapInArrow(break_once, "id long")
    write(df, "arrow", Target(str(tmp_path / "a"), rows_per_file=4000))
    rows = [r for p in files(tmp_path / "a") for r in pa.ipc.open_stream(p).read_all()["id"].to_pylist()]
    assert sorted(rows) == list(range(30000))


def test_arrow_failure_leaves_the_old_rows(spark, tmp_path):
    """A task that is killed while the job is aborted may leave a file; it is never read, and the next write deletes it."""
    path = tmp_path / "a"
    write(spark.range(10), "arrow", Target(str(path)))
    before = files(path)
    bad = spark.range(0, 100, 1, 4).selectExpr("if(id = 99, raise_error('late'), id) AS id").select(F.col("id").cast("long"))
    with pytest.raises(Exception, match="late"):
        write(bad, "arrow", Target(str(path)))
    arrow.register(spark)
    assert set(files(path)) >= set(before) and spark.read.format("ferry_arrow").load(str(path)).count() == 10
    write(spark.range(3), "arrow", Target(str(path)))
    assert sum(pa.ipc.open_stream(p).read_all().num_rows for p in files(path)) == 3


def test_arrow_commit_that_dies_half_way(spark, tmp_path, monkeypatch):
    """The rows of the write before it stay readable until the new manifest is whole."""
    path = str(tmp_path / "a")
    write(spark.range(10), "arrow", Target(path))
    arrow.register(spark)

    def ids():
        return sorted(r.id for r in spark.read.format("ferry_arrow").load(path).collect())

    sink = arrow.ArrowSink({"path": path}, arrow.arrow_schema(spark.range(1).schema), True)
    name = f"part-00000-{sink.job}-0-000.arrow"
    with pa.OSFile(f"{path}/{name}", "wb") as f, pa.ipc.new_stream(f, sink.schema) as stream:
        stream.write_batch(pa.record_batch([pa.array([77], pa.int64())], schema=sink.schema))
    assert ids() == list(range(10))  # written, not yet committed
    (tmp_path / "a" / f"_manifest-{'9' * 20}-{sink.job}").write_text('{"files": ["par')
    assert ids() == list(range(10))  # died while it wrote the manifest
    (tmp_path / "a" / f"_manifest-{'9' * 20}-{sink.job}").unlink()
    monkeypatch.setattr(arrow.ArrowSink, "_delete", staticmethod(lambda *args: None))
    sink.commit([arrow.Written([name]), None])
    assert ids() == [77] and len(files(tmp_path / "a")) > 1  # died before it deleted the old files
    monkeypatch.undo()
    sink = arrow.ArrowSink({"path": path}, sink.schema, True)
    sink.abort([])
    assert ids() == [77]


def test_arrow_unfinished_first_write_is_not_read(spark, tmp_path):
    (tmp_path / f"part-00000-{'a' * 32}-0-000.arrow").write_bytes(b"half")
    arrow.register(spark)
    with pytest.raises(Exception, match="no Arrow streams"):
        spark.read.format("ferry_arrow").load(str(tmp_path)).count()


def test_arrow_addresses(monkeypatch):
    for address in ("dbfs:/x", "wasb://box@acct/x", "ftp://h/x"):
        with pytest.raises(ValueError, match="cannot be written"):
            arrow.address_filesystem(address)
    assert arrow.address_filesystem("file:/tmp/x")[1] == arrow.address_filesystem("file:///tmp/x")[1] == arrow.address_filesystem("/tmp/x")[1] == "/tmp/x"
    seen = []
    monkeypatch.setattr(arrow.pa.fs, "S3FileSystem", lambda **k: seen.append(k))
    assert arrow.address_filesystem("s3a://bucket/a/b", {"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s"})[1] == "bucket/a/b"
    monkeypatch.setattr(arrow.pa.fs, "AzureFileSystem", lambda account, **k: seen.append((account, k)), raising=False)
    options = {"fs.azure.sas.fixed.token.acct.dfs.core.windows.net": "tok"}
    assert arrow.address_filesystem("abfss://box@acct.dfs.core.windows.net/a", options)[1] == "box/a"
    monkeypatch.setattr(arrow, "DEFAULT", "s3a://lake")
    assert arrow.address_filesystem("/data/out")[1] == "lake/data/out"
    with pytest.raises(ValueError, match="absolute"):
        arrow.address_filesystem("data/out")
    assert seen == [{"access_key": "k", "secret_key": "s"}, ("acct", {"sas_token": "tok"}), {}]


def test_csv_is_read_by_others(spark, tmp_path):
    df = documents(spark)
    write(df, "csv", Target(str(tmp_path / "c"), rows_per_file=70))
    rows = []
    for file in files(tmp_path / "c"):
        with open(file, newline="", encoding="utf8") as f:
            part = list(csv.DictReader(f))
            assert len(part) <= 70
            rows += part
    want = {str(r.doc_id): (r.text, r.lang, str(r.n_chars)) for r in df.collect()}
    assert {r["doc_id"]: (r["text"], r["lang"], r["n_chars"]) for r in rows} == want
    assert max(len(t.split()) for t, _, _ in want.values()) > 1000


def test_jsonl_is_read_by_others(spark, tmp_path):
    df = documents(spark)
    write(df, "jsonl", Target(str(tmp_path / "j"), "gzip"))
    rows = [json.loads(line) for file in files(tmp_path / "j") for line in gzip.open(file, "rt", encoding="utf8")]
    assert {r["doc_id"]: r for r in rows} == {r.doc_id: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("fmt", ["csv", "jsonl", "parquet", "arrow"])
@pytest.mark.parametrize("query", ["SELECT * FROM range(10) WHERE id < 0", "SELECT * FROM range(10) WHERE 1 = 0"])
def test_empty(spark, tmp_path, fmt, query):
    report = ferry.move(spark, {"sql": query, "format": fmt, "filename": "e{{ext}}"}, str(tmp_path)).first()
    assert (report.rows, report.success) == (0, True)
    (part, *_) = files(tmp_path / f"e.{fmt}")
    if fmt == "csv":
        assert part.read_text() == "id\n"
    elif fmt == "arrow":
        assert pa.ipc.open_stream(part).read_all().schema.names == ["id"]
    elif fmt == "parquet":
        assert pq.read_table(part).num_rows == 0
    else:
        assert part.read_text() == ""


def test_chunks(spark, tmp_path):
    for fmt in ("csv", "parquet"):
        write(spark.range(0, 1000, 1, 2), fmt, Target(str(tmp_path / fmt), rows_per_file=300))
        assert len(files(tmp_path / fmt)) == 4


def test_partitions(spark, tmp_path):
    df = spark.read.parquet(f"{DATA}/events.parquet")
    for fmt in ("jsonl", "csv", "parquet"):
        write(df, fmt, Target(str(tmp_path / fmt), partition_by=("event_type",)))
        folders = {p.name for p in (tmp_path / fmt).iterdir() if p.is_dir()}
        assert folders == {f"event_type={r.event_type}" for r in df.select("event_type").distinct().collect()}
    line = json.loads(files(tmp_path / "jsonl")[0].read_text().split("\n")[0])
    assert sorted(line) == ["event_id", "props", "ts", "user_id", "value"]
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == df.count()


def partitioned(spark, path, by, rows=None, **target):
    df = rows if rows is not None else spark.read.parquet(f"{DATA}/events.parquet")
    write(df, "arrow", Target(str(path), partition_by=by, **target))
    return df


def test_arrow_partitions(spark, tmp_path):
    path = tmp_path / "a"
    df = partitioned(spark, path, ("event_type",), rows_per_file=500)
    kinds = {r.event_type: r["count"] for r in df.groupBy("event_type").count().collect()}
    assert {p.name for p in path.iterdir() if p.is_dir()} == {f"event_type={k}" for k in kinds}
    back = ferry.read_landed(spark, str(path), "arrow")
    assert back.columns == [c for c in df.columns if c != "event_type"] + ["event_type"] and back.schema["event_type"].dataType == df.schema["event_type"].dataType
    assert back.select(*df.columns).exceptAll(df).count() == 0 == df.exceptAll(back.select(*df.columns)).count()
    # other readers know the folders too
    import pyarrow.dataset as ds

    others = [ds.dataset(pa.ipc.open_stream(p).read_all()) for p in files(path)]
    assert sum(d.count_rows() for d in others) == df.count() and "event_type" not in others[0].schema.names
    assert max(d.count_rows() for d in others) <= 500


def test_a_filter_opens_the_files_of_its_partitions(spark, tmp_path):
    path = tmp_path / "a"
    df = partitioned(spark, path, ("event_type",))
    kinds = {r.event_type: r["count"] for r in df.groupBy("event_type").count().collect()}
    one = sorted(kinds)[0]
    of_one = len(files(path / f"event_type={one}"))
    whole = ferry.read_landed(spark, str(path), "arrow")
    assert whole.rdd.getNumPartitions() == len(files(path)) > of_one
    for condition, wanted in ((F.col("event_type") == one, {one}), (F.col("event_type").isin(one, "none"), {one}), (F.col("event_type") > one, set(kinds) - {one}),
                              (F.col("event_type").startswith(one), {one}), (F.col("event_type").isNull(), set()), (F.col("event_type") != one, set(kinds) - {one})):
        found = whole.filter(condition)
        assert found.count() == sum(kinds[k] for k in wanted)
        assert found.rdd.getNumPartitions() == max(1, sum(len(files(path / f"event_type={k}")) for k in wanted))
    # what is not of one partition is left alone: if its file were opened, this would fail
    for other in set(kinds) - {one}:
        for file in files(path / f"event_type={other}"):
            file.write_bytes(b"broken")
    assert whole.filter(F.col("event_type") == one).count() == kinds[one]
    with pytest.raises(Exception):
        whole.filter(F.col("value") > 0).count()


def test_arrow_partition_values(spark, tmp_path):
    df = spark.sql("""SELECT id, array('a/b', 'é=1', '', null, '100%')[cast(id % 5 as int)] s, id % 2 = 0 f, DATE'2024-02-28' + cast(id % 3 as int) d,
        cast(if(id % 4 = 0, null, id % 4) AS smallint) n, cast(id % 3 AS decimal(9,2)) m FROM range(0, 300, 1, 3)""")
    for by in (("s",), ("f", "d"), ("n", "m", "s")):
        path = str(tmp_path / "-".join(by))
        partitioned(spark, path, by, df)
        back = ferry.read_landed(spark, path, "arrow").select(*df.columns)
        assert back.schema.simpleString() == df.schema.simpleString()
        assert back.exceptAll(df).count() == 0 == df.exceptAll(back).count()
    back = ferry.read_landed(spark, path, "arrow")
    for condition in ("n IS NULL", "n IS NOT NULL AND m >= 1.00", "NOT (n = 1)", "n <=> NULL", "NOT (n <=> 2)", "s = ''", "n IN (1, NULL)", "NOT n IN (1, 2)", "s LIKE '%b%'"):
        assert back.filter(condition).count() == df.filter(condition).count(), condition
    back = ferry.read_landed(spark, str(tmp_path / "f-d"), "arrow")
    assert back.filter("NOT f AND d < DATE'2024-02-29'").count() == df.filter("NOT f AND d < DATE'2024-02-29'").count()
    with pytest.raises(Exception, match="cannot be partitioned"):
        partitioned(spark, tmp_path / "x", ("x",), spark.sql("SELECT 1.5D x, 1 y"))


def test_arrow_partitions_are_replaced_and_added_to(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.range(0, 100, 1, 4).selectExpr("id", "id % 3 AS k")
    partitioned(spark, path, ("k",), rows)
    partitioned(spark, path, ("k",), rows.filter("k < 2"))
    assert {p.name for p in Path(path).iterdir() if p.is_dir()} == {"k=0", "k=1"}
    bad = spark.range(0, 100, 1, 4).selectExpr("if(id = 99, raise_error('late'), id) AS id", "id % 5 AS k").select(F.col("id").cast("long"), "k")
    with pytest.raises(Exception, match="late"):
        partitioned(spark, path, ("k",), bad)
    back = ferry.read_landed(spark, path, "arrow")
    assert back.count() == rows.filter("k < 2").count()

    def add(by):
        writer = rows.write.format("ferry_arrow").mode("append").option("fields", "")
        writer.option("partitionby", json.dumps(by)).save(path)

    add(["k"])
    assert ferry.read_landed(spark, path, "arrow").filter("k = 1").count() == 2 * rows.filter("k = 1").count()
    with pytest.raises(Exception, match="cannot be added"):
        add([])
    partitioned(spark, path, ("k",), rows.filter("id < 0"))  # a write without rows has no files, but its columns
    empty = ferry.read_landed(spark, path, "arrow")
    assert empty.count() == 0 and empty.columns == ["id", "k"]


def test_what_dead_jobs_left_goes_when_it_is_old(spark, tmp_path):
    import os

    path = tmp_path / "a"
    write(spark.range(10), "arrow", Target(str(path)))
    old, young = (path / f"part-00000-{c * 32}-0-000.arrow" for c in "ab")
    for file in (old, young):
        file.write_bytes(b"half")
    os.utime(old, (1, 1))
    spark.range(5).write.format("ferry_arrow").mode("append").save(str(path))
    assert not old.exists() and young.exists() and ferry.read_landed(spark, str(path), "arrow").count() == 15


def test_many_values_in_any_order(spark, tmp_path):
    """More values than a task may have files open for, in no order: each of its files has rows of one value."""
    arrow.register(spark)
    rows = spark.range(0, 3000, 1, 2).selectExpr("id", "concat('v', id % 50) AS k")
    rows.write.format("ferry_arrow").mode("overwrite").option("partitionby", '["k"]').option("fields", "").save(str(tmp_path / "a"))
    back = ferry.read_landed(spark, str(tmp_path / "a"), "arrow")
    assert back.exceptAll(rows).count() == 0 == rows.exceptAll(back).count()
    write(rows, "arrow", Target(str(tmp_path / "b"), partition_by=("k",)))
    assert len(files(tmp_path / "b")) <= 100 <= len(files(tmp_path / "a"))


def test_hot_partition_value_is_cut(spark, tmp_path):
    """A value that holds most rows is written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = spark.range(0, 200000, 1, 8).selectExpr("if(id % 3 < 2, 0, id % 5) AS k", "uuid() AS v")
        write(df, "parquet", Target(str(tmp_path / "h"), partition_by=("k",)))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    counts = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "h").iterdir() if p.is_dir()}
    assert counts["k=0"] > 4 and spark.read.parquet(str(tmp_path / "h")).count() == 200000


@pytest.mark.parametrize("codec", TEXT_CODECS)
def test_text_codecs(spark, tmp_path, codec):
    for fmt in ("csv", "jsonl"):
        write(documents(spark), fmt, Target(str(tmp_path / fmt), codec))
    want = documents(spark).select("doc_id", "text")
    csv_back = spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"', schema=documents(spark).schema)
    json_back = spark.read.schema(want.schema).json(str(tmp_path / "jsonl"))
    assert csv_back.select("doc_id", "text").exceptAll(want).count() == 0 == json_back.exceptAll(want).count()
    assert csv_back.count() == json_back.count() == want.count()


@pytest.mark.parametrize("codec", PARQUET_CODECS)
def test_parquet_codecs(spark, tmp_path, codec):
    write(documents(spark), "parquet", Target(str(tmp_path / "p"), codec))
    meta = pq.ParquetFile(files(tmp_path / "p")[0]).metadata
    used = meta.row_group(0).column(1).compression.lower()
    assert used.startswith({"none": "uncompressed", "lz4_raw": "lz4"}.get(codec, codec))
    assert pq.read_table(tmp_path / "p").num_rows == documents(spark).count()


def test_odd_names(spark, tmp_path):
    names = ["a.b", "c`d", 'e"f', "g'h", "i j", "k,l", "<m>", "é"]
    df = spark.range(3).select(*(F.col("id").alias(n) for n in names))
    for fmt in ("csv", "jsonl", "parquet", "arrow"):
        write(df, fmt, Target(str(tmp_path / fmt)))
    assert list(csv.DictReader(files(tmp_path / "csv")[-1].open()))[-1] == dict.fromkeys(names, "2")
    assert json.loads(files(tmp_path / "jsonl")[-1].read_text().strip()) == dict.fromkeys(names, 2)
    assert pq.read_table(tmp_path / "parquet").column_names == names
    assert pa.ipc.open_stream(files(tmp_path / "arrow")[0]).schema.names == names


def test_bad_settings(spark, tmp_path):
    df = spark.range(1)
    for fmt, codec in (("csv", "zip"), ("parquet", "bzip2"), ("arrow", "brotli")):
        with pytest.raises(ValueError, match="unsupported compression"):
            write(df, fmt, Target(str(tmp_path / "x"), codec))
    with pytest.raises(ValueError, match="unsupported format"):
        write(df, "avro", Target(str(tmp_path / "x")))


def test_bytes(spark, tmp_path):
    write(spark.range(1000), "csv", Target(str(tmp_path / "c")))
    assert written_bytes(spark.range(1), str(tmp_path / "c")) == sum(p.stat().st_size for p in files(tmp_path / "c"))
