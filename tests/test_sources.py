import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyaltide.plans.staging import scratch_path, shared_dir, stage, staged_in
from loyaltide.sources import files, metrics, records, schemas


def write_text(path, name, *lines):
    (path / name).write_text("\n".join(lines) + "\n")


def test_corrupt_lines_and_null_keys_are_set_aside(spark, tmp_path, rows):
    schema = schemas.table(order_id="string!", n="int", t="timestamp")
    write_text(tmp_path, "o.csv", "order_id,n,t", "a,1,2024-01-01 10:00:00", "b,x,2024-01-01 10:00:00", ",3,",
               "c,4,not a time")
    found = records.ingest_csv(spark, str(tmp_path / "o.csv"), schema, scratch_path(spark, "o"), "order_id")
    assert rows(found.corrupt) == [("b,x,2024-01-01 10:00:00",), ("c,4,not a time",)]
    assert rows(found.good.select("order_id", "n")) == [("a", 1)] and rows(found.without_key.select("n")) == [(3,)]
    assert len(schema) == 3 and found.good.columns == schema.names
    assert files.ingest_table(spark, str(tmp_path / "o.csv"), schema, "order_id").count() == 1
    every = found.good.unionByName(found.without_key)
    assert tuple(files.null_key_report(every, "order_id").first()) == ("order_id", 2, 1)


def test_all_order_and_click_tables_are_read(spark, tmp_path):
    for name, file in {**schemas.ORDER_FILES, **schemas.CLICK_FILES}.items():
        schema = {**schemas.ORDER_TABLES, **schemas.CLICK_TABLES}[name]
        values = {"string": "s", "integer": "1", "long": "1", "double": "1.5", "timestamp": "2024-01-01 00:00:00"}
        write_text(tmp_path, file, ",".join(schema.names), ",".join(values[f.dataType.typeName()] for f in schema))
    orders = files.ingest_orders(spark, str(tmp_path))
    assert {n: df.count() for n, df in orders.items()} == dict.fromkeys(schemas.ORDER_FILES, 1)
    assert orders["payments"].dtypes[-1] == ("payment_value", "double")
    clicks = files.ingest_clicks(spark, str(tmp_path))
    assert {n: df.count() for n, df in clicks.items()} == {"events": 1, "category_tree": 1, "item_properties": 2}


def test_partition_filter_prunes_folders(spark, plan):
    path = scratch_path(spark, "states")
    df = spark.range(100).withColumn("customer_state", F.concat(F.lit("S"), F.col("id") % 5))
    files.write_by_state(df, path)
    read = files.read_parquet(spark, path, partition_filter={"customer_state": ["S1", "S2"], "id": 6})
    assert [r.id for r in read.collect()] == [6]
    text = plan(read)
    assert "PartitionFilters: [isnotnull(customer_state" in text or "PartitionFilters: [customer_state" in text
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,6)]" in text
    assert files.read_states(spark, path).count() == 100
    assert files.read_states(spark, path, ["S3"]).count() == 20


def test_partition_values_stay_text(spark):
    path = scratch_path(spark, "text")
    df = spark.createDataFrame([(1, "01"), (2, "1"), (3, "00123")], "id int, customer_state string")
    files.write_by_state(df, path)
    assert {tuple(r) for r in files.read_states(spark, path).collect()} == {(1, "01"), (2, "1"), (3, "00123")}
    assert [r.id for r in files.read_states(spark, path, ["01"]).collect()] == [1]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_a_flow_leaves_no_staged_folder(spark):
    with staged_in(spark) as scope:
        first = stage(spark.range(5), "a")
        stage(first, "b")
    folders = [p.removeprefix("file://") for p in scope.paths]
    assert len(folders) == 2 and all(os.path.isdir(p) for p in folders)
    scope.remove()
    assert not any(os.path.exists(p) for p in folders) and scope.paths == []


def test_declared_schema_wins_on_read(spark):
    path = scratch_path(spark, "plain")
    files.write_parquet(spark.range(3), path)
    assert files.read_parquet(spark, path, schemas.table(id="long", extra="string")).columns == ["id", "extra"]


def test_metrics_keep_numbers_and_the_whole_row(spark):
    path = scratch_path(spark, "metrics")
    row = spark.createDataFrame([(0.5, 3, "gbt")], "auc double, n int, name string")
    metrics.append_metrics(metrics.as_metrics(row, "train", "r1"), path)
    metrics.append_metrics(metrics.as_metrics(row, "drift", "r2"), path)
    kept = metrics.read_metrics(spark, path, "train")
    assert {(r.metric, r.value) for r in kept.collect()} == {("auc", 0.5), ("n", 3.0)}
    assert kept.first()["detail"] == '{"auc":0.5,"n":3,"name":"gbt"}'


def test_staging_uses_the_folder_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark)).rstrip("/")
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(shared_dir(spark) in f for f in staged.inputFiles())


def test_union_needs_the_same_columns(spark):
    with pytest.raises(Exception):
        files.union_parts(spark.range(1), spark.range(1).toDF("other")).collect()


def test_quoted_texts_may_hold_line_breaks_and_quotes(spark, rows, tmp_path):
    (tmp_path / "r.csv").write_text('id,comment\n1,"two\nlines, ""quoted"""\n2,plain\n')
    found = records.ingest_csv(spark, str(tmp_path / "r.csv"), T.StructType.fromDDL("id int, comment string"),
                               scratch_path(spark, "r"), multi_line=True)
    assert rows(found.good) == [(1, 'two\nlines, "quoted"'), (2, "plain")]
    assert found.corrupt.count() == 0


def awkward_rows(seed, number):
    rng = random.Random(seed)
    parts = ["a", "é", '"', ",", "\n", "\n\n", " ", '""', "x" * 20, "\t", "'"]
    return [(i, "".join(rng.choices(parts, k=rng.randint(1, 12))).strip() or "-", i % 3) for i in range(number)]


def csv_text(rows):
    quoted_rows = [f'{i},"{text.replace(chr(34), chr(34) * 2)}",{n}' for i, text, n in rows]
    return "id,comment,n\n" + "\n".join(quoted_rows) + "\n"


@pytest.mark.parametrize("size", [7, 64, 1_000, 10**6])
def test_records_are_found_wherever_the_splits_fall(spark, rows, tmp_path, size):
    schema = T.StructType.fromDDL("id int, comment string, n int")
    for name, seed in (("a.csv", 1), ("b.csv", 2)):
        (tmp_path / name).write_text(csv_text(awkward_rows(seed, 40)))
    wanted = sorted(awkward_rows(1, 40) + awkward_rows(2, 40), key=repr)
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        read = records.read_records(spark, str(tmp_path), schema)
        assert rows(read.drop(records.CORRUPT)) == wanted and read.filter(records.CORRUPT + " IS NOT NULL").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_carriage_returns_bad_records_and_endless_quotes(spark, rows, tmp_path, monkeypatch):
    schema = T.StructType.fromDDL("id int, comment string")
    (tmp_path / "r.csv").write_bytes(b'id,comment\r\n1,"a\nb"\r\nx,"c\nd"\r\n\r\n2,plain\r\n')
    found = records.ingest_csv(spark, str(tmp_path / "r.csv"), schema, scratch_path(spark, "r"), multi_line=True)
    assert rows(found.good) == [(1, "a\nb"), (2, "plain")] and rows(found.corrupt) == [('x,"c\nd"',)]
    monkeypatch.setattr(records, "LONGEST", 3)
    (tmp_path / "e.csv").write_text('id,comment\n1,ok\n2,"never\n3,closed\n4,b\n5,c\n')
    lines = records.records(spark, str(tmp_path / "e.csv")).select("record")
    assert rows(lines) == sorted([("id,comment",), ("1,ok",), ('2,"never',), ("3,closed",), ("4,b",), ("5,c",)], key=repr)


@pytest.mark.parametrize("multi_line", [False, True])
def test_a_header_in_another_order_raises(spark, tmp_path, multi_line):
    schema = T.StructType.fromDDL("id int, n int")
    write_text(tmp_path, "good.csv", "id,n", "1,2")
    write_text(tmp_path, "swapped.csv", "n,id", "1,2")
    good = records.ingest_csv(spark, str(tmp_path / "good.csv"), schema, scratch_path(spark, "g"), multi_line=multi_line)
    assert good.good.count() == 1
    with pytest.raises(Exception, match="n,id|header"):
        records.ingest_csv(spark, str(tmp_path / "swapped.csv"), schema, scratch_path(spark, "s"), multi_line=multi_line)
    empty = tmp_path / "empty.csv"
    empty.write_text("id,n\n")
    assert records.ingest_csv(spark, str(empty), schema, scratch_path(spark, "e"), multi_line=multi_line).good.count() == 0


def test_texts_are_written_by_several_tasks(tables):
    from bindings.queries_base import csv_many_splits

    with staged_in(tables.spark) as scope:
        csv_many_splits(tables)
    folder, = [p.removeprefix("file://") for p in scope.paths if "/csv-texts-" in p]
    assert len([name for name in os.listdir(folder) if name.endswith(".csv")]) >= 3
    scope.remove()
