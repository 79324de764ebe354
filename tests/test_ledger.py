import json
import os

import pytest
from pyspark.sql import types as T

from series_lake.sinks.ledger import current_entries, ledger, load_new_files, loaded_rows

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.DoubleType())])


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps({"id": r[0], "price": r[1]}) for r in rows) + "\n")


def told(frame):
    return sorted((os.path.basename(r.file), r.rows_loaded, r.rows_rejected, r.status) for r in frame.collect())


def rows(spark, root):
    return sorted((r.id, r.price) for r in loaded_rows(spark, root, SCHEMA).collect())


def test_each_file_is_loaded_once_and_reported(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    load = lambda **o: load_new_files(spark, str(source), SCHEMA, root, required=("id",), **o)
    put(source, "a.json", ("a", 1), ("b", 2))
    put(source, "b.json", ("c", 3), "{broken", (None, 4))
    put(source, "empty.json")
    assert told(load(files_per_round=2)) == [("a.json", 2, 0, "LOADED"), ("b.json", 1, 2, "PARTIALLY_LOADED"), ("empty.json", 0, 0, "LOADED")]
    assert rows(spark, root) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]
    assert load().count() == 0 and len(rows(spark, root)) == 3
    put(source, "sub.json", ("d", 5))
    assert told(load()) == [("sub.json", 1, 0, "LOADED")]
    # a forced reload writes all again, and only the new copies count
    assert load(force=True).count() == 4
    assert rows(spark, root) == [("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 5.0)]
    assert ledger(spark, root).count() == 8 and current_entries(spark, root).count() == 4
    put(source, "a.json", ("a", 7), ("a", 8), ("e", 9))  # a changed file replaces its rows
    assert told(load()) == [("a.json", 3, 0, "LOADED")]
    assert rows(spark, root) == [("a", 7.0), ("a", 8.0), ("c", 3.0), ("d", 5.0), ("e", 9.0)]
    errors = {os.path.basename(r.file): r.first_error for r in current_entries(spark, root).collect()}
    assert errors["a.json"] is None and errors["b.json"].startswith(("no id", "unreadable"))


def test_skip_file_and_abort(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.json", ("a", 1))
    put(source, "b.json", ("c", 3), "{broken")
    with pytest.raises(ValueError, match="rejected rows in .*b.json"):
        load_new_files(spark, str(source), SCHEMA, root, on_error="abort")
    assert rows(spark, root) == [] and ledger(spark, root).count() == 0
    assert told(load_new_files(spark, str(source), SCHEMA, root, on_error="skip_file")) == [("a.json", 1, 0, "LOADED"), ("b.json", 0, 1, "LOAD_FAILED")]
    assert rows(spark, root) == [("a", 1.0)]
    assert told(load_new_files(spark, str(source), SCHEMA, root, force=True)) == [("a.json", 1, 0, "LOADED"), ("b.json", 1, 1, "PARTIALLY_LOADED")]
    assert rows(spark, root) == [("a", 1.0), ("c", 3.0)]
    with pytest.raises(ValueError, match="on_error"):
        load_new_files(spark, str(source), SCHEMA, root, on_error="never")


def test_rows_without_an_entry_do_not_count(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    spark.createDataFrame([("z", 1.0, "f", "0001")], "id string, price double, _file string, load_id string").write.partitionBy("load_id").parquet(f"{root}/rows")
    assert rows(spark, root) == []
    put(source, "a.json", ("a", 1))
    load_new_files(spark, str(source), SCHEMA, root)
    assert rows(spark, root) == [("a", 1.0)]


def test_parquet_files(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", 1.0), (None, 2.0)], SCHEMA).coalesce(1).write.parquet(source)
    got = load_new_files(spark, source, SCHEMA, root, form="parquet", required=("id",)).collect()
    assert [(r.rows_loaded, r.rows_rejected, r.status, r.first_error) for r in got] == [(1, 1, "PARTIALLY_LOADED", "no id")]
    assert rows(spark, root) == [("a", 1.0)]
