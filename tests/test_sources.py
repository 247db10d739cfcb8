import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.plans import etl, signups
from clickloom.session import materialize, scratch_path
from clickloom.sources import files, readers, tables

LINES = [
    {"timestamp": "2024-01-01T00:00:01.5", "user_id": "a", "product_id": "p", "event_type": "view"},
    {"timestamp": "2024-01-01T00:00:02", "user_id": "b", "product_id": "q", "event_type": "view"},
]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture()
def broken(folder):
    text = "\n".join([json.dumps(LINES[0]), "{bad", "", "   ", json.dumps(LINES[1])]) + "\n"
    return write(f"{folder}/in/clickstream-1.json", text)


def test_bad_records_drop(spark, broken):
    assert sorted(r.user_id for r in readers.read_clickstream(spark, broken).collect()) == ["a", "b"]


def test_bad_records_null(spark, broken):
    rows = readers.read_json_lines(spark, broken, schemas.CLICKSTREAM, "null").collect()
    assert sorted((r.user_id or "", r[readers.CORRUPT]) for r in rows) == [
        ("", "{bad"), ("a", None), ("b", None)
    ]


def test_bad_records_fail(spark, broken):
    rows = readers.read_json_lines(spark, broken, schemas.CLICKSTREAM, "fail")
    with pytest.raises(Exception, match="MALFORMED"):
        rows.collect()
    with pytest.raises(ValueError):
        readers.read_json_lines(spark, broken, schemas.CLICKSTREAM, "maybe")


def test_inferred_json_and_many_paths(spark, folder):
    a = write(f"{folder}/a.json", json.dumps(LINES[0]))
    b = write(f"{folder}/b.json", json.dumps({**LINES[1], "extra": 3}))
    rows = readers.read_json_lines(spark, [a, b])
    assert rows.count() == 2 and "extra" in rows.columns


def test_path_filter(spark, folder):
    write(f"{folder}/in/my-clickstream-x.json", json.dumps(LINES[0]))
    write(f"{folder}/in/other.json", json.dumps(LINES[1]))
    assert readers.read_clickstream(spark, f"{folder}/in", path_pattern=readers.CLICKSTREAM_PATHS).count() == 1


def test_csv_forms(spark, folder):
    text = 'user_id,name,signup_date,features\nu1,"A, ""B""",2024-02-03,"[0.1, -2.5]"\n'
    path = write(f"{folder}/users.csv", text)
    plain = readers.read_csv(spark, path)
    assert {f.dataType.simpleString() for f in plain.schema} == {"string"}
    assert readers.read_csv(spark, path, infer=True).schema["signup_date"].dataType.simpleString() == "date"
    count, schema, head = readers.inspect(plain)
    assert count == 1 and "features:string" in schema and head.first().name == 'A, "B"'


def test_etl(spark, folder):
    users = write(
        f"{folder}/users.csv",
        'user_id,name,signup_date,features\nu1,Ann,2024-02-03,"[1.0]"\nu2,Bob,never,"[2.0]"\n',
    )
    products = write(
        f"{folder}/products.csv",
        'product_id,product_name,category,price,features\np1,Desk,Office,12.50,"[1.0]"\n'
        'p2,Lamp,Office,free,"[1.0]"\n',
    )
    try:
        u, p = etl.run_etl(spark, users, products, "shop")
        assert u.schema == schemas.USERS and p.schema == schemas.PRODUCTS
        assert {r.user_id: str(r.signup_date) for r in u.collect()} == {
            "u1": "2024-02-03", "u2": "None"
        }
        assert {r.product_id: r.price for r in p.collect()} == {"p1": 12.5, "p2": None}
        u, _ = etl.run_etl(spark, users, products, "shop")
        assert u.count() == 2
        names = {r.tableName for r in tables.list_tables(spark, "shop").collect()}
        assert {"users", "products"} <= names
        tables.drop_table(spark, "shop.users")
        tables.drop_table(spark, "shop.users")
        with pytest.raises(AnalysisException):
            tables.read_table(spark, "shop.users").count()
    finally:
        tables.use_namespace(spark, "default", create=False)


def test_catalog_listing(spark):
    assert "spark_catalog" in [r.catalog for r in tables.list_catalogs(spark).collect()]
    assert "default" in [r.namespace for r in tables.list_namespaces(spark).collect()]
    assert tables.list_tables(spark).count() >= 0


def test_ensure_table_keeps_rows(spark, folder):
    name = "clickloom_fraud_once"
    row = spark.createDataFrame(
        [("u", datetime(2024, 1, 1), datetime(2024, 1, 2), 7)], schemas.FRAUD_ATTEMPTS
    )
    tables.ensure_table(spark, name, schemas.FRAUD_ATTEMPTS, f"{folder}/t")
    tables.append_table(row.select(*reversed(row.columns)), name)
    assert tables.read_table(spark, name).first().event_count == 7
    assert tables.ensure_table(spark, name, schemas.FRAUD_ATTEMPTS, f"{folder}/t").count() == 1
    tables.drop_table(spark, name)


def test_merge_keeps_lines_whole(spark, folder):
    first = {**LINES[0], "extra": [1, 2]}
    a = write(f"{folder}/in/clickstream-1.json", json.dumps(first) + "\n\n  \n")
    b = write(f"{folder}/in/clickstream-2.json", json.dumps(LINES[1]) + "\n" + json.dumps(LINES[0]))
    report = files.merge_clickstream(spark, [a, b], f"{folder}/merged")
    assert {r.file: r.records for r in report.collect()} == {
        "clickstream-1.json": 1, "clickstream-2.json": 2
    }
    merged = sorted(r.value for r in spark.read.text(f"{folder}/merged").collect())
    assert merged == sorted(map(json.dumps, [first, LINES[1], LINES[0]]))


def test_merge_fails_on_broken_line(spark, broken, folder):
    with pytest.raises(Exception, match="not JSON in clickstream-1.json"):
        files.merge_clickstream(spark, [broken], f"{folder}/merged")


def test_stage(spark, folder):
    write(f"{folder}/in/users.csv", "user_id,name,signup_date,features\nu1,Ann,2024-02-03,[]\n")
    for n in (1, 2):
        write(f"{folder}/in/clickstream-{n}.json", json.dumps(LINES[0]) + "\n")
    report = files.stage(spark, f"{folder}/in", f"{folder}/out").collect()
    assert sorted((r.artifact, r.path.rsplit("/", 1)[1], r.file, r.records) for r in report) == [
        ("clickstream", "individual", "clickstream-1.json", 1),
        ("clickstream", "individual", "clickstream-2.json", 1),
        ("clickstream", "merged", "clickstream-1.json", 1),
        ("clickstream", "merged", "clickstream-2.json", 1),
        ("users", "users", "users.csv", 1),
    ]
    only = files.stage(
        spark, f"{folder}/in", f"{folder}/out2", ["clickstream"], merged=False,
        clickstream_file="clickstream-2.json",
    )
    assert [r.file for r in only.collect()] == ["clickstream-2.json"]
    staged = readers.read_clickstream(
        spark, f"{folder}/out/clickstream/individual", file_glob=None
    )
    assert staged.count() == 2
    assert files.stage(spark, f"{folder}/none", f"{folder}/out3").count() == 0
    listed = files.list_files(spark, f"{folder}/out", n=3)
    assert listed.columns == ["path", "length", "modificationTime"] and listed.count() == 3


def test_new_data_and_archive(spark, folder):
    path = f"{folder}/in/clickstream_new.json"
    assert files.check_new_data(spark, path) is None
    write(path, json.dumps(LINES[0]) + "\n\n" + json.dumps(LINES[1]))
    assert files.check_new_data(spark, path) == 2
    moved = files.archive(spark, path, f"{folder}/archive", datetime(2024, 1, 2, 3, 4, 5, tzinfo=UTC))
    assert "/clickstream_archive_20240102_030405_" in moved
    assert files.check_new_data(spark, path) is None
    assert files.check_new_data(spark, moved) == 2
    write(path, json.dumps(LINES[0]))
    files.archive(spark, path, f"{folder}/archive")
    rows = files.list_archives(spark, f"{folder}/archive").collect()
    assert len(rows) == 2 and rows[-1].length > 0
    assert files.list_archives(spark, f"{folder}/nothing").count() == 0


def test_signup_export(spark, folder):
    users = spark.createDataFrame(
        [("a", "2024-01-02"), ("b", "2024-01-31"), ("c", "2024-02-01"), ("d", "bad")],
        "user_id string, signup_date string",
    )
    fraud = spark.createDataFrame([("b",)], "user_id string")
    signups.export_signups(users, fraud, f"{folder}/out")
    rows = readers.read_json_lines(spark, f"{folder}/out", schemas.SIGNUP_COUNTS).collect()
    assert {r.signup_month: r["count"] for r in rows} == {"2024-01": 1, "2024-02": 1, None: 1}


def test_json_rows_and_sql(spark):
    df = spark.createDataFrame([("a", 1)], "k string, x int")
    assert files.to_json_rows(df).first().value == '{"k":"a","x":1}'
    assert tables.run_sql(spark, "SELECT x + 1 AS y FROM some_rows", some_rows=df).first().y == 2
    assert spark.table("some_rows").select(F.max("x")).first()[0] == 1


def test_scratch_guard(spark, folder):
    with pytest.raises(ValueError):
        files.remove_scratch(spark, folder)
    path = scratch_path(spark, "guard")
    spark.range(3).write.parquet(path)
    assert files.exists(spark, path)
    files.remove_scratch(spark, path)
    assert not files.exists(spark, path)


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/clickloom/")
    frame = materialize(spark.range(3), "range")
    assert frame.count() == 3 and "scratch" not in frame.columns


def test_folders_are_read_whole_and_patterns_see_the_full_path(spark, folder):
    for n, place in enumerate(["clickstream-1.json", "clickstream-2.json/part-0.json", "x.json"]):
        write(f"{folder}/in/{place}", json.dumps(LINES[n % 2]) + "\n")
    paths = [f"{folder}/in", f"{folder}/in/clickstream-2.json"]
    assert readers.read_clickstream(spark, paths).count() == 3
    only = readers.read_clickstream(spark, paths, path_pattern=readers.CLICKSTREAM_PATHS)
    assert only.count() == 2
    with pytest.raises(FileNotFoundError):
        readers.read_clickstream(spark, paths, path_pattern="nothing-like-it")
    os.makedirs(f"{folder}/empty")
    with pytest.raises(FileNotFoundError):
        readers.read_clickstream(spark, f"{folder}/empty")


def test_first_existing(spark, folder):
    path = write(f"{folder}/b/clickstream-1.json", json.dumps(LINES[0]))
    assert readers.first_existing(spark, [f"{folder}/a", f"{folder}/b/click*"]).endswith("click*")
    assert readers.first_existing(spark, [path, f"{folder}/b/click*"]) == path
    with pytest.raises(FileNotFoundError):
        readers.first_existing(spark, [f"{folder}/a", f"{folder}/c-*"])


def test_count_lines(spark, broken):
    good, bad = readers.count_lines(spark, broken, schemas.CLICKSTREAM)
    kept = readers.read_json_lines(spark, broken, schemas.CLICKSTREAM).count()
    assert (good, bad > 0) == (kept, True)


def test_archives_of_one_second_do_not_meet(spark, folder):
    now, moved = datetime(2024, 1, 2, tzinfo=UTC), []
    for n in range(2):
        path = write(f"{folder}/in/clickstream_new.json", json.dumps(LINES[n]))
        moved.append(files.archive(spark, path, f"{folder}/archive", now))
    assert len(set(moved)) == 2
    assert sorted(files.check_new_data(spark, m) for m in moved) == [1, 1]
    files.move_back(spark, moved[0], f"{folder}/in/clickstream_new.json")
    assert files.has_new_data(spark, f"{folder}/in/clickstream_new.json")
    with pytest.raises(OSError):
        files.move_back(spark, moved[1], f"{folder}/in/clickstream_new.json")


def test_reports_keep_equal_names_apart(spark, folder):
    paths = [
        write(f"{folder}/{d}/clickstream-1.json", (json.dumps(LINES[0]) + "\n") * n)
        for d, n in (("a", 1), ("b", 2))
    ]
    report = files.merge_clickstream(spark, paths, f"{folder}/merged").collect()
    assert sorted(r.records for r in report) == [1, 2]
    assert all(r.sample_keys == list(LINES[0]) for r in report)


def test_a_cluster_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from clickloom.session import checkpoint_root

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(conf=conf, sparkContext=context))


# --- versions of a table, and files seen ------------------------------------


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def test_a_reader_ends_on_the_rows_it_began_with(spark, folder):
    name = "clickloom_versions"
    tables.write_table(numbers(spark, 1, 2), name, f"{folder}/t")
    began = tables.read_table(spark, name)
    tables.write_table(numbers(spark, 3), name, f"{folder}/t")
    assert sorted(r.n for r in began.collect()) == [1, 2]
    assert [r.n for r in tables.read_table(spark, name).collect()] == [3]
    # The version before is kept, older ones are not.
    tables.write_table(numbers(spark, 4), name, f"{folder}/t")
    assert len(os.listdir(f"{folder}/t")) == 2
    assert [r.n for r in tables.read_table(spark, name).collect()] == [4]
    tables.append_table(numbers(spark, 5), name)
    assert sorted(r.n for r in tables.read_table(spark, name).collect()) == [4, 5]
    tables.drop_table(spark, name)
    assert os.listdir(f"{folder}/t") == []


def test_a_failed_replacement_leaves_the_table(spark, folder):
    name = "clickloom_failed"
    tables.write_table(numbers(spark, 1), name, f"{folder}/t")
    with pytest.raises(Exception, match="broken"):
        tables.write_table(numbers(spark, 2).selectExpr("raise_error('broken') AS n"), name)
    assert [r.n for r in tables.read_table(spark, name).collect()] == [1]
    tables.drop_table(spark, name)


def test_a_replacement_may_change_columns_and_read_itself(spark, folder):
    name = "clickloom_columns"
    tables.write_table(numbers(spark, 1, 2), name)
    grown = tables.read_table(spark, name).selectExpr("n + 1 AS n")
    assert sorted(r.n for r in tables.write_table(grown, name).collect()) == [2, 3]
    other = tables.write_table(tables.read_table(spark, name).selectExpr("n", "'x' AS s"), name)
    assert other.columns == ["n", "s"] and other.count() == 2
    tables.drop_table(spark, name)


def test_unseen_files(spark, folder):
    lines = spark.range(20).selectExpr("CAST(id AS string) AS value")
    lines.repartition(2).write.text(f"{folder}/in")
    seen = f"{folder}/seen"
    assert files.unseen_files(spark, f"{folder}/in", seen, "part-*").count() == 2
    files.mark_seen(files.unseen_files(spark, f"{folder}/in", seen, "part-*"), seen)
    assert files.unseen_files(spark, f"{folder}/in", seen, "part-*").count() == 0
    lines.repartition(1).write.mode("append").text(f"{folder}/in")
    assert files.unseen_files(spark, f"{folder}/in", seen, "part-*").count() == 1


def test_input_check_stops_at_the_first_file(spark, folder):
    os.makedirs(f"{folder}/in/_hidden")
    for name in ("_hidden/a.json", "b.txt"):
        with open(f"{folder}/in/{name}", "w") as f:
            f.write('{"user_id": "u"}\n')
    schema = "user_id string"
    for options in ({"file_glob": "*.json"}, {"path_pattern": "nothing"}):
        with pytest.raises(FileNotFoundError):
            readers.read_json_lines(spark, f"{folder}/in", T.StructType.fromDDL(schema), **options)
    with pytest.raises(FileNotFoundError):
        readers.read_json_lines(spark, f"{folder}/none")
    found = readers.read_json_lines(
        spark, f"{folder}/in", T.StructType.fromDDL(schema), file_glob="*.txt"
    )
    assert found.count() == 1
