import os
from datetime import date

from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from deskmill.sources import csv_tables, landing, profile, snapshots

SCHEMA = StructType(
    [
        StructField("id", IntegerType()),
        StructField("name", StringType()),
        StructField("body", StringType()),
        StructField("day", DateType()),
    ]
)
QUOTES = 'id,name,body,day\n1,"A, ""q""","line1\nline2",2024-01-02\n2,,"x",\n'


def put(path, content):
    with open(path, "w", encoding="utf-8") as out:
        out.write(content)


def test_quotes_newlines_and_missing_values(spark, folder):
    put(f"{folder}/a.csv", QUOTES)
    want = [(1, 'A, "q"', "line1\nline2", date(2024, 1, 2)), (2, None, "x", None)]
    assert rows(csv_tables.scan_csv(spark, folder, SCHEMA)) == want
    assert rows(csv_tables.scan_csv(spark, folder)) == want  # inferred


def test_default_options_would_split_records(spark, folder):
    put(f"{folder}/a.csv", QUOTES)
    assert spark.read.csv(folder, header=True).count() == 3
    assert csv_tables.scan_csv(spark, folder).count() == 2


def test_csv_round_trip_keeps_spaces_quotes_and_backslashes(spark, folder):
    df = spark.createDataFrame([(1, '  "a"\\n\\" ', "x\n\n,y ", None)], SCHEMA)
    csv_tables.write_csv(df, f"{folder}/out")
    assert rows(csv_tables.scan_csv(spark, f"{folder}/out", SCHEMA)) == rows(df)


def load(spark, folder):
    """Files and what became of them."""
    report = csv_tables.load_new_files(spark, f"{folder}/in", f"{folder}/out", SCHEMA)
    return rows(report.select("source_file", "status", "rows"))


def loaded(spark, folder):
    return rows(csv_tables.loaded_rows(spark, f"{folder}/out", SCHEMA).drop("source_file"))


def test_load_twice_changes_nothing_and_bad_file_stays_out(spark, folder):
    os.mkdir(f"{folder}/in")
    put(f"{folder}/in/good.csv", QUOTES)
    put(f"{folder}/in/bad.csv", "id,name,body,day\n3,c,y,2024-01-03\nnot a number,d,z,\n")
    assert load(spark, folder) == [("bad.csv", "failed", 0), ("good.csv", "loaded", 2)]
    put(f"{folder}/in/new.csv", "id,name,body,day\n4,e,w,2024-01-04\n")
    assert load(spark, folder) == [("bad.csv", "failed", 0), ("good.csv", "skipped", 2), ("new.csv", "loaded", 1)]
    assert load(spark, folder) == [("bad.csv", "failed", 0), ("good.csv", "skipped", 2), ("new.csv", "skipped", 1)]
    assert [r[0] for r in loaded(spark, folder)] == [1, 2, 4]
    assert loaded(spark, folder)[0] == (1, 'A, "q"', "line1\nline2", date(2024, 1, 2))


def test_columns_go_by_the_header(spark, folder):
    os.mkdir(f"{folder}/in")
    put(f"{folder}/in/turned.csv", 'day,body,id,name\n2024-01-02,"x\ny",1,A\n')
    put(f"{folder}/in/only.csv", "id,name,body,day\n")
    put(f"{folder}/in/other.csv", "id,name,body,night\n1,a,b,2024-01-02\n")
    put(f"{folder}/in/more.csv", "id,name,body,day,extra\n1,a,b,2024-01-02,z\n")
    put(f"{folder}/in/short.csv", "id,name,body,day\n1,a\n")
    put(f"{folder}/in/nothing.csv", "\n")
    want = [("more.csv", "failed", 0), ("nothing.csv", "empty", 0), ("only.csv", "loaded", 0), ("other.csv", "failed", 0), ("short.csv", "failed", 0), ("turned.csv", "loaded", 1)]
    assert load(spark, folder) == want
    assert loaded(spark, folder) == [(1, "A", "x\ny", date(2024, 1, 2))]
    faults = dict(rows(csv_tables.ledger(spark, f"{folder}/out").filter("fault is not null").select("source_file", "fault")))
    assert set(faults) == {"more.csv", "other.csv", "short.csv"} and "header" in faults["other.csv"] and "fields" in faults["short.csv"]


def test_files_of_one_name_in_two_folders_are_two_files(spark, folder):
    for name in ("in", "in/day=1", "in/day=2"):
        os.mkdir(f"{folder}/{name}")
    for day in (1, 2):
        put(f"{folder}/in/day={day}/a b.csv", f"id,name,body,day\n{day},a,b,2024-01-02\n")
    inbox = f"{folder}/in/day=*"
    report = csv_tables.load_new_files(spark, inbox, f"{folder}/out", SCHEMA)
    assert rows(report.select("source_file", "status", "rows")) == [("a b.csv", "loaded", 1)] * 2
    assert [r[0] for r in loaded(spark, folder)] == [1, 2]


def test_many_files_in_one_task_keep_their_headers(spark, folder):
    os.mkdir(f"{folder}/in")
    for i in range(40):
        head, row = ("id,name,body,day", f"{i},n{i},b,") if i % 2 else ("day,body,name,id", f",b,n{i},{i}")
        put(f"{folder}/in/f{i}.csv", f"{head}\n{row}\n{row}\n")
    assert {r[1:] for r in load(spark, folder)} == {("loaded", 2)}
    assert loaded(spark, folder) == sorted([(i, f"n{i}", "b", None) for i in range(40)] * 2)


def test_a_replayed_load_batch_counts_once(spark, folder):
    os.mkdir(f"{folder}/in")
    put(f"{folder}/in/a.csv", QUOTES)
    load(spark, folder)
    # The batch was written, but not noted by the stream: it runs again.
    for name in os.listdir(f"{folder}/out/checkpoint/commits"):
        os.unlink(f"{folder}/out/checkpoint/commits/{name}")
    load(spark, folder)
    assert len(loaded(spark, folder)) == 2


def test_loading_shuffles_no_rows(spark, folder):
    os.mkdir(f"{folder}/in")
    put(f"{folder}/in/a.csv", QUOTES)
    load(spark, folder)
    read = plan(csv_tables.loaded_rows(spark, f"{folder}/out", SCHEMA))
    assert "BroadcastHashJoin" in read and "SortMergeJoin" not in read


def test_load_of_an_empty_folder(spark, folder):
    os.mkdir(f"{folder}/in")
    assert load(spark, folder) == [] and loaded(spark, folder) == []


def test_overwrite_replaces_rows_and_schema(spark, folder):
    csv_tables.overwrite_table(spark.range(3), "replaced", f"{folder}/t")
    csv_tables.overwrite_table(spark.sql("SELECT 'a' AS id, 1 AS more"), "replaced", f"{folder}/t")
    assert spark.table("replaced").dtypes == [("id", "string"), ("more", "int")]
    assert rows(spark.table("replaced")) == [("a", 1)]


def test_binary_and_text_landing(spark, folder):
    os.mkdir(f"{folder}/in")
    payload = bytes(range(256)) * 3
    with open(f"{folder}/in/a.pdf", "wb") as out:
        out.write(payload)
    put(f"{folder}/in/b.md", "# Ä\nzwei\n")
    landing.land_binary(spark, f"{folder}/in", f"{folder}/out", "*.pdf")
    [landed] = landing.decode_payloads(spark.read.parquet(f"{folder}/out")).collect()
    assert landed.file_name == "a.pdf" and landed.n_bytes == 768
    assert "\n" not in landed.payload and bytes(landed.content) == payload
    assert rows(landing.read_texts(spark, f"{folder}/in", "*.md")) == [("b.md", "# Ä\nzwei\n")]


def test_change_feed(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (5, None)], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, None), (6, "f")], "id int, v string")
    assert rows(snapshots.change_feed(before, after, "id")) == [
        (2, "update_postimage", "B"),
        (2, "update_preimage", "b"),
        (3, "update_postimage", "c"),
        (3, "update_preimage", None),
        (4, "delete", "d"),
        (6, "insert", "f"),
    ]


def test_null_and_empty_text_differ(spark):
    before = spark.createDataFrame([(1, None, "x")], "id int, v string, w string")
    after = spark.createDataFrame([(1, "", "x")], "id int, v string, w string")
    assert snapshots.change_feed(before, after, "id").count() == 2


def test_profile_and_readiness(spark):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    gap = spark.createDataFrame([(1, None)], "id int, v string")
    none = good.filter(F.lit(False))
    assert rows(profile.table_profile({"good": good, "none": none})) == [("good", 2, 2), ("none", 0, 2)]
    checks = {n: (df, ["id"], ["v"]) for n, df in dict(good=good, twice=twice, gap=gap, none=none).items()}
    assert rows(profile.readiness(checks)) == [
        ("*", False, False, False, False),
        ("gap", True, True, False, False),
        ("good", True, True, True, True),
        ("none", False, True, True, False),
        ("twice", True, False, True, False),
    ]
    assert profile.readiness({"good": (good, ["id"], ["v"])}).filter("table_name = '*'").first().ready


def test_changes_of_a_microsecond_are_seen(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        before = spark.sql(f"SELECT 1 AS id, CAST('2024-01-01 00:00:00.123456' AS {kind}) AS ts")
        after = spark.sql(f"SELECT 1 AS id, CAST('2024-01-01 00:00:00.123457' AS {kind}) AS ts")
        assert snapshots.change_feed(before, after, "id").count() == 2
        assert snapshots.change_feed(before, before, "id").count() == 0


def test_a_null_key_is_a_key(spark):
    frame = lambda *held: spark.createDataFrame(held, "id int, v string")
    same, changed, gone = frame((None, "a"), (1, "b")), frame((None, "c"), (1, "b")), frame((1, "b"))
    assert snapshots.change_feed(same, same, "id").count() == 0
    assert rows(snapshots.change_feed(same, changed, "id")) == [(None, "update_postimage", "c"), (None, "update_preimage", "a")]
    assert rows(snapshots.change_feed(same, gone, "id")) == [(None, "delete", "a")]
    assert rows(snapshots.change_feed(gone, same, "id")) == [(None, "insert", "a")]
