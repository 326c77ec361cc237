"""Places of bad records, contents of a load, runs of unused keys, one scan for all keys."""

import csv
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain.errors import IngestError, PublishError
from marketgrain.plans import profile, quality
from marketgrain.sources import contents, csv_files, publish, tables
from tests.conftest import rows

DECLARED = (
    T.StructType().add("id", "integer").add("amount", "decimal(8,2)").add("day", "date").add("note", "string")
)


@pytest.fixture
def table(spark, tmp_path):
    def make(text, name="t"):
        folder = tmp_path / "drop"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.csv").write_text(text, newline="")
        return str(folder), csv_files.examine(spark, str(folder))[0]

    return make


def places(bad):
    order = ["record", "column_name"]
    return rows(bad.select("record", "found", "column_name", "expected_type").orderBy(*order))


def test_widths_and_values_are_located(spark, table):
    text = (
        "id,amount,day,note\n1,2.50,2024-01-02,\"a, \"\"b\"\"\"\n2,1.5,2024-01-02\n3,x,2024-02-30,ok\n"
        "4,,,\n5,1,2024-01-02,a,b\n6,1,2024-01-02,c\"d,\n"
    )
    _, t = table(text)
    assert t.splittable and t.columns == ("id", "amount", "day", "note")
    assert places(csv_files.bad_records(spark, t, DECLARED)) == [
        (3, 3, None, None), (4, 4, "amount", "decimal(8,2)"), (4, 4, "day", "date"),
        (6, 5, None, None), (7, 5, None, None),
    ]
    assert places(csv_files.bad_records(spark, t)) == [
        (3, 3, None, None), (6, 5, None, None), (7, 5, None, None),
    ]


def test_records_that_span_lines_are_numbered_as_records(spark, table):
    text = 'id,amount,day,note\n1,2,2024-01-02,"a\n\nb"\n2,z,2024-01-02,"c"\n3,1,"2024-01-02"x,d\n4,1\n'
    _, t = table(text)
    assert not t.splittable
    assert places(csv_files.bad_records(spark, t, DECLARED)) == [
        (3, 4, "amount", "decimal(8,2)"), (4, None, None, None), (5, 2, None, None),
    ]


def test_header_only_and_sound_tables_have_none(spark, table):
    _, t = table("id,amount,day,note\n")
    assert places(csv_files.bad_records(spark, t, DECLARED)) == []
    _, t = table("id,amount,day,note\r\n1,1,2024-01-02,x\r\n")
    assert places(csv_files.bad_records(spark, t, DECLARED)) == []


@pytest.mark.parametrize("spanning", [False, True])
def test_numbers_hold_over_many_splits_and_files(spark, tmp_path, spanning):
    """Compared with a plain count of the records; a split holds a few lines."""
    folder, chance = tmp_path / "drop" / "t.csv", random.Random(5)
    folder.mkdir(parents=True)
    expected = []
    for part in ("a", "b"):
        with open(folder / f"{part}.csv", "w", newline="") as out:
            out.write("id,note\n")
            for i in range(2, 402):
                note = "x\ny" if spanning and i % 3 == 0 else "x" * chance.randrange(30)
                fields = [str(i), note] if chance.random() > 0.1 else [str(i)] * chance.choice([1, 3])
                if len(fields) != 2:
                    expected.append((f"{part}.csv", i, len(fields)))
                csv.writer(out, lineterminator="\n").writerow(fields)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        (t,) = csv_files.examine(spark, str(tmp_path / "drop"))
        bad = csv_files.bad_records(spark, t)
        found = rows(bad.select(F.element_at(F.split("file", "/"), -1), "record", "found"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert t.splittable is not spanning
    assert sorted(found) == sorted(expected) and expected


def test_errors_name_the_place_and_not_the_value(spark, table, tmp_path):
    folder, _ = table("id,note\n1,a\n2,secret,c\n3\n")
    with pytest.raises(IngestError, match=r"2 bad records, the first is record 3 of .*t\.csv: 3 fields for 2") as e:
        csv_files.inspect(spark, folder)
    assert "secret" not in str(e.value)


def test_a_declared_type_stops_the_load_at_its_place(spark, table, tmp_path):
    folder, _ = table("id,amount,day,note\n1,2.50,2024-01-02,a\n2,secret,2024-01-02,b\n")
    target = str(tmp_path / "target")
    with pytest.raises(IngestError, match="record 3 of .*column 'amount' is no decimal") as e:
        publish.load_folder(spark, folder, target, declared={"t": DECLARED})
    assert "secret" not in str(e.value) and publish.current(spark, target) == {}
    with pytest.raises(IngestError, match="declared"):
        publish.load_folder(spark, folder, target, declared={"t": T.StructType(DECLARED.fields[:2])})


def test_a_declared_type_replaces_the_inferred_one(spark, table, tmp_path):
    folder, _ = table("id,amount,day,note\n1,2,2024-01-02,7\n")
    target = str(tmp_path / "target")
    publish.load_folder(spark, folder, target, declared={"t": DECLARED}, contents=True)
    assert publish.open_table(spark, target, "t").schema == DECLARED


TEXTS = "n string, d string, m string, b string, s string"
TYPES = (
    T.StructType().add("n", "long").add("d", "decimal(9,3)").add("m", T.TimestampNTZType())
    .add("b", "boolean").add("s", "string")
)
SOURCE = [
    ("+7", "1.50", "2024-01-02T03:04", "TRUE", ""),
    ("-0", ".5", "2024-01-02", "false", None),
    (None, "-0.000", None, None, "x"),
    ("12", "1e2", "2024-01-02 03:04:05,25", "true", "x"),
    ("0", "100", None, "False", " x"),
]


def typed(spark, source=SOURCE):
    from marketgrain.sources import inference

    return inference.typed(spark.createDataFrame(source, TEXTS), TYPES)


def test_contents_agree_whatever_the_spelling_and_the_order(spark):
    source = spark.createDataFrame(SOURCE[::-1], TEXTS).repartition(3)
    found = contents.compare(source, typed(spark), TYPES)
    assert rows(found.where("not reconciled")) == [] and found.count() == 6


@pytest.mark.parametrize(
    ("column", "value"), [("n", 13), ("d", None), ("s", ""), ("b", True), ("m", None)]
)
def test_a_changed_cell_is_noticed_in_its_column(spark, column, value):
    kind = TYPES[column].dataType
    changed = F.when(F.col("s") == " x", F.lit(value).cast(kind)).otherwise(F.col(column))
    if column == "m":
        changed = F.when(F.col("s") != "", F.col("m"))
    stored = typed(spark).withColumn(column, changed)
    found = contents.compare(spark.createDataFrame(SOURCE, TEXTS), stored, TYPES)
    assert {r["column_name"] for r in found.where("not reconciled").collect()} == {column, "*"}


def test_values_that_change_rows_are_noticed_in_the_records(spark):
    swapped = [(b[0], *a[1:]) for a, b in zip(SOURCE, SOURCE[1:] + SOURCE[:1])]
    found = contents.compare(spark.createDataFrame(SOURCE, TEXTS), typed(spark, swapped), TYPES)
    assert [r["column_name"] for r in found.where("not reconciled").collect()] == ["*"]


def test_contents_of_nothing(spark):
    empty = spark.createDataFrame([], TEXTS)
    found = contents.compare(empty, typed(spark, []), TYPES)
    assert {(r["source_digest"], r["reconciled"]) for r in found.collect()} == {("0", True)}


def test_a_load_that_stores_other_values_is_not_published(spark, table, tmp_path, monkeypatch):
    folder, _ = table("id,note\n1,a\n2,b\n")
    target, kept = str(tmp_path / "target"), publish.inference.typed

    def faulty(frame, schema):
        return kept(frame, schema).withColumn("note", F.upper("note"))

    monkeypatch.setattr(publish.inference, "typed", faulty)
    with pytest.raises(PublishError, match=r"contents of 't' differ from the source: \['\*', 'note'\]"):
        publish.load_folder(spark, folder, target, contents=True)
    assert publish.current(spark, target) == {}


@pytest.mark.parametrize(
    ("keys", "expected"),
    [
        ([], []), ([None], []), ([4], []), ([4, 4, None, 5], []),
        ([-3, 1, 2, 2, 9], [(-2, 0, 3), (3, 8, 6)]),
    ],
)
def test_runs_of_unused_keys(spark, keys, expected):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    assert sorted(rows(profile.id_gap_ranges(df, "k"))) == expected


def test_runs_are_found_across_the_borders_of_ranges(spark):
    df = spark.range(0, 60_000, 1, 7).where("id % 3 != 0").withColumn("id", -F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted(rows(profile.id_gap_ranges(df, "id")))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == sorted((-i, -i, 1) for i in range(3, 59_999, 3))


def test_all_keys_and_references_take_one_scan_a_table_and_one_shuffle(spark, tmp_path):
    spark.range(100).selectExpr("id as o", "id % 7 as c").write.parquet(str(tmp_path / "orders"))
    spark.range(5).selectExpr("id as c", "id as n").write.parquet(str(tmp_path / "customers"))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    facts = quality.key_facts(
        {"orders": (read("orders"), "o"), "customers": (read("customers"), "c")},
        [quality.Edge("oc", read("orders"), "c", read("customers"), "c"),
         quality.Edge("on", read("orders"), "o", read("customers"), "n")],
    )
    assert sorted(rows(facts)) == [
        ("edge", "oc", 0, 0, 2, 28), ("edge", "on", 0, 0, 95, 95),
        ("key", "customers", 0, 0, 0, 0), ("key", "orders", 0, 0, 0, 0),
    ]
    plan = facts._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall("FileScan", plan)) == 2
    final = facts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(number#\d+, key#\d+", final)) == 1


@pytest.mark.parametrize("text", [" 2024-01-02", "2024-01", "2024-01-02 10:00:00Z", "", "2024-02-30"])
def test_texts_a_cast_would_take_are_no_strict_moments(spark, text):
    df = spark.createDataFrame([(1, text), (2, "2024-01-02T03:04:05,5"), (3, None)], "id int, at string")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(tables.strict_moment(df["at"])).collect()
    good, rejected = tables.quarantine_moments(df, "at", ["id"])
    shown = good.select("id", F.col("at").cast("string"))
    assert sorted(rows(shown)) == [(2, "2024-01-02 03:04:05.5"), (3, None)]
    assert rows(rejected) == [(1, "at")]


def test_a_hot_reference_costs_one_row_a_task(spark):
    child = spark.range(0, 30_000, 1, 4).selectExpr("if(id % 3 = 0, 1, id) as k")
    parent = spark.range(30_000).selectExpr("id as k").where("k != 1")
    assert rows(quality.orphan_report([quality.Edge("e", child, "k", parent, "k")])) == [("e", 1, 10_001)]


def test_keys_of_unlike_types_and_empty_tables(spark):
    child = spark.createDataFrame([("1",), ("2",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    empty = spark.createDataFrame([], "k int")
    found = quality.orphan_report(
        [quality.Edge("a", child, "k", parent, "k"), quality.Edge("b", empty, "k", parent, "k"),
         quality.Edge("c", parent, "k", empty, "k")]
    )
    assert sorted(rows(found)) == [("a", 2, 2), ("b", 0, 0), ("c", 2, 2)]
    assert rows(quality.key_report({"e": (empty, "k")})) == [("e", 0, 0)]


def test_numbers_have_one_text(spark):
    shown = {"+007": "7", "-0": "0", "-0.00": "0", "0": "0", "000": "0", ".5": "0.5", "-.50": "-0.5", "5.": "5", "-12.340": "-12.34", "100": "100", None: ""}
    frame = spark.createDataFrame([(k, v) for k, v in shown.items()], "text string, wanted string")
    found = frame.select("wanted", contents._plain_number(F.col("text")).alias("plain")).collect()
    assert all(r["wanted"] == r["plain"] for r in found)


def test_digests_are_added_up_by_column(spark):
    """A row per hash within the task and sums of whole numbers; equal to exact sums."""
    values = [None, "", *map(str, range(3000))]
    schema = T.StructType([T.StructField("a", T.StringType())])
    found = contents.digests(spark.createDataFrame([(v,) for v in values], schema), schema, is_text=True)
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    hashes = [md5("" if v is None else "=" + v) for v in values]
    wanted = {"a": sum(int(h[:15], 16) for h in hashes), "*": sum(int(md5(h)[:15], 16) for h in hashes)}
    assert {r["column_name"]: int(r["digest"]) for r in found.collect()} == wanted
    assert "decimal" not in found._jdf.queryExecution().optimizedPlan().toString().lower().split("posexplode")[1].split("aggregate")[0]
    empty = contents.digests(spark.createDataFrame([], schema), schema, is_text=True)
    assert {tuple(r) for r in empty.collect()} == {("a", "0"), ("*", "0")}


def test_records_are_put_together_from_short_runs(spark, tmp_path, monkeypatch):
    """What is put in order at once is a few lines, however large a split is; records may
    span the runs."""
    monkeypatch.setattr(csv_files, "RUN_LINES", 3)
    text = [f'a{i}\n"b""\n\n{i},"\nc' if i % 3 else f"plain {i}" for i in range(60)]
    path = tmp_path / "t.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["k", "text"])
        writer.writerows(enumerate(text))
    (table,) = csv_files.inspect(spark, str(tmp_path))
    found = {int(r["k"]): r["text"] for r in csv_files.read_text(spark, table).collect()}
    assert found == dict(enumerate(text))
    plan = csv_files._spanning_lines(spark, table.files)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"\[file#\d+, split#\d+L?, run#\d+L?\], \[place", plan)


def test_columns_are_judged_by_compiled_code(spark):
    from marketgrain.sources import inference

    wide = spark.range(5).selectExpr(*[f"cast(id * {i} as string) as c{i}" for i in range(60)])
    plan = inference.evidence(wide, wide.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "posexplode" in plan
