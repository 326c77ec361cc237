from datetime import date

import pytest
from pyspark.sql import functions as F

from marketgrain.errors import AnalyticsError
from marketgrain.functions import cleaning
from marketgrain.plans import contract, overlay, privacy, quality
from marketgrain.sources import sinks
from tests.conftest import rows


def orders(spark, total="8.00"):
    df = spark.createDataFrame(
        [(1, 1, "paid", "web", "10.00", "2.00", total), (2, 9, "draft", "pos", "5.00", "0.00", "5.00")],
        "order_id int, customer_id int, status string, channel string, subtotal string, discount string, total string",
    )
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("subtotal", "discount", "total")}
    at = F.lit("2026-01-02 10:00:00").cast("timestamp_ntz")
    return df.withColumns(money).withColumns({"placed_at": at, "created_at": at})


def checks(spark, df, parents=((1,), (9,)), keyed=None):
    customers = spark.createDataFrame(list(parents), "customer_id int")
    inventory = spark.createDataFrame([("orders", 2), ("customers", 2)], "table_name string, rows bigint")
    empty = spark.createDataFrame([], "section string")
    return quality.quality_checks(
        df, keyed or {"orders": (df, "order_id")}, [quality.Edge("c", df, "customer_id", customers, "customer_id")],
        ["placed_at", "status", "channel", "total"], inventory, ["orders", "customers"], empty,
    )


def test_all_checks_pass(spark):
    found = {r["check"]: (r["status"], r["value"]) for r in checks(spark, orders(spark)).collect()}
    assert found == {
        "inventory": ("pass", 2), "required_sources_missing": ("pass", 0), "primary_keys": ("pass", 0),
        "foreign_keys": ("pass", 0), "core_completeness": ("pass", 0), "order_arithmetic": ("pass", 0),
        "privacy": ("pass", 0),
    }
    quality.gate(checks(spark, orders(spark)))


def test_a_cent_is_tolerated_and_more_is_a_warning(spark):
    exact = checks(spark, orders(spark, "8.01")).where("check = 'order_arithmetic'").first()
    more = checks(spark, orders(spark, "8.02"))
    assert exact["status"] == "pass"
    assert more.where("check = 'order_arithmetic'").first()["status"] == "warning"
    quality.gate(more)


def test_orphans_duplicates_and_nulls_close_the_gate(spark):
    with pytest.raises(AnalyticsError, match="foreign_keys=1"):
        quality.gate(checks(spark, orders(spark), parents=((1,),)))
    twice = orders(spark).union(orders(spark))
    with pytest.raises(AnalyticsError, match="primary_keys=2"):
        quality.gate(checks(spark, twice))
    with pytest.raises(AnalyticsError, match="core_completeness=1"):
        quality.gate(checks(spark, orders(spark, None)))


def test_null_references_are_orphans(spark):
    child = spark.createDataFrame([(1,), (None,), (7,), (7,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(quality.orphan_report([quality.Edge("e", child, "k", parent, "k")])) == [("e", 2, 3)]


def test_null_keys_are_not_duplicates(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int")
    assert rows(quality.key_report({"t": (df, "k")})) == [("t", 2, 1)]


def test_cutoff_report(spark):
    report = lambda day: {
        r["check"]: (r["status"], r["value"], r["share_pct"])
        for r in quality.cutoff_report(orders(spark), day, ["draft", "cancelled"], ["order_id"]).collect()
    }
    before = report(date(2026, 1, 1))
    assert before["doubtful_status"] == ("attention", 1, 50.0) and before["after_cutoff"] == ("attention", 2, 100.0)
    assert report(date(2026, 1, 2))["after_cutoff"] == ("ok", 0, 0.0)


def test_text_hygiene(spark):
    df = spark.createDataFrame([("",), (None,), (" x",), ("x\t",), ("N/A",), (" - ",), ("fine",)], "t string")
    assert rows(quality.text_hygiene(df, ["t"])) == [("t", 2, 3, 2)]


def test_privacy_finds_fields_and_addresses(spark):
    safe = spark.createDataFrame([("Profile 01", 1.0)], "label string, value double")
    nested = spark.sql("select named_struct('email', 'x') as who, array(named_struct('note', 'a@b')) as notes")
    found = {r["section"]: (r["forbidden_fields"], r["rows_with_at_sign"]) for r in privacy.report({"s": safe, "n": nested}).collect()}
    assert found == {"s": ("", 0), "n": ("email", 1)}
    assert privacy.forbidden_fields(spark.createDataFrame([(1, 2)], "customer_id int, Postal_Code int")) == ["Postal_Code", "customer_id"]
    privacy.enforce({"s": safe})
    with pytest.raises(AnalyticsError, match="n"):
        privacy.enforce({"s": safe, "n": nested})


def test_numbers_in_local_style(spark):
    cases = {
        "R$ 1.234,56": 1234.56, "1.234,56": 1234.56, "12,5": 12.5, "12.5": 12.5, " 7 ": 7.0, "-3": -3.0,
        "1e3": 1000.0, "abc": None, "": None, "1,2,3": None, "inf": None, "NaN": None, None: None,
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, expected double")
    got = cleaning.cleaned_numbers(df, "t")
    assert got.where("not (t_number <=> expected)").count() == 0
    assert got.where("t_rejected").count() == 5
    assert cleaning.cleaned_numbers(df, "t", default=0).where("t_number is null").count() == 0


def test_aliases_prefer_exact_names(spark):
    df = spark.createDataFrame([(1, 2, None), (3, None, 5)], "revenue int, VALUE int, amount int")
    assert rows(df.select(cleaning.first_alias(df, ["value", "amount", "revenue"]))) == [(1,), (5,)]
    assert rows(df.select(cleaning.first_alias(df, ["missing"], F.lit(9)))) == [(9,), (9,)]
    shaped = cleaning.normalized(spark.createDataFrame([("2026-01", 5), (None, 6)], "periodo string, total int").withColumnRenamed("periodo", "Month"), ["month", "value"], ["orders"])
    assert rows(shaped) == [("2026-01", 5, None)]


def test_overlay_by_value_and_by_section(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("b", None), ("a", 9), ("c", 3)], "id string, v int")
    assert sorted(rows(overlay.overlay_values(base, new, ["id"], ["v"]))) == [("a", 9), ("b", 2), ("c", 3)]
    first = spark.createDataFrame([("s", 1), ("s", 2), ("t", 3)], "section string, v int")
    second = spark.createDataFrame([("s", 7)], "section string, v int")
    assert sorted(rows(overlay.overlay_sections(first, second))) == [("s", 7), ("t", 3)]


def test_document_round_trip_and_required_sections(spark, tmp_path):
    cards = spark.createDataFrame([(2, "b", 1.5), (1, "a", 0.5)], "position int, id string, value double")
    parts = {"rows": contract.as_list(cards, ["position"]), "one": contract.as_object(cards.where("position = 1"))}
    doc = contract.document(spark, {name: parts for name in contract.REQUIRED_SECTIONS})
    path = str(tmp_path / "doc")
    sinks.write_document(doc, path)
    again = overlay.published_sections(spark, path, doc.schema)
    assert again.first().asDict(True) == doc.first().asDict(True)
    assert [r["id"] for r in again.first()["sales"]["rows"]] == ["a", "b"]
    assert overlay.published_sections(spark, str(tmp_path / "absent"), doc.schema) is None
    with pytest.raises(AnalyticsError, match="quality"):
        contract.require_sections(doc.drop("quality"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_document(doc, path)


def test_document_is_judged_as_a_whole(spark, tmp_path):
    text = """{"a": {"list": [{"Customer_Id": 1}, {"deep": [["x@y", null, true], []]}]}, "email": {}, "b": [1.5, {"c": "plain"}], "n": -2}"""
    frame = spark.createDataFrame([(text,), ('{"email_sent": 3, "address": "x"}',)], "document string")
    found = sorted(rows(privacy.leaves(frame)), key=str)
    assert {r[0]: (r[2], r[3], r[4]) for r in found} == {
        ".a.list[0].Customer_Id": ("number", None, 1.0), ".a.list[1].deep[0][0]": ("string", "x@y", None),
        ".a.list[1].deep[0][1]": ("null", None, None), ".a.list[1].deep[0][2]": ("boolean", "true", None),
        ".a.list[1].deep[1]": ("empty", None, None), ".email": ("empty", None, None), ".b[0]": ("number", None, 1.5),
        ".b[1].c": ("string", "plain", None), ".n": ("number", None, -2.0), ".email_sent": ("number", None, 3.0),
        ".address": ("string", "x", None),
    }
    named = sorted(rows(privacy.document_findings(privacy.leaves(frame))))
    assert named == [
        (".a.list[0].Customer_Id", "forbidden field"), (".a.list[1].deep[0][0]", "at sign"),
        (".address", "forbidden field"), (".email", "forbidden field"),
    ]
    with pytest.raises(AnalyticsError, match="deep.*at sign"):
        privacy.enforce_document(frame)


def test_document_is_written_only_behind_its_gates(spark, tmp_path):
    def doc_of(label):
        cards = spark.createDataFrame([(1, label)], "position int, id string")
        parts = {"rows": contract.as_list(cards, ["position"])}
        return contract.document(spark, {name: parts for name in contract.REQUIRED_SECTIONS})

    passed = spark.createDataFrame([("keys", "pass", 0), ("sums", "warning", 2)], "check string, status string, value bigint")
    failed = spark.createDataFrame([("keys", "fail", 3)], "check string, status string, value bigint")
    for name, doc, checks, reason in (("a", doc_of("x"), failed, "keys=3"), ("b", doc_of("me@home"), passed, "personal data")):
        with pytest.raises(AnalyticsError, match=reason):
            sinks.write_document(doc, str(tmp_path / name), checks)
        assert not (tmp_path / name).exists()
    sinks.write_document(doc_of("x"), str(tmp_path / "c"), passed)
    assert (tmp_path / "c").exists()


def test_values_json_cannot_hold_are_refused(spark):
    bad = spark.createDataFrame([(1, float("nan"))], "position int, value double")
    with pytest.raises(Exception, match="value is not a finite number"):
        contract.document(spark, {"s": {"rows": contract.as_list(bad, ["position"])}}).collect()


def test_view_export_quotes_only_where_needed(spark, tmp_path):
    sections = {
        "cards": spark.createDataFrame([("a;b", 1234567.0, 'say "x"'), ("plain", 0.5, "line\nbreak")], "id string, value double, format string"),
        "monthly": spark.createDataFrame([("2026-01", 2, 10.0)], "month string, orders int, revenue double"),
        "channels": spark.createDataFrame([("pos", 2, 10.25, 50.0)], "channel string, orders int, revenue double, order_share_pct double"),
    }
    path = str(tmp_path / "view")
    sinks.write_view(sinks.view_export(sections, "overview"), path)
    (part,) = (tmp_path / "view").glob("part-*")
    lines = part.read_bytes().decode().split("\r\n")
    assert lines[0] == "secao;dimensao;periodo;metrica;valor;detalhe"
    assert lines[1] == 'indicador_executivo;"a;b";;"say ""x""";1234567;'
    assert lines[2] == 'indicador_executivo;plain;;"line\nbreak";0.5;'
    assert lines[3:5] == ["serie_mensal;valor_bruto_registrado;2026-01;valor_bruto;10;2 pedidos", "canal;pos;;valor_bruto;10.25;2 pedidos"]


def test_fixed_digits_in_csv(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.createDataFrame([(1, 2 / 3)], "id int, v double"), path, {"v": 6})
    assert rows(spark.read.option("header", True).csv(path)) == [("1", "0.666667")]
