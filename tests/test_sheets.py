"""Sheets numbered where they are read, and reports typed by the fields of their own responses."""

import datetime
import decimal
import json

import pytest

from sellerbooks.sources import publish, records

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    had = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "200")
    yield
    spark.conf.set(SPLIT, had)


def sheet_file(path, first, n):
    """A file of a sheet, some rows blank, some cells quoted, some rows short."""
    lines = ["Seller SKU,Unit Price,Note"]
    for i in range(first, first + n):
        lines.append("" if i % 17 == 5 else f"s{i}" if i % 13 == 2 else f's{i},"1,{i % 10}00",  x ' if i % 4 else f"s{i},{i},")
    path.write_text("\n".join(lines) + "\n")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_rows_are_numbered_alike_in_any_number_of_splits(spark, tmp_path, small_splits):
    sheet_file(tmp_path / "a.csv", 0, 400)
    sheet_file(tmp_path / "b.csv", 400, 150)
    (tmp_path / "c.csv").write_text("Seller SKU,Unit Price,Note\n")
    many = records.read_numbered_sheet(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = rows_of(many)
    spark.conf.set(SPLIT, "128m")
    assert got == rows_of(records.read_numbered_sheet(spark, str(tmp_path)))
    assert many.columns == ["row_index", "seller_sku", "unit_price", "note"]
    assert [r[0] for r in got] == list(range(550))
    assert all(r[1] == (None if i % 17 == 5 else f"s{i}") for i, r in enumerate(got))
    assert got[1][2:] == ("1,100", "  x ") and got[2] == (2, "s2", None, None) and got[4][2:] == ("4", None)


def test_numbers_stay_after_rows_are_filtered_and_written_again(spark, tmp_path):
    sheet = spark.range(300).selectExpr("concat(' n', id) name", "if(id % 3 = 0, null, '') note").orderBy("name")
    publish.write_csv(sheet, str(tmp_path / "out"))
    got = records.read_numbered_sheet(spark, str(tmp_path / "out"))
    names = sorted(f" n{i}" for i in range(300))
    assert [(r["row_index"], r["name"]) for r in got.filter("row_index >= 290").orderBy("row_index").collect()] == list(enumerate(names))[290:]
    assert got.filter("note IS NULL").count() == 300


def test_sheets_without_rows_and_with_a_clashing_column(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("A,B\n")
    assert records.read_numbered_sheet(spark, str(tmp_path / "empty.csv")).count() == 0
    (tmp_path / "clash.csv").write_text("Row Index,file,split,cells\n1,2,3,4\n")
    with pytest.raises(ValueError, match="row_index"):
        records.read_numbered_sheet(spark, str(tmp_path / "clash.csv"))
    assert rows_of(records.read_numbered_sheet(spark, str(tmp_path / "clash.csv"), "_n")) == [(0, "1", "2", "3", "4")]


KINDS = {3: ("Record ID#", "recordid"), 6: ("Name", "text"), 7: ("Paid", "currency"), 8: ("Due", "date"), 9: ("At", "timestamp"), 10: ("Done", "checkbox"), 11: ("Owner", "user"), 12: ("Wide", "numeric")}


def page(rows, kinds=KINDS, key="type"):
    data = [{str(i): {"value": v} for i, v in zip(kinds, row)} for row in rows]
    return json.dumps({"data": data, "fields": [{"id": i, "label": label, key: kind} for i, (label, kind) in kinds.items()]})


def test_report_takes_names_order_and_types_from_its_fields(spark, tmp_path):
    wide = 10**24 + 1
    (tmp_path / "1.json").write_text(page([[1, "a", 1.5, "2024-02-03", "2024-02-03T04:05:06Z", True, {"id": "x"}, wide]]))
    (tmp_path / "2.json").write_text(page([[2, " ", None, "", None, False, None, None], [3, "007", 2, None, "", None, "", 5]], key="fieldType"))
    out = records.read_typed_report(spark, str(tmp_path))
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert list(types) == ["Record_ID_Num", "Name", "Paid", "Due", "At", "Done", "Owner", "Wide"]
    assert types["Record_ID_Num"] == "bigint" and types["Paid"].startswith("decimal") and types["Wide"] == "decimal(38,0)"
    assert (types["Due"], types["At"], types["Done"], types["Name"]) == ("date", "timestamp", "boolean", "string")
    first, second, third = (r.asDict() for r in out.orderBy("Record_ID_Num").collect())
    assert first["Paid"] == decimal.Decimal("1.5") and first["Due"] == datetime.date(2024, 2, 3) and first["Wide"] == wide
    assert first["At"] == datetime.datetime(2024, 2, 3, 4, 5, 6) or first["At"].minute == 5
    assert json.loads(first["Owner"]) == {"id": "x"}
    assert [second[c] for c in types] == [2, None, None, None, None, False, None, None]
    assert [third[c] for c in types] == [3, "007", 2, None, None, None, None, 5]


def test_reports_that_cannot_be_typed(spark, tmp_path):
    def lines(name, *pages):
        (tmp_path / name).write_text("\n".join(pages))
        return records.read_typed_report(spark, str(tmp_path / name), pages_as_lines=True)

    one = {3: ("Record ID#", "recordid"), 8: ("Due", "date")}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lines("bad", page([[1, "soon"]], one)).collect()
    with pytest.raises(ValueError, match="differently"):
        lines("unlike", page([[1, None]], one), page([[2, None]], {3: ("Record ID#", "recordid"), 8: ("Due", "text")}))
    with pytest.raises(ValueError, match="same label"):
        lines("twice", page([[1, None]], {3: ("A B", "text"), 8: ("a_b", "text")}))
    with pytest.raises(ValueError, match="no fields"):
        lines("none", "")
    empty = lines("empty", page([], one))
    assert empty.count() == 0 and empty.columns == ["Record_ID_Num", "Due"]
