"""Column functions, case by case."""

import datetime

import pytest
from pyspark.sql import functions as F

from paperloom import model
from paperloom.functions import geometry as G
from paperloom.functions import scoring as S
from paperloom.functions import text as X


def one(spark, column, **values):
    return spark.range(1).select(*[v.alias(k) if hasattr(v, "alias") else F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column.alias("out")).first().out


def box(*corners):
    return G.box(*[F.lit(c) for c in corners])


@pytest.mark.parametrize(
    ("a", "b", "iou", "covered"),
    [((0, 0, 10, 10), (0, 0, 10, 10), 1.0, 1.0), ((0, 0, 10, 10), (10, 0, 20, 10), 0.0, 0.0), ((0, 0, 10, 10), (5, 0, 15, 10), 1 / 3, 0.5), ((2, 2, 4, 4), (0, 0, 10, 10), 0.04, 1.0), ((0, 0, 0, 0), (0, 0, 0, 0), 0.0, 0.0)],
)
def test_overlap(spark, a, b, iou, covered):
    assert one(spark, G.iou(box(*a), box(*b))) == pytest.approx(iou)
    assert one(spark, G.covered(box(*a), box(*b))) == pytest.approx(covered)


def test_boxes(spark):
    assert tuple(one(spark, G.center(box(0, 0, 5, 7)))) == (2, 3)
    assert tuple(one(spark, G.padded(box(0, 0, 100, 10), F.lit(103), F.lit(50)))) == (0, 0, 103, 14)
    assert tuple(one(spark, G.clipped(box(-5, -5, -1, -1), F.lit(10), F.lit(10)))) == (0, 0, 1, 1)
    assert one(spark, G.scaled(box(1, 1, 2, 2), F.lit(0.1), F.lit(0.1))) is None
    assert [one(spark, G.aligned(F.lit(s))) for s in (0, 24, 72, 73, 120, 500)] == [48, 48, 96, 96, 96, 480]
    assert one(spark, G.longest_side(F.lit(560))) == 662


def test_page_images(spark):
    assert one(spark, G.estimated_dpi(F.lit(2480), F.lit(3508), F.lit(None).cast("int"))) in (299, 300)
    assert one(spark, G.estimated_dpi(F.lit(10), F.lit(10), F.lit(0))) == 72
    assert [one(spark, G.dpi_band(F.lit(d))) for d in (149, 150, 250)] == ["low", "mid", "high"]
    assert [one(spark, G.sauvola_window(F.lit(d))) for d in (50, 300)] == [7, 29]
    assert one(spark, G.quality_score(F.lit(40.0), F.lit(60.0), F.lit(200.0), F.lit(0.1), F.lit("low"))) == pytest.approx(round((0.3 + 1 + 1 + 1) / 4 * 0.85, 4))


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024년 5월 20일", (2024, 5, 20)), ("일시: 2024년5월1일 오전", (2024, 5, 1)), ("2024-5-1", (2024, 5, 1)), (" 2024.05.01 ", (2024, 5, 1)), ("2024/12/31", (2024, 12, 31)),
        ("70.01.02", (1970, 1, 2)), ("24.01.02", (2024, 1, 2)), ("2024년 13월 1일 2024-01-01", None), ("2024-02-30", None), ("", None), (None, None), ("soon", None),
    ],
)
def test_dates(spark, text, day):
    assert one(spark, X.parsed_date(F.lit(text).cast("string"))) == (datetime.date(*day) if day else None)


def test_empties(spark):
    values = [None, "", "  ", "None", "{}", "x"]
    assert [one(spark, X.empty_token(F.lit(v).cast("string"))) for v in values] == [True, True, False, True, True, False]
    assert [one(spark, X.blank(F.lit(v).cast("string"))) for v in values] == [True, True, True, False, False, False]


def test_patterns_match_at_the_start_and_know_other_digits(spark):
    assert one(spark, X.begins_with_match(F.lit("12ab"), r"\d+")) and not one(spark, X.begins_with_match(F.lit("ab12"), r"\d+"))
    assert one(spark, X.begins_with_match(F.lit("１２"), r"\d{2}$"))


def test_template(spark):
    args = (r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", "{1}년 {2:02d}월 {3:02d}일", 3)
    assert one(spark, X.template_normalized(F.lit("2024년5월20일"), *args)) == "2024년 05월 20일"
    assert one(spark, X.template_normalized(F.lit("none"), *args)) is None


def test_numbers(spark):
    assert one(spark, X.number(F.lit("1,234.5 "))) == 1234.5 and one(spark, X.number(F.lit("x"))) is None


@pytest.mark.parametrize(
    ("text", "value"),
    [('{"a": 1}', "1"), ('say ```json\n{"a": 2}\n``` done', "2"), ('the answer is {"a": 3, "b": {"c": 1}} I think', "3"), ("[1]", None), ("nothing", None), (None, None)],
)
def test_tolerant_json(spark, text, value):
    assert one(spark, X.json_at(X.tolerant_json(F.lit(text).cast("string")), "a")) == value


def test_html_cells(spark):
    html = "<table><tr><th>a</th><td> <b>x</b> </td></tr>\n<TR><td>1</td></TR></table>"
    assert [tuple(c) for c in one(spark, X.html_cells(F.lit(html)))] == [(0, 0, "a"), (0, 1, "x"), (1, 0, "1")]


def test_codes(spark):
    found = one(spark, X.codes_in(F.lit("1005-01-432-1234 and KN-12345-0001, 123부대 on 2024-05-06; 1005-01-432-1234"), model.CODE_PATTERNS))
    # the long number also begins like a date
    assert [tuple(c) for c in found] == [("nsn", "1005-01-432-1234"), ("k_nsn", "KN-12345-0001"), ("unit_code", "123부대"), ("date", "1005-01-43"), ("date", "2024-05-06")]


def test_paths(spark):
    assert [one(spark, X.field_of_path(F.lit(p))) for p in ("checklist_items[2]", "writer.name", "request_date", "applicant.address")] == ["result_item_3", "writer_block", "request_date", None]
    kinds = {"nsn": "code", "unit_price": "amount", "request_date": "date", "stock_qty": "quantity", "overall_result": "handwritten", "seal_note": "seal", "signature_present": "signature", "bid_name": "code", "text": "text"}
    assert {p: one(spark, X.leaf_type(F.lit(p))) for p in kinds} == kinds
    assert tuple(one(spark, X.cell_place(F.lit("r_0001_r2c3"), F.lit("r_0001")))) == (2, 3)
    assert one(spark, X.cell_place(F.lit("r_0002_r2c3"), F.lit("r_0001"))) is None
    assert one(spark, X.page_id(F.lit("d"), F.lit(3))) == "d_p03"


def test_token_confidence(spark):
    logs = lambda *x: F.array(*[F.lit(float(v)) for v in x]) if x else F.array().cast("array<double>")
    assert one(spark, S.token_confidence(logs(), F.lit("text"))) == 0.0
    assert one(spark, S.token_confidence(logs(-0.02, -0.05, -0.01), F.lit("number"))) == pytest.approx(0.9737, abs=1e-4)
    assert one(spark, S.token_confidence(logs(*[0.0] * 20), F.lit("text"))) == pytest.approx(0.5)
    assert one(spark, S.token_confidence(logs(-100), F.lit("text"))) == 0.0


def test_lookups(spark):
    assert [one(spark, model.nearest_budget(F.lit(b))) for b in (140, 280, 350, 840, 2000)] == [140, 140, 140, 560, 1120]
    assert [one(spark, model.least_confidence(F.lit(t))) for t in ("currency", "nsn", "flag", "signature")] == [0.99, 0.97, 0.90, 0.70]
    assert one(spark, model.region_type(F.lit("Doc_Title"))) == "header" and one(spark, model.region_type(F.lit("?"))) == "text"
    assert one(spark, model.skill(F.lit("figure"))) is None
