import base64
import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from sluice import functions as X


def one(spark, column, **values):
    """The value of a column expression over one row of literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("code, course, version", [
    ("UE_203_ABC100_1_2024_HØST", "ABC100", "1"),
    ("XX_999_ABC100_1", " ", " "),
    (None, " ", " "),
    ("UE_203_ABC100", "ABC100", None),
])
def test_code_parts(spark, code, course, version):
    found = spark.createDataFrame([(code,)], "c string").select(
        X.code_part(F.col("c"), 2, "203").alias("a"), X.code_part(F.col("c"), 3, "203").alias("b")).first()
    assert tuple(found) == (course, version)


@pytest.mark.parametrize("text, teacher, number, room", [
    ("A. Teacher<br>ID: 12345<br>", "A. Teacher", "12345", "A. Teacher"),
    ("no marker", "no marker", None, "no marker"),
    ("ID:77<b>", "ID:77<b>", "77", "ID:77"),
    ("R101 <a href='x'>", "R101 <a href='x'>", None, "R101"),
    ("ID: <", "ID: <", None, "ID:"),
    (None, None, None, None),
])
def test_text_cuts(spark, text, teacher, number, room):
    c = F.col("c")
    found = spark.createDataFrame([(text,)], "c string").select(
        X.teacher(c).alias("t"), X.timeedit_id(c).alias("n"), X.room_name(c).alias("r")).first()
    assert tuple(found) == (teacher, number, room)


def test_between_takes_line_breaks_and_special_marks(spark):
    c = F.col("c")
    rows = spark.createDataFrame([("a [b] x\ny|z",)], "c string")
    assert rows.select(X.between(c, "[b]", "|").alias("x")).first()["x"] == "x\ny"


def test_joined_key_is_null_with_a_null_part(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None)], "p string, q int")
    found = [r[0] for r in rows.select(X.joined_key(F.col("p"), F.col("q"))).collect()]
    assert found == ["a_1", None]


def test_times(spark):
    parsed = X.parse_time(F.col("c"))
    rows = spark.createDataFrame([("2024-10-30T08:18:48Z",), ("None",), (None,), ("nan",)], "c string")
    found = [r[0] for r in rows.select(parsed.cast("string")).collect()]
    assert found == ["2024-10-30 08:18:48", None, None, None]
    numbers = spark.createDataFrame([(5236.0,), (None,), (7.9,)], "c double")
    assert [r[0] for r in numbers.select(X.whole_number(F.col("c"))).collect()] == [5236, 0, 7]
    assert X.yesterday(dt.datetime(2024, 3, 1, 5)) == dt.datetime(2024, 2, 29)
    assert X.yesterday_noon(dt.datetime(2024, 3, 1, 5)) == dt.datetime(2024, 2, 29, 12)
    assert X.stamp_date("2024-10-30T08:18:48Z") == "2024-10-30"


@pytest.mark.parametrize("name, span", [
    ("2024 HØST", (2024.5, 2024.5)), ("2024 VÅR", (2024.0, 2024.0)), ("2024 HØST-2025 VÅR", (2024.5, 2025.0)),
    ("2023 VÅR-2027 HØST", (2023.0, 2027.5)), ("2023 VÅR-2024 HØST-9999 X", (2023.0, 2024.5)),
    ("Standardsemester", (None, None)), ("2024HØST", (None, None)), ("Vår 2018", (None, None)),
    ("ABCD HØST", (None, None)), ("2024 HØST - 2025 VÅR", (None, None)), ("2024 VÅR x-2025 HØSTEN", (2024.0, 2025.0)), ("2024-2025", (None, None)),
    ("2024 høst", (None, None)), (None, (None, None)),
])
def test_term_span(spark, name, span):
    rows = spark.createDataFrame([(name,)], "c string").select(X.term_span(F.col("c")).alias("s"))
    assert tuple(rows.first()["s"]) == span


def test_calendar_rules(spark):
    days = [dt.date(2024, m, 15) for m in (1, 4, 5, 6, 7, 8, 12)]
    d = F.col("d")
    rows = spark.createDataFrame([(x,) for x in days], "d date").select(
        X.half_year(d), X.semester_name(d), X.catalogue_term(d), X.description_year(d)).collect()
    assert [tuple(r) for r in rows] == [
        (2024.0, "VÅR", "VAR", 2023), (2024.0, "VÅR", "VAR", 2023), (2024.0, "VÅR", "VAR", 2024),
        (2024.0, "VÅR", "VAR", 2024), (2024.0, "VÅR", "HOST", 2024), (2024.5, "HØST", "HOST", 2024),
        (2024.5, "HØST", "HOST", 2024)]
    assert [X.half_year(x) for x in days] == [2024.0] * 5 + [2024.5] * 2


@pytest.mark.parametrize("name, end", [
    ("2024 HØST", (2024, 12)), ("2024 vår", (2024, 7)), ("Vår 2018", (2018, 7)), ("Standardsemester", (2024, 7)),
    ("EVEG VÅR", (2024, 7)), ("2023 HØST-2025 VÅR", (2025, 7)), ("AB1C HØST", (None, 12)), ("other", (None, 12)),
    ("x-2025", (2025, 12)),
])
def test_legacy_term_end(spark, name, end):
    rows = spark.createDataFrame([(name,)], "c string").select(
        X.legacy_term_end(F.col("c"), dt.date(2024, 3, 1)).alias("s"))
    assert tuple(rows.first()["s"]) == end


@pytest.mark.parametrize("key", [b"short", b"x" * 64, b"longer than one block " * 5])
def test_pseudonym_equals_hmac(spark, key):
    texts = ["user", "Ærlig Ødegård", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "c string").select(X.pseudonym(F.col("c"), key)).collect()
    wanted = [
        None if t is None else base64.b64encode(hmac.new(key, t.encode(), hashlib.sha256).digest()).decode()
        for t in texts
    ]
    assert [r[0] for r in rows] == wanted


def test_link_relations(spark):
    header = ('<https://x.example/a?page=1>; rel="current",<https://x.example/a?page=2>; rel="next", '
              '<https://x.example/a?page=9>; rel="last",<https://x.example/a?page=3>; rel="next"')
    assert one(spark, X.link_relations(F.col("h")), h=header) == {
        "current": "https://x.example/a?page=1", "next": "https://x.example/a?page=3",
        "last": "https://x.example/a?page=9"}


PEOPLE = "array<struct<navn:struct<f:string,e:string>,bruker:struct<id:string>>>"


@pytest.mark.parametrize("people, text", [
    ([(("Åse", 'Ny"man\\'), ("a1",)), (("Bo\n", None), ("b2",))],
     json.dumps([["Åse", 'Ny"man\\', "a1"], ["Bo\n", None, "b2"]], ensure_ascii=False)),
    ([], "[]"),
    (None, '"Ikkje registrert"'),
    ([(("A", "B"), ("c",)), (("A", "B"), None)], '"Ikkje registrert"'),
    ([None], '"Ikkje registrert"'),
])
def test_people_json(spark, people, text):
    rows = spark.createDataFrame([(people,)], f"p {PEOPLE}").select(X.people_json(
        F.col("p"), lambda p: [p["navn"]["f"], p["navn"]["e"], p["bruker"]["id"]],
        lambda p: p["navn"].isNotNull() & p["bruker"].isNotNull()))
    assert rows.first()[0] == text


def test_descriptions(spark):
    schema = "d array<struct<k:string,l:string,t:string>>"
    entries = [("EBLUB", "NNO", "first"), ("EBARB", "ENG", None), ("EBLUB", "NNO", "last"), ("EBXXX", "NNO", "?"), None]
    columns = X.descriptions(F.col("d"), lambda e: e["k"], lambda e: e["l"], lambda e: e["t"])
    rows = spark.createDataFrame([(entries,), (None,), ([],)], schema).select(
        *[c.alias(k) for k, c in columns.items()]).collect()
    no = "Ikkje registrert"
    assert rows[0].asDict() == {
        "LUB_NNO": "last", "LUB_NOB": no, "LUB_ENG": no, "ARB_NNO": no, "ARB_NOB": no, "ARB_ENG": None}
    assert set(rows[1]) == set(rows[2]) == {no}


def test_fallback_period_goes_by_the_whole_struct(spark):
    schema = "a struct<y:int,c:string>, b struct<y:int,c:string>"
    rows = spark.createDataFrame([((1, None), (2, "x")), (None, (2, "x")), (None, None)], schema)
    found = [r[0] and tuple(r[0]) for r in rows.select(X.fallback_period(F.col("a"), F.col("b"))).collect()]
    assert found == [(1, None), (2, "x"), None]


@pytest.mark.parametrize("text, number", [
    ("12", 12), (" -7 ", -7), ("+3", 3), ("9223372036854775807", 2**63 - 1), ("-9223372036854775808", -(2**63)),
    ("9223372036854775808", None), ("99999999999999999999999", None), ("00000000000000000000000000012", 12),
    ("1.5", None), ("", None), ("x", None), (None, None), ("- 1", None),
])
def test_parse_whole(spark, text, number):
    rows = spark.createDataFrame([(text,)], "c string")
    assert rows.select(X.parse_whole(F.col("c"))).first()[0] == number
    small = number if number is not None and abs(number) < 2**31 else None
    assert rows.select(X.parse_whole(F.col("c"), "int")).first()[0] == small


def test_link_header_with_commas_in_a_url(spark):
    text = '<https://x/a?ids=1,2,3&page=2>; rel="next", <https://x/a?ids=1,2>; rel="first"'
    found = spark.createDataFrame([(text,)], "h string").select(X.link_relations(F.col("h")).alias("m")).first()["m"]
    assert found == {"next": "https://x/a?ids=1,2,3&page=2", "first": "https://x/a?ids=1,2"}
