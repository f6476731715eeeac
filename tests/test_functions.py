import pytest
from pyspark.sql import functions as F

from tableflow.functions import cell_text, diff_seconds, now_text, parse_long, suffix_values, text_bytes


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"s {kind}").select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text, number",
    [("42", 42), ("-42", -42), ("+7", 7), ("007", 7), ("9223372036854775807", 2**63 - 1)]
    + [(bad, -99) for bad in ("", " 42", "42 ", "42\n", "4.0", "1e3", "x", "9223372036854775808", None, "+", "1L")],
)
def test_parse_long(spark, text, number):
    assert one(spark, parse_long("s"), text) == number


def test_diff_seconds(spark):
    start, end = F.lit("2024-02-28 23:59:58"), F.lit("2024-03-01 00:00:00")
    assert one(spark, diff_seconds(start, end)) == 86402
    assert one(spark, diff_seconds(end, start)) == -86402
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(spark, diff_seconds(F.lit("yesterday"), end))


def test_now_text(spark):
    text = one(spark, now_text())
    assert len(text) == 19 and text[4] == text[7] == "-" and text[10] == " " and text[13] == ":"


def test_suffix_values(spark):
    pairs = [("a:x", "1"), ("b:x", "2"), ("c:y", None), ("x:z", "3")]
    kind = "array<struct<name string, value string>>"
    assert one(spark, suffix_values("s", [":x", ":y", ":none", ""]), pairs, kind) == ["2", None, None, "3"]
    assert one(spark, suffix_values("s", [":x"]), [], kind) == [None]


def test_bytes(spark):
    assert one(spark, text_bytes("s"), "é") == "é".encode()
    assert one(spark, text_bytes("s"), None) == b""
    assert one(spark, cell_text(text_bytes("s")), "naïve ✓") == "naïve ✓"
    assert one(spark, cell_text("s"), None, "binary") is None
    assert one(spark, cell_text("s"), b"a\xffb", "binary") == "a�b"


def test_maps_at_any_depth_come_back(spark):
    from tableflow.functions import decode_value, encode_value

    df = spark.sql("""
        select struct(map(1, array(map('k', 2.5D)), 3, null) as m, 'x' as s) as a,
               array(struct(map(date '2020-01-01', 7) as d), null) as b,
               map(struct(1 as x), map(2, 'v')) as c,
               cast(null as struct<m: map<int, string>>) as d
    """)
    types = {field.name: field.dataType for field in df.schema}
    text = df.select(*[encode_value(F.col(n), t).alias(n) for n, t in types.items()])
    back = text.select(*[decode_value(F.col(n), t).alias(n) for n, t in types.items()])
    assert back.collect() == df.collect() and back.dtypes == df.dtypes
