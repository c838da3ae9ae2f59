
import datetime as dt

from pyspark.sql import functions as F

from silverline.functions import scalars as X


def _one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_json_text_scalars_and_missing(spark):
    docs = [('{"a":{"b":"x"}}',), ('{"a":null}',), ('{"a":{"c":1}}',), ('not json',),
            ('{"a":[1,2]}',), ('{"b":1}',), ('{"a":{"b":130}}',), (None,)]
    got = _one(spark, X.json_text("t", "$.a.b"), docs, "t string")
    assert got == ["x", "", "", "", "", "", "130", ""]
    # a path that lands on an object or array is not a scalar: ''
    got = _one(spark, X.json_text("t", "$.a"), docs, "t string")
    assert got == ["", "", "", "", "", "", "", ""]


def test_json_text_string_that_looks_like_json_is_kept(spark):
    got = _one(spark, X.json_text("t", "$.d"), [('{"d":"{not an object"}',), ('{"d":"[x]"}',)], "t string")
    assert got == ["{not an object", "[x]"]


PATHS = {"c": "$.code.coding[0].code", "m": "$.code.coding[1].code", "v": "$.v", "o": "$.code", "s": "$.s"}


def test_with_json_fields_equals_one_path_at_a_time(spark):
    docs = ['{"code":{"coding":[{"code":"I10"}]}}', '{"code":{"coding":{"code":"x"}},"v":120.0}', '{"v":1.50}',
            '{"v":"120.0","s":"{not an object"}', '{"v":"[1]","s":"[x]","a":1,"a":2}', '{"v":{"x":1},"s":[1]}',
            '{"v":[1],"s":{"b":2},"a":1,"a":2}', '{"v":null,"s":true}', '{"v":1,', "not json", "", "[1,2]", "7", None,
            '{"s":"{\\"really\\":1}"}', '{"s":"-5","v":-1e3}', '{"code":"plain"}']
    df = spark.createDataFrame([(i, d, "kept") for i, d in enumerate(docs)], "id int, t string, _json_doc_ string")
    got = {r["id"]: r for r in X.with_json_fields(df, "t", PATHS).collect()}
    one = {r["id"]: r for r in df.select("id", *[X.json_text("t", p).alias(n) for n, p in PATHS.items()]).collect()}
    for i in got:
        assert {n: got[i][n] for n in PATHS} == {n: one[i][n] for n in PATHS}, docs[i]
    assert got[1]["v"] == "120.0" and got[2]["v"] == "1.5" and got[3]["s"] == "{not an object"
    assert (got[5]["v"], got[5]["s"], got[6]["v"], got[6]["s"], got[0]["o"]) == ("", "", "", "", "")
    assert set(X.with_json_fields(df, "t", {"c": "$.v"}).columns) == {"id", "t", "_json_doc_", "c"}


def test_with_json_fields_of_very_large_and_repeated_keys(spark):
    df = spark.range(3).select(F.when(F.col("id") == 0, F.concat(
        F.lit('{"text":"'), F.repeat(F.lit("x"), 30_000_000), F.lit('","s":"ok","v":{"a":1}}')))
        .when(F.col("id") == 1, F.lit('{"s":"first","s":"second","v":3}'))
        .otherwise(F.lit('{"v":1,"x":2,"x":3,"s":"ok"}')).alias("t"))
    got = X.with_json_fields(df, "t", {"s": "$.s", "v": "$.v"}).select("s", "v").collect()
    assert [(r.s, r.v) for r in got] == [("ok", ""), ("first", "3"), ("ok", "1")]


def test_number_columns_may_change_their_spelling_only(spark):
    df = spark.createDataFrame([('{"v":120.0}',), ('{"v":"1.50"}',), ('{"v":7}',), ('{"v":{"a":1}}',)], "t string")
    got = X.with_json_fields(df, "t", {"v": "$.v"}, numbers=("v",)).select(X.to_double_or_null("v").alias("n")).collect()
    assert [r.n for r in got] == [120.0, 1.5, 7.0, None]


def test_body_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "t string")
    plan = X.with_json_fields(df, "t", PATHS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_date_layouts(spark):
    july = dt.date(2026, 7, 3)
    rows = [("2026/07/03",), ("2026/7/3 23:30",), ("20260703",), ("20260703T090900Z",), ("20260703T003000+0700",),
            ("20260703101500",), ("03 Jul 2026",), ("3 Jul 2026 10:00:05",), ("1783040000",), ("999999999",),
            ("20261399",), ("2026/13/01",), ("12345678901234567890",), ("99 Foo 2026",), ("1 2 3",)]
    got = _one(spark, X.fhir_date("t"), rows, "t string")
    epoch = dt.date(1970, 1, 1)
    assert got == [july, july, july, july, dt.date(2026, 7, 2), july, july, july, july, dt.date(2001, 9, 9),
                   epoch, epoch, epoch, epoch, epoch]


def test_fhir_date_takes_utc_day_and_epoch_fallback(spark):
    rows = [("2026-07-03T00:30:00+07:00",), ("2026-07-03T09:09:00+07:00",), ("2026-07-03",),
            ("",), ("abc",), ("03/07/2026",), (None,)]
    got = _one(spark, X.fhir_date("t"), rows, "t string")
    epoch = dt.date(1970, 1, 1)
    assert got == [dt.date(2026, 7, 2), dt.date(2026, 7, 3), dt.date(2026, 7, 3),
                   epoch, epoch, epoch, epoch]


def test_to_double_or_null(spark):
    rows = [("1.5d",), ("NaN",), ("",), ("abc",), ("120",), ("1e2",), ("-0.5",), (".5",),
            ("inf",), (" 1",), (None,)]
    got = _one(spark, X.to_double_or_null("t"), rows, "t string")
    assert got == [None, None, None, None, 120.0, 100.0, -0.5, 0.5, None, None, None]


def test_ptm_category_prefix_rule(spark):
    rows = [("E15",), ("I19",), ("",), ("i10",), ("I10",), ("E11.9",), ("J06.9",)]
    got = _one(spark, X.ptm_category("c"), rows, "c string")
    assert got == ["Diabetes Melitus", "Hipertensi", "Lainnya", "Lainnya", "Hipertensi",
                   "Diabetes Melitus", "Lainnya"]


def test_bp_category_three_valued_logic(spark):
    rows = [(120.0, None), (145.0, None), (0.0, 0.0), (None, None), (120.0, 80.0),
            (135.0, 80.0), (120.0, 92.0), (None, 86.0), (0.0, None)]
    got = _one(spark, X.bp_category("s", "d"), rows, "s double, d double")
    assert got == ["Normal", X.BP_HYPERTENSION, None, None, "Normal", X.BP_ELEVATED,
                   X.BP_HYPERTENSION, X.BP_ELEVATED, None]


def test_epoch_literal_type(spark):
    df = spark.range(1).select(X.epoch_ts().alias("e"))
    assert df.schema["e"].dataType.typeName() == "timestamp_ntz"
    assert df.first().e == dt.datetime(1970, 1, 1)


def test_no_python_udf_in_scalars(spark):
    df = spark.createDataFrame([('{"valueQuantity":{"value":"12"}}', "2026-07-03")], "t string, d string")
    out = df.select(X.to_double_or_null(X.json_text("t", "$.valueQuantity.value")), X.fhir_date("d"),
                    F.lit(1))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_json_text_large_and_repeated_keys_and_number_spelling(spark):
    from pyspark.sql import functions as F
    docs = [('{"v":1,"a":2,"a":3}',), ('{"v":120.0}',), ('{"v":1.50}',), ('{"v":120}',), ('{"v":"120.0"}',),
            ('{"v":{"x":1},"v":2}',), ('{"v":1,',), ('{"a":{"v":1},"a":2}',)]
    got = _one(spark, X.json_text("t", "$.v"), docs, "t string")
    assert got[:5] == ["1", "120.0", "1.5", "120", "120.0"] and got[6:] == ["", ""]
    long = spark.range(2).select(F.when(F.col("id") == 0, F.concat(
        F.lit('{"text":"'), F.repeat(F.lit("x"), 30_000_000), F.lit('","status":"ok"}'))).otherwise(F.concat(
            F.lit('{"list":['), F.repeat(F.lit('"some short text",'), 8_000_000), F.lit('"end"],"status":"ok"}'))).alias("t"))
    assert [r[0] for r in long.select(X.json_text("t", "$.status")).collect()] == ["ok", "ok"]


def test_dates_need_a_year_and_follow_the_report_zone(spark):
    rows = [("10:00:00",), ("T10:00",), ("2026-07-03T23:30:00Z",), ("2026",), ("12026-01-01",)]
    epoch = dt.date(1970, 1, 1)
    assert _one(spark, X.fhir_date("t"), rows, "t string") == [
        epoch, epoch, dt.date(2026, 7, 3), dt.date(2026, 1, 1), epoch]
    assert _one(spark, X.fhir_date("t", "Asia/Jakarta"), rows[2:3], "t string") == [dt.date(2026, 7, 4)]


def test_numbers_are_whole_texts_and_finite(spark):
    rows = [("120\n",), ("1e999",), ("-1e999",), ("1e3",)]
    assert _one(spark, X.to_double_or_null("t"), rows, "t string") == [None, None, None, 1000.0]
