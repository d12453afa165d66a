from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.functions import keywords as K, ratios as R, scalar as S
from tests.helpers import rows


def value(spark, column, **fields):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in fields.items()) or [F.lit(0).alias("x")])
    return df.select(column).first()[0]


@pytest.mark.parametrize("name", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_text_times_are_read_at_plus_eight_in_any_session_zone(spark, zone, name):
    zone(name)
    # 2024-03-01 08:00:00+08:00 is midnight UTC
    assert value(spark, S.datetime_to_ms(F.lit("2024-03-01 08:00:00"))) == 1_709_251_200_000
    assert value(spark, S.date_to_ms(F.lit("2024-03-01"))) == 1_709_222_400_000


def test_epoch_formats_follow_the_session_zone(spark, zone):
    zone("Asia/Shanghai")
    ms = F.lit(1_709_251_200_000)
    assert value(spark, S.ms_to_date(ms)) == "2024-03-01"
    assert value(spark, S.ms_to_datetime(ms)) == "2024-03-01 08:00:00"
    assert value(spark, S.ms_to_compact_date(ms)) == "20240301"


def test_units(spark):
    seconds = value(spark, S.epoch_to_timestamp(F.lit(1_709_251_200), "s").cast("string"))
    millis = value(spark, S.epoch_to_timestamp(F.lit(1_709_251_200_000), "ms").cast("string"))
    assert seconds == millis == "2024-03-01 00:00:00"
    with pytest.raises(ValueError):
        S.epoch_to_timestamp("x", "us")


def test_text_to_date_is_lenient(spark):
    assert value(spark, S.text_to_date(F.lit("2024-03-01 10:11:12"))) == "2024-03-01"
    assert value(spark, S.text_to_date(F.lit("2024-03-01"))) == "2024-03-01"
    for bad in ("yesterday", "now", "2024-13-01 00:00:00", ""):
        assert value(spark, S.text_to_date(F.lit(bad))) is None


def test_strict_and_lenient_casts(spark):
    assert value(spark, S.try_bigint(F.lit("x"))) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, S.to_bigint(F.lit("x")))


@pytest.mark.parametrize("days,hours,expected", [(7, 0, 7), (7, 23, 7), (8, 0, 8)])
def test_whole_days(spark, days, hours, expected):
    ms = 1_709_251_200_000 + (days * 24 + hours) * 3_600_000
    assert value(spark, S.whole_days_since(F.lit(ms), F.lit("2024-03-01"))) == expected


@pytest.mark.parametrize("member,expected", [("id", True), ("name", True), ("nam", False), ("id,name", False)])
def test_csv_membership_is_exact(spark, member, expected):
    assert value(spark, S.in_csv(F.lit("id,name,tm_id"), F.lit(member))) is expected


def test_unscaled_decimal(spark):
    assert value(spark, S.unscaled_decimal(F.lit("Ceqs"))) == Decimal("6499.00")


def test_names():
    assert S.camel("sink_row_key") == "sinkRowKey"
    assert S.snake("sinkRowKey") == "sink_row_key"
    assert S.snake(S.camel("category1_id")) == "category1_id"


def test_words_are_distinct_and_lower_case(spark):
    df = spark.createDataFrame([(1, "Red red-ring, RING 7"), (2, None), (3, " ,;")], "id int, text string")
    assert rows(K.split_keywords(df, "text").select("id", "keyword")) == [(1, "7"), (1, "red"), (1, "ring")]


def test_dictionary_takes_the_longest_word_first(spark):
    splitter = K.dictionary_words(["小米", "小米手机", "手机", "充电"])
    df = spark.createDataFrame([("小米手机充电Pro 12手机",), (None,)], "text string")
    words = [r[0] for r in K.split_keywords(df, "text", splitter=splitter).select("keyword").collect()]
    assert words == ["小米手机", "充电", "pro", "12", "手机"]


def test_ratio_with_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(R.safe_ratio("a", "b", 100)).collect()] == [None, 25.0, None]


def test_insurance_ratios(spark):
    terms = {c: float(i + 1) for i, c in enumerate(R.LIABILITY_TERMS)}
    base = {"company_id": "1", "owner_equity": 22.0, "total_liabilities": 134.0, **terms}
    data = [
        {**base, "business_type": "财险业务"},
        {**base, "business_type": "人身险业务", "owner_equity": 0.0, "total_liabilities": 0.0},
        {**base, "business_type": "其他"},
    ]
    got = {r["business_type"]: r for r in R.insurance_ratios(spark.createDataFrame(data)).collect()}
    assert set(got) == {"财险业务", "人身险业务"}
    assert got["财险业务"]["insurance_liabilities"] == sum(terms.values()) == 78.0
    assert got["财险业务"]["insurance_liability_ratio"] == 50.0
    assert got["财险业务"]["unpaid_claims_reserve_to_equity_ratio"] == 9.0 / 22.0
    assert got["人身险业务"]["insurance_liability_ratio"] is None
    assert got["人身险业务"]["unpaid_claims_reserve_to_equity_ratio"] is None


def test_solvency_ratios(spark):
    df = spark.createDataFrame(
        [("财险业务", 200.0, 50.0, 100.0, 80.0, 120.0), ("财险业务", 0.0, 50.0, 0.0, 0.0, 1.0)],
        "business_type string, admitted_assets double, admitted_liabilities double, minimum_capital double, "
        "beginning_actual_capital double, ending_actual_capital double",
    )
    assert [tuple(r)[1:] for r in R.solvency_ratios(df).collect()] == [(150.0, 50.0, 25.0), (None, None, None)]
