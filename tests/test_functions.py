from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from compare import rows
from strataline.functions.text import clean_customers, clean_email, clean_name, clean_phone
from strataline.functions.values import money, or_unknown, parse_date, snake_case


def apply(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in frame.select("i", expression("v").alias("out")).orderBy("i").collect()]


def test_names_keep_letters_and_single_blanks(spark):
    given = ["Plain Name", "Ma#,,!r--y  Sm\tith9", "José Ruiz", "  42 ", None]
    assert apply(spark, clean_name, given) == ["Plain Name", "Mary Sm ith", "Jos Ruiz", "", None]


def test_emails_keep_word_characters_and_four_signs(spark):
    given = [" a.b+c-d_e@f.org;", "x(y)@z .de", "ü@q.eu", None]
    assert apply(spark, clean_email, given) == ["a.b+c-d_e@f.org", "xy@z.de", "@q.eu", None]


def test_phones_keep_digits_of_the_extension_and_need_ten(spark):
    given = ["321.555.0199x4321", "(030) 123 4567", "n/a 45", "123-456-789", "1234567890", None]
    assert apply(spark, clean_phone, given) == [
        "32155501994321",
        "0301234567",
        None,
        None,
        "1234567890",
        None,
    ]


def test_customers_keep_other_columns_and_their_order(spark):
    given = spark.createDataFrame(
        [("c1", "A. B", "a b@c.d", "1", "1 Road; East", "12-345")],
        "customer_id string, customer_name string, email string, phone string, "
        "address string, postal string",
    )
    cleaned = clean_customers(given)
    assert cleaned.columns == given.columns
    assert rows(cleaned) == [("c1", "A B", "ab@c.d", None, "1 Road; East", "12-345")]


def test_digits_of_a_phone_are_matched_once(spark):
    given = spark.createDataFrame([("a", "b", "c")], "customer_name string, email string, phone string")
    plan = clean_customers(given)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\D") == 1


def test_dates_of_another_form_become_null(spark):
    given = ["17/5/2019", "04/09/2019", "1/13/2019", "2019-05-17", "1/2/19", "", " 1/2/2019", None]
    assert apply(spark, parse_date, given) == [date(2019, 5, 17), date(2019, 9, 4)] + [None] * 6


def test_money_rounds_half_up_to_an_exact_decimal(spark):
    frame = spark.createDataFrame([(2.345,), (-2.345,), (1.005,), (None,)], "v double")
    out = frame.select(money("v").alias("m"))
    assert out.schema["m"].dataType.simpleString() == "decimal(38,2)"
    assert [r.m for r in out.collect()] == [Decimal("2.35"), Decimal("-2.35"), Decimal("1.01"), None]


def test_only_null_becomes_unknown(spark):
    assert apply(spark, or_unknown, ["x", "", None]) == ["x", "", "unknown"]


def test_headers_are_lowered_and_blanks_replaced(spark):
    frame = spark.range(1).select(
        F.col("id").alias("Row ID"), F.col("id").alias("Sub-Category"), F.col("id").alias("a b C")
    )
    assert snake_case(frame).columns == ["row_id", "sub-category", "a_b_c"]
