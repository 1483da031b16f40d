"""Column expressions that clean free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline import fixed_values as fixed


def _without(value: Column | str, unwanted: str) -> Column:
    """Text without the characters of a class, taken out a run at a time."""
    return F.regexp_replace(_column(value), f"{unwanted}+", "")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_name(value: Column | str) -> Column:
    """ASCII letters and single blanks only, no blank at either end."""
    letters = _without(value, fixed.NAME_JUNK)
    return F.trim(F.regexp_replace(letters, fixed.WHITESPACE_RUN, " "))


def clean_email(value: Column | str) -> Column:
    """Word characters and ``. @ + -`` only."""
    return _without(value, fixed.EMAIL_JUNK)


def digits(value: Column | str) -> Column:
    return _without(value, fixed.NON_DIGIT)


def clean_phone(value: Column | str) -> Column:
    """All digits, extension included; NULL when there are too few to dial."""
    return _dialable(digits(value))


def _dialable(found: Column) -> Column:
    return F.when(F.length(found) >= fixed.PHONE_MIN_DIGITS, found)


def clean_customers(
    customers: DataFrame,
    name: str = "customer_name",
    email: str = "email",
    phone: str = "phone",
) -> DataFrame:
    """The three cleaners in one projection; other columns pass unchanged.

    The digits of a phone number are bound once below the projection, so the
    expression is evaluated once for the length test and the value.
    """
    return customers.withColumns(
        {name: clean_name(name), email: clean_email(email), phone: digits(phone)}
    ).withColumn(phone, _dialable(F.col(phone)))
