"""Repeatable sample data: every value is a hash of the row number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.scalars import pad_number

# Fixed values of the sample domain.
COUNTRIES = ["US", "GB", "DE", "JP", "CH"]
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CHF"]
ACCOUNT_TYPES = ["EQUITY", "FIXED_INCOME", "MULTI_ASSET", "ALTERNATIVES"]
INSTRUMENT_TYPES = ["EQUITY", "BOND", "ETF", "FUTURE", "OPTION"]
STATUS_OF_TEN = ["PENDING", "PENDING", "CANCELLED", "FAILED"] + ["SETTLED"] * 6
DAYS = 90


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _draw(salt: str, below: int, row: Column) -> Column:
    return F.pmod(F.xxhash64(row, F.lit(salt)), F.lit(below))


def _instrument(number: Column) -> Column:
    return F.concat(F.lit("ISIN-"), _pick(COUNTRIES, number % len(COUNTRIES)), pad_number(number, 10))


def sample_accounts(spark: SparkSession, count: int = 500) -> DataFrame:
    n = F.col("id")
    return spark.range(count).select(
        F.concat(F.lit("ACCT-BR-"), pad_number(n, 3)).alias("ACCOUNT_ID"),
        F.concat(F.lit("Portfolio "), n.cast("string")).alias("ACCOUNT_NAME"),
        _pick(ACCOUNT_TYPES, n % len(ACCOUNT_TYPES)).alias("ACCOUNT_TYPE"),
    )


def sample_instruments(spark: SparkSession, count: int = 2000) -> DataFrame:
    n = F.col("id")
    return spark.range(count).select(
        _instrument(n).alias("INSTRUMENT_ID"),
        F.concat(F.lit("Instrument "), n.cast("string")).alias("INSTRUMENT_NAME"),
        _pick(INSTRUMENT_TYPES, n % len(INSTRUMENT_TYPES)).alias("INSTRUMENT_TYPE"),
        _pick(CURRENCIES, n % len(CURRENCIES)).alias("CURRENCY"),
    )


def sample_transactions(
    spark: SparkSession, count: int, today: str, first: int = 0, accounts: int = 500, instruments: int = 2000
) -> DataFrame:
    """Payload-shaped text rows; any range of row numbers gives the same rows every time."""
    n = F.col("id")
    booked = F.date_sub(F.lit(today).cast("date"), _draw("day", DAYS, n).cast("int"))
    cents = _draw("amount", 49_999_000, n) + 1000
    return spark.range(first, first + count).select(
        F.concat(F.lit("TXN-"), pad_number(n, 10)).alias("TXN_ID"),
        F.concat(F.lit("ACCT-BR-"), pad_number(_draw("account", accounts, n), 3)).alias("ACCOUNT_ID"),
        _instrument(_draw("instrument", instruments, n)).alias("INSTRUMENT_ID"),
        F.concat(cents.cast("string"), F.lit("."), pad_number(_draw("digits", 10000, n), 4)).alias("AMOUNT"),
        _pick(CURRENCIES, _draw("currency", 5, n)).alias("CURRENCY"),
        F.date_format(booked, "yyyy-MM-dd").alias("TXN_DATE"),
        F.date_format(F.date_add(booked, (_draw("settle", 3, n) + 1).cast("int")), "yyyy-MM-dd").alias(
            "SETTLEMENT_DATE"
        ),
        _pick(STATUS_OF_TEN, _draw("status", 10, n)).alias("STATUS"),
    )
