"""Comparing two tables that should agree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sluiceway.functions.scalars import elapsed
from sluiceway.operators.profile import attach, distinct_count


def table_totals(rows: DataFrame, prefix: str, amount: str, key: str, dims: tuple[str, str], loaded_at: str) -> DataFrame:
    """One row: total amount, rows, latest load, exact distinct key and dimension counts.

    Amount, row count, latest load and both dimensions come from one scan that
    collapses to dimension combinations inside the tasks.  Keys need their own
    shuffle, which carries nothing but the key.  A single aggregate with three
    distinct counts would instead copy every row four times.
    """
    first, second = dims
    combos = rows.groupBy(first, second).agg(
        F.sum(amount).alias("_amount"), F.count(F.lit(1)).alias("_n"), F.max(loaded_at).alias("_latest")
    )
    small = combos.agg(
        F.sum("_amount").alias(f"{prefix}_AMOUNT"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias(f"{prefix}_ROWS"),
        F.max("_latest").alias(f"{prefix}_LATEST"),
        F.count_distinct(first).alias(f"{prefix}_DISTINCT_{first}"),
        F.count_distinct(second).alias(f"{prefix}_DISTINCT_{second}"),
    )
    return attach(small, distinct_count(rows, key, f"{prefix}_DISTINCT_{key}"))


# The sums of key hashes among the facts; a stored fact without them is of an older version.
KEY_SUMS = [f"{name}_{i}" for name in ("keys", "more_keys") for i in range(3)]


def fact_totals(facts: dict[str, DataFrame], dims: tuple[str, str]) -> dict[str, Row]:
    """Per prefix the values of `table_totals` but for the keys, from facts (rows, amount, latest, key sums per member of the
    dimensions); all tables in one plan.

    Facts can be as many as the rows, so sums are reduced to a row per table inside the tasks, and only the members of
    a dimension are shuffled to be counted.  `keys` is None if some fact has no key sums.
    """
    first, second = dims
    every = reduce(DataFrame.unionByName, [f.withColumn("side", F.lit(p)) for p, f in facts.items()])
    sums = ["rows", "amount", *KEY_SUMS]
    unknown = F.count_if(F.col(KEY_SUMS[0]).isNull()).alias("unknown")
    found = every.groupBy("side").agg(*[F.sum(n).alias(n) for n in sums], F.max("latest").alias("latest"), unknown)
    for name, column in (("first", first), ("second", second)):
        members = every.select("side", column).distinct().groupBy("side").agg(F.count(column).alias(name))
        found = found.join(F.broadcast(members), "side", "left")  # a row per table
    rows = {r.side: r.asDict() for r in found.collect()}
    none = dict.fromkeys([*sums, "latest"]) | {"rows": 0, "first": 0, "second": 0, "unknown": 0}
    totals = {}
    for prefix in facts:
        r = rows.get(prefix, none)
        totals[prefix] = Row(**{
            f"{prefix}_AMOUNT": r["amount"], f"{prefix}_ROWS": r["rows"], f"{prefix}_LATEST": r["latest"],
            f"{prefix}_DISTINCT_{first}": r["first"], f"{prefix}_DISTINCT_{second}": r["second"],
            "keys": None if r["unknown"] else tuple(r[n] for n in KEY_SUMS),
        })
    return totals


def with_key_counts(mart: Row, staging: Row, key: str, mart_rows: DataFrame, staging_rows: DataFrame) -> DataFrame:
    """Both totals with distinct key counts, as one row.

    Equal row counts and equal sums of two hashes mean equal keys, whose distinct counts do not differ: then the row counts
    stand for them, as only their difference is judged.  Otherwise the keys of both tables are counted.
    """
    alike = mart["SDM_ROWS"] == staging["STG_ROWS"] and mart["keys"] is not None and mart["keys"] == staging["keys"]
    known: dict = {}
    for total, prefix, rows in ((mart, "SDM", mart_rows), (staging, "STG", staging_rows)):
        known |= {n: v for n, v in total.asDict().items() if n != "keys"}
        name = f"{prefix}_DISTINCT_{key}"
        known[name] = total[f"{prefix}_ROWS"] if alike else distinct_count(rows, key, name).first()[0]
    kinds = {"AMOUNT": "decimal(38,4)", "LATEST": "timestamp_ntz"}
    shape = ", ".join(f"{n} {kinds.get(n[4:], 'bigint')}" for n in known)
    return mart_rows.sparkSession.createDataFrame([tuple(known.values())], shape)


def consistency(mart: DataFrame, staging: DataFrame) -> DataFrame:
    """The cross-table metrics, from the two one-row totals.

    The distinct counts are compared, not the sets; see `missing_references` for
    an exact comparison of members.  TABLE_ROWS is reported, not judged.
    """
    # Two rows, each with one side's columns, folded into one.
    stacked = mart.unionByName(staging, allowMissingColumns=True)
    return compared(stacked.agg(*[F.max(c).alias(c) for c in stacked.columns]))


def compared(both: DataFrame) -> DataFrame:
    """The cross-table metrics from one row with both tables' totals."""
    m, s = (lambda n: F.col(f"SDM_{n}")), (lambda n: F.col(f"STG_{n}"))
    zero = F.lit(0)
    return both.select(
        F.abs(F.coalesce(m("AMOUNT"), zero) - F.coalesce(s("AMOUNT"), zero)).alias("amount_matches_stg"),
        (F.abs(m("ROWS") - s("ROWS")) / F.greatest(s("ROWS"), F.lit(1)) * 100).alias("row_count_within_1pct"),
        F.abs(m("DISTINCT_TXN_ID") - s("DISTINCT_TXN_ID")).alias("distinct_txn_id_matches_stg"),
        (s("DISTINCT_ACCOUNT_ID") - m("DISTINCT_ACCOUNT_ID")).alias("all_accounts_in_sdm"),
        (s("DISTINCT_CURRENCY") - m("DISTINCT_CURRENCY")).alias("all_currencies_in_sdm"),
        F.coalesce(elapsed("MINUTE", m("LATEST"), s("LATEST")), zero).alias("sdm_within_30min_of_stg"),
        m("ROWS").alias("TABLE_ROWS"),
    )


def lag_minutes(behind: DataFrame, ahead: DataFrame, loaded_at: str) -> DataFrame:
    """Whole minutes between the newest rows of two tables."""
    a = behind.agg(F.max(loaded_at).alias("behind_latest"))
    b = ahead.agg(F.max(loaded_at).alias("ahead_latest"))
    return attach(a, b).withColumn(
        "lag_minutes", elapsed("MINUTE", F.col("behind_latest"), F.col("ahead_latest"))
    )
