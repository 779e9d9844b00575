"""Parameterised reports on the loaded tables. Each returns a DataFrame; the caller shows or writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardlens.functions import in_month, in_range, money_sum, money_total
from cardlens.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, lookup_join
from cardlens.params import parse_card, parse_date_bound, parse_month, parse_ssn, parse_zip
from cardlens.schemas import MONTH_COLUMN
from cardlens.sources.buckets import Buckets, join_buckets


def transactions_by_zip_month(
    credit: DataFrame,
    customer: DataFrame,
    zip_code: int | str,
    year: int | str,
    month: int | str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Transactions of a month by customers of a zip code, newest first.

    The order ends with the transaction id: it is total, and the sort can cut a busy day into several
    tasks.
    """
    wanted = customer.where(F.col("CUST_ZIP") == parse_zip(zip_code)).select(
        F.col("SSN").alias("CUST_SSN"), "CUST_ZIP"
    )
    made = credit.where(in_month(credit, parse_month(year, month))).select(
        "CUST_SSN", "CUST_CC_NO", "TIMEID", "TRANSACTION_VALUE", "TRANSACTION_ID"
    )
    return (
        lookup_join(made, wanted, "CUST_SSN", ["TRANSACTION_ID"], max_broadcast_bytes=max_broadcast_bytes)
        .orderBy(F.desc("TIMEID"), "TRANSACTION_ID")
        .select("CUST_SSN", "CUST_CC_NO", "CUST_ZIP", "TIMEID", "TRANSACTION_VALUE")
    )


def stored_transactions_by_zip_month(
    credit: Buckets, customer: Buckets, zip_code: int | str, year: int | str, month: int | str
) -> DataFrame:
    """``transactions_by_zip_month`` of tables stored in buckets of the customer: neither side is shuffled or
    broadcast, and customers with much of all transactions are read by many tasks."""
    wanted = F.col("CUST_ZIP") == parse_zip(zip_code)
    yyyymm = parse_month(year, month)
    joined = join_buckets(
        credit, customer,
        lambda df: df.where(in_month(df, yyyymm)).select(
            "CUST_SSN", "CUST_CC_NO", "TIMEID", "TRANSACTION_VALUE", "TRANSACTION_ID"
        ),
        lambda df: df.where(wanted).select("SSN", "CUST_ZIP"),
        ["TRANSACTION_ID"],
    )
    return joined.orderBy(F.desc("TIMEID"), "TRANSACTION_ID").select(
        "CUST_SSN", "CUST_CC_NO", "CUST_ZIP", "TIMEID", "TRANSACTION_VALUE"
    )


def type_totals(credit: DataFrame, transaction_type: str) -> DataFrame:
    """Number and value of the transactions of one type; no row for an unknown type."""
    return (
        credit.where(F.col("TRANSACTION_TYPE") == transaction_type)
        .groupBy("TRANSACTION_TYPE")
        .agg(
            F.count("TRANSACTION_TYPE").alias("NUMBER_OF_TRANSACTIONS"),
            money_sum(F.col("TRANSACTION_VALUE")).alias("TOTAL_VALUE_OF_TRANSACTIONS"),
        )
    )


def branch_totals(
    branch: DataFrame, credit: DataFrame, state: str, count_preserved: bool = False
) -> DataFrame:
    """Number and value of transactions of each branch in a state, branches without any included.

    Both sides are reduced to one row per branch before they meet, so the join neither grows nor skews
    with a busy branch, and its shuffle is the aggregates' own. If the state's branches are measured to
    be few enough to broadcast, only their transactions are aggregated at all. ``count_preserved``
    counts the branch's own row, which makes an empty branch 1 instead of 0.
    """
    wanted = branch.where(F.col("BRANCH_STATE") == state).select("BRANCH_CODE")
    sites = wanted.groupBy("BRANCH_CODE").agg(F.count("BRANCH_CODE").alias("_rows"))
    made = credit.where(F.col("BRANCH_CODE").isNotNull())
    if fits_broadcast(wanted):
        made = made.join(F.broadcast(wanted), "BRANCH_CODE", "left_semi")
    activity = (
        made.groupBy("BRANCH_CODE")
        .agg(F.count("*").alias("_n"), money_total(F.col("TRANSACTION_VALUE")).alias("_value"))
    )
    without = F.lit(1 if count_preserved else 0)
    return sites.join(activity, "BRANCH_CODE", "left").select(
        "BRANCH_CODE",
        (F.col("_rows") * F.coalesce("_n", without)).alias("TOTAL_NUMBER_OF_TRANSACTIONS"),
        F.round(F.col("_rows").cast("decimal(18,0)") * F.col("_value"), 2).cast("double").alias("TOTAL_VALUE_OF_TRANSACTIONS"),
    )


def customer_account(
    customer: DataFrame, ssn: int | str | None = None, card: str | None = None
) -> DataFrame:
    """All columns of one customer, looked up by SSN or by card number."""
    if (ssn is None) == (card is None):
        raise ValueError("look a customer up by either ssn or card")
    if ssn is not None:
        return customer.where(F.col("SSN") == parse_ssn(ssn))
    return customer.where(F.col("CREDIT_CARD_NO") == parse_card(card))


def monthly_bill(
    credit: DataFrame, card: str | None, year: int | str, month: int | str
) -> DataFrame:
    """Total of a card in a month; no row without activity. ``card=None`` bills every card at once."""
    rows = credit if card is None else credit.where(F.col("CUST_CC_NO") == parse_card(card))
    rows = rows.where(in_month(credit, parse_month(year, month)))
    return rows.groupBy("CUST_CC_NO").agg(money_sum(F.col("TRANSACTION_VALUE")).alias("MONTHLY_BILL"))


def transactions_between(
    credit: DataFrame, card: str, start: int | str, end: int | str
) -> DataFrame:
    """A card's transactions between two dates, both included, newest first."""
    return (
        credit.where(F.col("CUST_CC_NO") == parse_card(card))
        .where(in_range(credit, parse_date_bound(start), parse_date_bound(end)))
        .orderBy(F.desc("TIMEID"), "TRANSACTION_ID")
        .drop(MONTH_COLUMN)
    )
