"""Raw dataset -> clean dataset, one narrow projection each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from cardlens.functions import cap_first, date_key, fill_zip, format_phone, full_address
from cardlens.functions.expressions import DEFAULT_ZIP
from cardlens.schemas import CORRUPT


def _unreadable(df: DataFrame) -> list[str]:
    return [CORRUPT] if CORRUPT in df.columns else []


def clean_branch(df: DataFrame) -> DataFrame:
    zip_code = F.col("BRANCH_ZIP")
    as_text = isinstance(df.schema["BRANCH_ZIP"].dataType, T.StringType)
    return df.select(
        "BRANCH_CODE",
        "BRANCH_NAME",
        "BRANCH_STREET",
        "BRANCH_CITY",
        "BRANCH_STATE",
        fill_zip(zip_code, str(DEFAULT_ZIP) if as_text else DEFAULT_ZIP).alias("BRANCH_ZIP"),
        format_phone(F.col("BRANCH_PHONE")).alias("BRANCH_PHONE"),
        "LAST_UPDATED",
        *_unreadable(df),
    )


def clean_credit(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("CREDIT_CARD_NO").alias("CUST_CC_NO"),
        date_key(F.col("YEAR"), F.col("MONTH"), F.col("DAY")).alias("TIMEID"),
        "CUST_SSN",
        "BRANCH_CODE",
        "TRANSACTION_TYPE",
        "TRANSACTION_VALUE",
        "TRANSACTION_ID",
        *_unreadable(df),
    )


def clean_customer(df: DataFrame) -> DataFrame:
    return df.select(
        "SSN",
        cap_first(F.col("FIRST_NAME")).alias("FIRST_NAME"),
        F.lower("MIDDLE_NAME").alias("MIDDLE_NAME"),
        cap_first(F.col("LAST_NAME")).alias("LAST_NAME"),
        "CREDIT_CARD_NO",
        full_address(F.col("STREET_NAME"), F.col("APT_NO")).alias("FULL_STREET_ADDRESS"),
        "CUST_CITY",
        "CUST_STATE",
        "CUST_COUNTRY",
        "CUST_ZIP",
        format_phone(F.col("CUST_PHONE")).alias("CUST_PHONE"),
        "CUST_EMAIL",
        "LAST_UPDATED",
        *_unreadable(df),
    )


_CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "branch": clean_branch,
    "credit": clean_credit,
    "customer": clean_customer,
    "loan": lambda df: df,
}


def clean(dataset: str, df: DataFrame) -> DataFrame:
    """Clean a dataset by its name; loan applications are taken as they are. The column of unreadable records,
    where the input has one, is kept: ``violation_counts`` counts it and ``unreadable`` lists it."""
    if dataset not in _CLEANERS:
        raise ValueError(f"unknown dataset {dataset!r}; known: {', '.join(_CLEANERS)}")
    return _CLEANERS[dataset](df)
