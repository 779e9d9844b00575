"""The frames behind the charts: counts, leaders, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardlens.functions import month_name, month_of
from cardlens.operators.aggregates import composition, count_by, ranked, top_by_sum, with_share, with_top_flag


def transactions_by_type(credit: DataFrame) -> DataFrame:
    """Transactions per type, most frequent first, the leader flagged."""
    return ranked(with_top_flag(count_by(credit, "TRANSACTION_TYPE"), "COUNT"), "COUNT", "TRANSACTION_TYPE")


def customers_by_state(customer: DataFrame) -> DataFrame:
    """Customers per state, most frequent first, the leader flagged."""
    return ranked(with_top_flag(count_by(customer, "CUST_STATE"), "COUNT"), "COUNT", "CUST_STATE")


def top_customers(credit: DataFrame, k: int = 10) -> DataFrame:
    """The customers with the largest transaction totals."""
    return top_by_sum(credit, "CUST_SSN", "TRANSACTION_VALUE", k, "HIGHEST_AMOUNT")


def top_branches(credit: DataFrame, transaction_type: str = "Healthcare", k: int = 20) -> DataFrame:
    """The branches with the largest totals of one transaction type."""
    wanted = F.col("TRANSACTION_TYPE") == transaction_type
    return top_by_sum(credit, "BRANCH_CODE", "TRANSACTION_VALUE", k, "Total_value", where=wanted)


def volume_by_month(credit: DataFrame, leaders: int = 3) -> DataFrame:
    """Transactions per calendar month in order, with the month's name and the busiest months flagged."""
    months = credit.groupBy(month_of(F.col("TIMEID")).alias("Month")).agg(F.count("TIMEID").alias("Volume"))
    named = months.withColumn("Month_N", month_name(F.col("Month")))
    return with_top_flag(named, "Volume", leaders).orderBy("Month")


def status_counts(loan: DataFrame) -> DataFrame:
    """Loan applications per status, with shares."""
    return with_share(count_by(loan, "Application_Status"))


def approved_by(loan: DataFrame, column: str = "Self_Employed") -> DataFrame:
    """Approved applications per value of ``column``."""
    return count_by(loan, column, where=F.col("Application_Status") == "Y")


def rejected_by(loan: DataFrame, column: str = "Married", where: Column | None = None) -> DataFrame:
    """Rejected applications per value of ``column``."""
    rejected = F.col("Application_Status") == "N"
    return count_by(loan, column, where=rejected if where is None else rejected & where)


# Fixed values, here and in ``rejection_slice``: the names of the slices.
def approval_slice() -> Column:
    """Approved others / approved self-employed / not approved; null where an answer is missing."""
    status, employed = F.col("Application_Status"), F.col("Self_Employed")
    return (
        F.when(status == "N", "No Approved")
        .when((status == "Y") & (employed == "Yes"), "Approved Self-Employed")
        .when((status == "Y") & employed.isNotNull(), "Approved Others")
    )


def rejection_slice() -> Column:
    """Approved / rejected by marriage and gender; null where an answer is missing."""
    status, married, gender = F.col("Application_Status"), F.col("Married"), F.col("Gender")
    married_rejected = (status == "N") & (married == "Yes")
    return (
        F.when(status == "Y", "Approved")
        .when(married_rejected, F.concat(F.lit("No Approved, Yes Married, "), gender))
        .when((status == "N") & married.isNotNull(), "No Approved, No Married")
    )


def approval_composition(loan: DataFrame) -> DataFrame:
    return composition(loan, approval_slice())


def approved_composition(loan: DataFrame) -> DataFrame:
    """The self-employed share among approved applications."""
    return composition(loan.where(F.col("Application_Status") == "Y"), approval_slice())


def rejection_composition(loan: DataFrame, with_approved: bool = True) -> DataFrame:
    """Rejections by marriage and gender, beside the approved applications or alone."""
    rows = loan if with_approved else loan.where(F.col("Application_Status") == "N")
    return composition(rows, rejection_slice())


# The names of the charts. Those in ``_COUNTED`` count a column's values, so that null counts 0;
# the others are compositions, which leave null slices out.
_COUNTED = ("status", "approved by employment", "rejected by marriage", "married and rejected by gender")


def loan_charts(loan: DataFrame) -> DataFrame:
    """All loan charts as ``chart, slice, COUNT, share``, from one scan.

    Grouping sets count the applications by status, by status and each further answer; what is null in a row because its
    set leaves the column out is told from a null answer by the grouping id. Every chart then is made of those few
    rows: ``status`` as in ``status_counts``, ``approved by employment`` as in ``approved_by``, ``rejected by marriage`` and
    ``married and rejected by gender`` as in ``rejected_by``, and the four compositions. Shares are null where a chart
    counts nothing.
    """
    status, employed, married, gender = columns = ("Application_Status", "Self_Employed", "Married", "Gender")
    sets = [[status], [status, employed], [status, married], [status, married, gender]]
    counts = loan.groupingSets(sets, *columns).agg(F.grouping_id().alias("set"), F.count("*").alias("n"))

    def of(kept: list[str]) -> Column:
        return F.col("set") == sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in kept)

    accepted, refused = F.col(status) == "Y", F.col(status) == "N"
    charts = [
        ("status", of(sets[0]), F.col(status)),
        ("approved by employment", of(sets[1]) & accepted, F.col(employed)),
        ("rejected by marriage", of(sets[2]) & refused, F.col(married)),
        ("married and rejected by gender", of(sets[3]) & refused & (F.col(married) == "Yes"), F.col(gender)),
        ("approval", of(sets[1]), approval_slice()),
        ("approval of approved", of(sets[1]) & accepted, approval_slice()),
        ("rejection", of(sets[3]), rejection_slice()),
        ("rejection of rejected", of(sets[3]) & refused, rejection_slice()),
    ]
    entries = []
    for name, where, part in charts:
        counted = F.when(part.isNotNull(), F.col("n")).otherwise(F.lit(0))
        wanted = where if name in _COUNTED else where & part.isNotNull()
        entries.append(F.when(wanted, F.struct(F.lit(name).alias("chart"), part.alias("slice"), counted.alias("n"))))
    rows = counts.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("chart", "slice").agg(F.sum("n").alias("COUNT"))
    totals = rows.groupBy("chart").agg(F.sum("COUNT").alias("total"))
    return rows.join(F.broadcast(totals), "chart").select(  # a row a chart
        "chart", "slice", "COUNT", F.try_divide(F.col("COUNT").cast("double"), F.col("total")).alias("share")
    )
