"""Reports and insights against loops over the same rows in Python, on random skewed data with nulls."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardlens.plans import insights, reports
from conftest import rows

CARDS = [f"42{n:04d}" for n in range(40)]
TYPES = ["Bills", "Healthcare", "Gas", "Test", None]
STATES = ["NY", "NJ", "PA", None]
CARD, DAY, SSN, BRANCH, TYPE, VALUE, ID = range(7)


class Data:
    def __init__(self, spark, seed):
        rng = random.Random(seed)

        def pick(values, hot):
            """One value for a third of the rows, a null for some, any for the rest."""
            draw = rng.random()
            return hot if draw < 0.33 else None if draw < 0.38 else rng.choice(values)

        def day():
            return f"{rng.choice([2017, 2018])}{rng.randint(1, 12):02d}{rng.randint(1, 28):02d}"

        self.credit_rows = [
            (
                pick(CARDS, CARDS[0]), pick([day()], "20180214"), pick(list(range(60)), 7), pick(list(range(30)), 25),
                rng.choice(TYPES), None if rng.random() < 0.05 else rng.randint(-100, 100_000) / 100, n,
            )
            for n in range(4000)
        ]
        self.branch_rows = [(pick(list(range(40)), 25) if n > 40 else n, rng.choice(STATES)) for n in range(60)]
        self.customer_rows = [(n, rng.choice([39120, 7501, None]), rng.choice(STATES)) for n in range(50)]
        self.credit = spark.createDataFrame(
            self.credit_rows,
            "CUST_CC_NO string, TIMEID string, CUST_SSN int, BRANCH_CODE int, TRANSACTION_TYPE string, "
            "TRANSACTION_VALUE double, TRANSACTION_ID int",
        )
        self.branch = spark.createDataFrame(self.branch_rows, "BRANCH_CODE int, BRANCH_STATE string")
        self.customer = spark.createDataFrame(self.customer_rows, "SSN int, CUST_ZIP int, CUST_STATE string")

    def totals(self, key, keep=lambda row: True):
        """Exact total per key; None where every value is null."""
        groups = defaultdict(list)
        for row in filter(keep, self.credit_rows):
            groups[row[key]].append(row[VALUE])
        return {k: total(values) for k, values in groups.items()}


def total(values):
    present = [Decimal(str(v)) for v in values if v is not None]
    return float(sum(present)) if present else None


def largest_first(pairs):
    """Descending by value with nulls last, then ascending by key with nulls first."""
    return sorted(pairs, key=lambda p: (p[1] is None, -(p[1] or 0), p[0] is not None, p[0] or 0))


def in_february(row):
    return row[DAY] is not None and row[DAY].startswith("201802")


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(spark, request):
    return Data(spark, request.param)


@pytest.mark.parametrize("limit", [64 << 20, -1], ids=["broadcast", "shuffled"])
def test_zip_month(data, limit):
    zips = {ssn: z for ssn, z, _ in data.customer_rows}
    expected = [
        (r[SSN], r[CARD], 7501, r[DAY], r[VALUE])
        for r in sorted(filter(in_february, data.credit_rows), key=lambda r: (-int(r[DAY]), r[ID]))
        if zips.get(r[SSN]) == 7501
    ]
    df = reports.transactions_by_zip_month(
        data.credit, data.customer, "07501", 2018, "02", max_broadcast_bytes=limit
    )
    assert rows(df) == expected and expected


def test_type_totals(data):
    values = [r[VALUE] for r in data.credit_rows if r[TYPE] == "Healthcare"]
    assert rows(reports.type_totals(data.credit, "Healthcare")) == [("Healthcare", len(values), total(values))]


@pytest.mark.parametrize("preserved", [True, False])
def test_branch_totals(data, preserved):
    copies = Counter(code for code, state in data.branch_rows if state == "NY")
    values = defaultdict(list)
    for row in data.credit_rows:
        values[row[BRANCH]].append(row[VALUE])
    expected = set()
    for code, n in copies.items():
        found = values[code] if code is not None else []
        own = 1 if preserved and code is not None else 0
        expected.add((code, n * (len(found) or own), total(found * n)))
    ours = rows(reports.branch_totals(data.branch, data.credit, "NY", count_preserved=preserved))
    assert set(ours) == expected and len(ours) == len(expected)


def test_bills(data):
    expected = data.totals(CARD, in_february)
    assert dict(rows(reports.monthly_bill(data.credit, None, 2018, 2))) == expected
    assert rows(reports.monthly_bill(data.credit, CARDS[0], 2018, 2)) == [(CARDS[0], expected[CARDS[0]])]


def test_transactions_between(data):
    expected = [
        r for r in data.credit_rows if r[CARD] == CARDS[0] and r[DAY] and "201709" <= r[DAY] <= "20180301"
    ]
    expected.sort(key=lambda r: (-int(r[DAY]), r[ID]))
    assert rows(reports.transactions_between(data.credit, CARDS[0], "201709", "20180301")) == expected


def test_counts(data):
    for ours, values in (
        (insights.transactions_by_type(data.credit), [r[TYPE] for r in data.credit_rows]),
        (insights.customers_by_state(data.customer), [s for _, _, s in data.customer_rows]),
    ):
        counts = {k: n if k is not None else 0 for k, n in Counter(values).items()}
        found = rows(ours)
        assert {r[0]: r[1] for r in found} == counts
        assert [r[1] for r in found] == sorted(counts.values(), reverse=True)
        assert all(r[2] == (r[1] == max(counts.values())) for r in found)


def test_tops(data):
    assert rows(insights.top_customers(data.credit)) == largest_first(data.totals(SSN).items())[:10]
    healthcare = data.totals(BRANCH, lambda r: r[TYPE] == "Healthcare")
    assert rows(insights.top_branches(data.credit)) == largest_first(healthcare.items())[:20]


def test_volume(data):
    counts = Counter(r[DAY] and r[DAY][4:6] for r in data.credit_rows)
    expected = {month: n if month is not None else 0 for month, n in counts.items()}
    found = rows(insights.volume_by_month(data.credit).select("Month", "Volume", "is_top"))
    assert {m: n for m, n, _ in found} == expected
    months = [m for m, _, _ in found]
    assert months[0] is None and months[1:] == sorted(months[1:])
    leaders = sorted(set(expected.values()), reverse=True)[:3]
    assert all(top == (n in leaders) for _, n, top in found)
    assert rows(insights.volume_by_month(data.credit).where(F.col("is_top") & F.col("Month").isNull())) == []
