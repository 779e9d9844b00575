"""Raw input schemas and the typed tables they are loaded into."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR = T.StringType()
# The column a raw dataset carries for records that cannot be read.
CORRUPT = "_corrupt_record"
_BAD = {CORRUPT: _STR}

# Every value is declared as a string: Spark's JSON reader hands over a number's text, so a number loads with
# or without quotes, and one that fits no number is still there to be counted when it is cast.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "branch": _struct(
        BRANCH_CODE=_STR, BRANCH_NAME=_STR, BRANCH_STREET=_STR, BRANCH_CITY=_STR, BRANCH_STATE=_STR,
        BRANCH_ZIP=_STR, BRANCH_PHONE=_STR, LAST_UPDATED=_STR, **_BAD,
    ),
    "credit": _struct(
        CREDIT_CARD_NO=_STR, YEAR=_STR, MONTH=_STR, DAY=_STR, CUST_SSN=_STR, BRANCH_CODE=_STR,
        TRANSACTION_TYPE=_STR, TRANSACTION_VALUE=_STR, TRANSACTION_ID=_STR, **_BAD,
    ),
    "customer": _struct(
        SSN=_STR, FIRST_NAME=_STR, MIDDLE_NAME=_STR, LAST_NAME=_STR, CREDIT_CARD_NO=_STR,
        STREET_NAME=_STR, APT_NO=_STR, CUST_CITY=_STR, CUST_STATE=_STR, CUST_COUNTRY=_STR,
        CUST_ZIP=_STR, CUST_PHONE=_STR, CUST_EMAIL=_STR, LAST_UPDATED=_STR, **_BAD,
    ),
}
# Loan applications are taken with all the columns they come with. These are the ones the insights use.
LOAN_SCHEMA = _struct(Application_Status=_STR, Self_Employed=_STR, Married=_STR, Gender=_STR)

DATASETS = (*RAW_SCHEMAS, "loan")


@dataclass(frozen=True)
class TableSchema:
    """A loaded table: its view name, columns with their SQL types, and its primary key.

    ``VARCHAR(n)`` columns are Spark strings whose length is checked, not cut.
    """

    name: str
    columns: dict[str, str]
    primary_key: tuple[str, ...] = ()
    month_of: str | None = None

    def spark_type(self, column: str) -> str:
        kind = self.columns[column]
        return "string" if kind.startswith("VARCHAR") else kind.lower()

    def max_length(self, column: str) -> int | None:
        kind = self.columns[column]
        return int(kind[len("VARCHAR("):-1]) if kind.startswith("VARCHAR") else None

    @property
    def limited(self) -> dict[str, int]:
        return {c: n for c in self.columns if (n := self.max_length(c)) is not None}

    def struct(self) -> T.StructType:
        ddl = ", ".join(f"`{c}` {self.spark_type(c)}" for c in self.columns)
        if self.month_of:
            ddl += f", {MONTH_COLUMN} string"
        return T.StructType.fromDDL(ddl)

    def with_types(self, **types: str) -> TableSchema:
        """The table with other SQL types for some columns: ``CREDIT.with_types(TRANSACTION_ID="BIGINT")`` holds
        more than the 2^31 transactions that the declared INTEGER numbers."""
        unknown = types.keys() - self.columns.keys()
        if unknown:
            raise ValueError(f"{self.name} has no columns {sorted(unknown)}")
        return replace(self, columns=self.columns | types)

    def jdbc_types(self) -> str:
        return ", ".join(f"{c} {kind}" for c, kind in self.columns.items())


# The partition column a month-partitioned table carries beside its own columns.
MONTH_COLUMN = "ym"

# Table names, column names and column types of the loaded tables.
BRANCH = TableSchema(
    "CDW_SAPP_BRANCH",
    {
        "BRANCH_CODE": "INTEGER",
        "BRANCH_NAME": "VARCHAR(50)",
        "BRANCH_STREET": "VARCHAR(50)",
        "BRANCH_CITY": "VARCHAR(50)",
        "BRANCH_STATE": "VARCHAR(50)",
        "BRANCH_ZIP": "INTEGER",
        "BRANCH_PHONE": "VARCHAR(50)",
        "LAST_UPDATED": "TIMESTAMP",
    },
)
CREDIT = TableSchema(
    "CDW_SAPP_CREDIT_CARD",
    {
        "CUST_CC_NO": "VARCHAR(50)",
        "TIMEID": "VARCHAR(50)",
        "CUST_SSN": "INTEGER",
        "BRANCH_CODE": "INTEGER",
        "TRANSACTION_TYPE": "VARCHAR(50)",
        "TRANSACTION_VALUE": "DOUBLE",
        "TRANSACTION_ID": "INTEGER",
    },
    month_of="TIMEID",
)
CUSTOMER = TableSchema(
    "CDW_SAPP_CUSTOMER",
    {
        "SSN": "INTEGER",
        "FIRST_NAME": "VARCHAR(50)",
        "MIDDLE_NAME": "VARCHAR(50)",
        "LAST_NAME": "VARCHAR(50)",
        "CREDIT_CARD_NO": "VARCHAR(50)",
        "FULL_STREET_ADDRESS": "VARCHAR(50)",
        "CUST_CITY": "VARCHAR(50)",
        "CUST_STATE": "VARCHAR(50)",
        "CUST_COUNTRY": "VARCHAR(50)",
        "CUST_ZIP": "INTEGER",
        "CUST_PHONE": "VARCHAR(50)",
        "CUST_EMAIL": "VARCHAR(50)",
        "LAST_UPDATED": "TIMESTAMP",
    },
    primary_key=("SSN",),
)
LOAN_TABLE = "CDW_SAPP_LOAN_APPLICATION"

TABLES: dict[str, TableSchema] = {"branch": BRANCH, "credit": CREDIT, "customer": CUSTOMER}

# The columns an account update may set; LAST_UPDATED is stamped with them.
UPDATABLE = (
    "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "FULL_STREET_ADDRESS", "CUST_CITY", "CUST_STATE",
    "CUST_COUNTRY", "CUST_ZIP", "CUST_PHONE", "CUST_EMAIL",
)
