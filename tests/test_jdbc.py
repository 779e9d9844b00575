"""The options handed to Spark's JDBC source. No database may run here, so none is read or written."""

import pytest

from cardlens.schemas import CUSTOMER
from cardlens.sources import JdbcOptions, read_jdbc, write_jdbc

OPTIONS = JdbcOptions("jdbc:db://host/cards", driver="org.example.Driver", user="me", password="secret")


class Recorder:
    """Stands in for a reader or a writer and notes what it is told."""

    def __init__(self, bounds=(1, 1000)):
        self.calls, self.bounds = [], bounds

    @property
    def read(self):
        self.calls.append({})
        return self

    write = read

    def format(self, name):
        self.calls[-1]["format"] = name
        return self

    def mode(self, mode):
        self.calls[-1]["mode"] = mode
        return self

    def options(self, **options):
        self.calls[-1] |= options
        return self

    def load(self):
        return self

    def repartition(self, n):
        self.tasks = n
        return self

    def save(self):
        return None

    def first(self):
        return self.bounds


def test_password_is_not_shown():
    assert "secret" not in repr(OPTIONS)


def test_plain_read():
    spark = Recorder()
    read_jdbc(spark, OPTIONS, "T")
    assert spark.calls == [{
        "format": "jdbc", "url": OPTIONS.url, "driver": OPTIONS.driver, "user": "me", "password": "secret",
        "dbtable": "T", "fetchsize": "10000",
    }]


def test_partitioned_read_asks_for_its_bounds():
    spark = Recorder()
    read_jdbc(spark, OPTIONS, "T", partition_on="TRANSACTION_ID", num_partitions=64)
    ask, read = spark.calls
    assert "MIN(TRANSACTION_ID)" in ask["dbtable"] and "MAX(TRANSACTION_ID)" in ask["dbtable"]
    assert {k: read[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "TRANSACTION_ID", "lowerBound": "1", "upperBound": "1000", "numPartitions": "64",
    }


def test_partitioned_read_with_bounds_or_an_empty_table():
    spark = Recorder()
    read_jdbc(spark, OPTIONS, "T", partition_on="ID", bounds=(5, 9))
    assert len(spark.calls) == 1 and spark.calls[0]["upperBound"] == "9"
    empty = Recorder(bounds=(None, None))
    read_jdbc(empty, OPTIONS, "T", partition_on="ID")
    assert "partitionColumn" not in empty.calls[-1]


@pytest.mark.parametrize("mode", ["append", "errorifexists"])
def test_write(mode):
    df = Recorder()
    write_jdbc(df, OPTIONS, CUSTOMER, mode=mode)
    call = df.calls[0]
    assert (call["dbtable"], call["mode"], df.tasks) == (CUSTOMER.name, mode, 16)
    assert "SSN INTEGER" in call["createTableColumnTypes"] and "CUST_EMAIL VARCHAR(50)" in call["createTableColumnTypes"]


def test_write_without_declared_types():
    df = Recorder()
    write_jdbc(df, OPTIONS, "loans")
    assert "createTableColumnTypes" not in df.calls[0]
    assert df.calls[0]["mode"] == "errorifexists"
