import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cardlens.operators import apply_schema, clean, unreadable
from cardlens.plans.loading import LoadRejected, load_table
from cardlens.schemas import BRANCH, CORRUPT, CREDIT, CUSTOMER, LOAN_SCHEMA, RAW_SCHEMAS
from cardlens.session import CHECKPOINT_DIR, shared_path
from cardlens.sources import load_all, read_dataset, read_table, register, write_table
from conftest import rows

LINE = {
    "CREDIT_CARD_NO": "42", "YEAR": 2018, "MONTH": 2, "DAY": 14, "CUST_SSN": 1, "BRANCH_CODE": 7,
    "TRANSACTION_TYPE": "Bills", "TRANSACTION_VALUE": 78.9, "TRANSACTION_ID": 1,
}


def test_json_lines_with_numbers_or_text(spark, tmp_path, ansi):
    text = LINE | {"YEAR": "2018", "MONTH": "02", "DAY": "14", "CREDIT_CARD_NO": 42}
    (tmp_path / "credit.json").write_text("\n".join(json.dumps(x) for x in (LINE, text)))
    raw = read_dataset(spark, "credit", str(tmp_path / "credit.json"))
    assert raw.schema == RAW_SCHEMAS["credit"]
    cleaned = rows(apply_schema(clean("credit", raw), CREDIT))
    assert cleaned[0] == cleaned[1] == ("42", "20180214", 1, 7, "Bills", 78.9, 1)


def test_numbers_in_quotes_load_and_misfits_are_counted(spark, tmp_path, ansi):
    lines = [{"BRANCH_CODE": "1", "BRANCH_ZIP": "07501"}, {"BRANCH_CODE": 2, "BRANCH_ZIP": 7502}, {"BRANCH_CODE": 3}]
    (tmp_path / "branch.json").write_text("\n".join(map(json.dumps, lines)))
    raw = read_dataset(spark, "branch", str(tmp_path / "branch.json"))
    loaded = load_table(spark, "branch", raw, str(tmp_path / "good"))
    assert sorted((r.BRANCH_CODE, r.BRANCH_ZIP) for r in loaded.collect()) == [(1, 7501), (2, 7502), (3, 99999)]
    for i, bad in enumerate(('{"BRANCH_CODE": "x7"}', '{"BRANCH_CODE": 3, broken', '{"BRANCH_ZIP": "n/a"}')):
        (tmp_path / f"bad{i}.json").write_text(json.dumps(lines[0]) + "\n" + bad)
        with pytest.raises(LoadRejected, match=("cast:BRANCH_CODE", "unreadable", "cast:BRANCH_ZIP")[i]):
            load_table(spark, "branch", read_dataset(spark, "branch", str(tmp_path / f"bad{i}.json")), str(tmp_path / f"t{i}"))


def test_broken_loan_lines_are_refused(spark, tmp_path):
    (tmp_path / "loan.json").write_text('{"Application_Status": "Y"}\n{"Application_Status": broken')
    raw = read_dataset(spark, "loan", str(tmp_path / "loan.json"))
    with pytest.raises(LoadRejected, match="unreadable"):
        load_table(spark, "loan", raw, str(tmp_path / "loan"))


def test_inferred_columns_clean_alike(spark, tmp_path, ansi):
    (tmp_path / "credit.json").write_text(json.dumps(LINE))
    inferred = read_dataset(spark, "credit", str(tmp_path / "credit.json"), infer=True)
    assert inferred.schema["YEAR"].dataType.simpleString() == "bigint"
    assert rows(clean("credit", inferred))[0][1] == "20180214"


def test_json_array(spark, tmp_path):
    loans = [{"Application_Status": s, "Self_Employed": "No", "Income": "high"} for s in "YN"]
    (tmp_path / "one_line.json").write_text(json.dumps(loans))
    (tmp_path / "pretty.json").write_text(json.dumps(loans, indent=2))
    everything = read_dataset(spark, "loan", str(tmp_path / "one_line.json"))
    assert everything.columns == ["Application_Status", "Income", "Self_Employed"]
    assert rows(everything) == [("Y", "high", "No"), ("N", "high", "No")]
    assert rows(read_dataset(spark, "loan", str(tmp_path / "pretty.json"), multi_line=True)) == rows(everything)
    declared = read_dataset(spark, "loan", str(tmp_path / "one_line.json"), schema=LOAN_SCHEMA)
    assert rows(declared) == [("Y", "No", None, None), ("N", "No", None, None)]


def test_bad_lines_are_listed_or_refused(spark, tmp_path):
    (tmp_path / "bad.json").write_text(json.dumps(LINE) + "\n{not json")
    kept = read_dataset(spark, "credit", str(tmp_path / "bad.json"))
    assert [r[0] for r in kept.collect()] == ["42", None]
    assert rows(unreadable(kept)) == [("{not json", 0)]
    assert rows(unreadable(kept.drop(CORRUPT))) == []
    with pytest.raises(Exception, match="(?i)malformed"):
        read_dataset(spark, "credit", str(tmp_path / "bad.json"), mode="FAILFAST").collect()
    with pytest.raises(ValueError, match="unknown dataset"):
        read_dataset(spark, "other", "x")


def test_table_round_trip_by_month(spark, credit, tmp_path):
    path = str(tmp_path / "credit")
    write_table(credit, path, "TIMEID", ["CUST_CC_NO"])
    assert sorted(p.name for p in tmp_path.glob("credit/ym=*")) == ["ym=201802", "ym=201803", "ym=201812"]
    typed = credit.withColumn("CUST_SSN", F.col("CUST_SSN").cast("int"))
    assert typed.count() == spark.read.parquet(path).count() == 5
    assert read_table(spark, path, CREDIT).schema["ym"].dataType.simpleString() == "string"
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_table(credit, path, "TIMEID")


def test_register_moves_a_name(spark, branch):
    register(spark, {"moved": branch})
    register(spark, {"moved": branch.limit(1)})
    assert spark.sql("SELECT COUNT(*) FROM MOVED").first()[0] == 1


def test_load_all_writes_every_frame(spark, branch, credit, tmp_path):
    load_all({"b": branch, "c": credit}, lambda name, df: write_table(df, str(tmp_path / name)))
    assert read_table(spark, str(tmp_path / "b")).count() == 3
    assert read_table(spark, str(tmp_path / "c")).count() == 5


def test_shared_path_is_fresh_and_in_the_checkpoint_folder(spark):
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get(CHECKPOINT_DIR))


def test_shared_path_without_a_checkpoint_folder_is_in_the_warehouse():
    class Conf:
        def get(self, name, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}.get(name, default)

    class Session:
        conf = Conf()

    assert shared_path(Session(), "x").startswith("hdfs://store/warehouse/scratch/x-")


def test_table_schemas():
    assert BRANCH.struct().fieldNames() == list(BRANCH.columns)
    assert CREDIT.struct().fieldNames()[-1] == "ym"
    assert CUSTOMER.limited == {c: 50 for c in CUSTOMER.columns if c not in ("SSN", "CUST_ZIP", "LAST_UPDATED")}
    assert "TRANSACTION_VALUE DOUBLE" in CREDIT.jdbc_types()
