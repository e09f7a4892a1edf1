import json

import pytest
from conftest import rows

from pollstone.contracts import catalog
from pollstone.contracts.model import ERRORS, Contract


def contract():
    return Contract.of(
        "t", {"id": "string!", "n": "integer", "d": "date", "src": "string!"}, ["id"], defaults={"src": "web"}
    )


def test_schema_and_required():
    c = contract()
    assert c.required == ["id", "src"]
    assert [f.dataType.simpleString() for f in c.schema()] == ["string", "int", "date", "string"]
    assert {f.dataType.simpleString() for f in c.text_schema()} == {"string"}
    with pytest.raises(ValueError):
        Contract.of("t", {"x": "uuid"}).schema()


def test_conform_and_split(spark):
    df = spark.createDataFrame([("a", "7.0", "2024-01-01"), ("b", "seven", None), (None, "1", "x")], "id string, n string, d string")
    out = contract().conform(df)
    assert out.columns == ["id", "n", "d", "src"]
    assert [(r.id, r.n, r.src) for r in out.collect()] == [("a", 7, "web"), ("b", None, "web"), (None, 1, "web")]
    good, bad = contract().split(df)
    assert [r.id for r in good.collect()] == ["a"]
    assert sorted(tuple(r.contract_errors) for r in bad.collect()) == [
        ("id: required", "d: not a date"),
        ("n: not a integer",),
    ]


def test_missing_required_column(spark):
    df = spark.createDataFrame([("1",)], "response_id string")
    assert "gender" in catalog.BRONZE_SURVEY.missing_required(df)
    assert rows(contract().with_errors(df.toDF("n")).select("contract_errors")) == [(["id: required"],)]


def test_files(tmp_path):
    document = {"dataset": "t", "version": "1.0.0", "primary_key": ["a"], "fields": {"a": {"type": "long", "required": True}, "b": {"type": "string", "default": "x"}}}
    (tmp_path / "t.json").write_text(json.dumps(document))
    c = Contract.load(str(tmp_path / "t.json"))
    assert (c.columns, c.required, c.primary_key, c.fields[1].default) == (["a", "b"], ["a"], ("a",), "x")
    yaml = pytest.importorskip("yaml")
    (tmp_path / "t.yaml").write_text(yaml.safe_dump(document))
    assert Contract.load(str(tmp_path / "t.yaml")) == c
    with pytest.raises(FileNotFoundError):
        Contract.load(str(tmp_path / "none.yaml"))


def test_key_check_counts_null_and_repeated_keys(spark):
    contract = Contract.of("t", {"a": "string", "b": "integer"}, primary_key=["a", "b"])
    df = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), (None, 1), (None, 1)], "a string, b int")
    assert contract.key_check(df).first()[:] == ("t", "a,b", 5, 2, 2)
    assert contract.key_check(df.limit(0)).first()[:] == ("t", "a,b", 0, 0, 0)
    for bad in (Contract.of("t", {"a": "string"}), contract):
        with pytest.raises(ValueError):
            bad.key_check(df.drop("b"))


def test_errors_keep_extra_columns(spark):
    contract = Contract.of("t", {"a": "string!"})
    df = spark.createDataFrame([(None, 1), ("x", 2)], "a string, more int")
    found = contract.with_errors(df, keep_extra=True)
    assert found.columns == ["a", "more", ERRORS]
    assert sorted((r.more, r[ERRORS]) for r in found.collect()) == [(1, ["a: required"]), (2, [])]
