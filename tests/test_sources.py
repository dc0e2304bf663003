import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.contracts import ContractError
from tidemark.sources.features import FeatureStore
from tidemark.sources.payloads import backfill, decode_text, evidence_from_json, export_lines, fill_template


def test_feature_store(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    assert store.discover().count() == 0
    with pytest.raises(ContractError):
        store.read("ashare.x", as_of="a", window=1)
    frame = spark.createDataFrame([("20260101", 5, "s", 1.0), ("20260101", 5, "t", None)], "as_of string, window int, security_id string, score double")
    q = store.write("ashare.x", frame, as_of="20260101", window=5, analysis=["score"], inputs={"d": ("required", "ok")})
    assert q["status"] == "degraded"
    store.write("ashare.x", frame.where("score > 0"), as_of="20260101", window=20, analysis=["score"])
    with pytest.raises(ContractError):
        store.write("ashare.x", frame, as_of="20260101", window=5)
    assert store.read("ashare.x", as_of="20260101", window=5).count() == 2
    assert store.read("ashare.x", as_of="20260101", window=5, limit=1).count() == 1
    assert rows_of(store.discover().select("window", "status", "rows")) == [(20, "ok", 1), (5, "degraded", 2)]


def test_decoding(spark):
    cases = [("中文".encode("gb18030"), None, "中文"), ("é".encode(), "utf-8", "é"), ("é".encode("latin-1"), "latin-1", "é"), ("x".encode(), "no-such", "x"), (None, None, None), (b"\xff\xff\xff", "ascii", "���")]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None, c) for i, (b, c, _) in enumerate(cases)], "i int, b binary, c string")
    got = {r.i: r.t for r in df.select("i", decode_text(F.col("b"), F.col("c")).alias("t")).collect()}
    assert got == {i: t for i, (_, _, t) in enumerate(cases)}


def test_json_evidence(spark, tmp_path):
    doc = json.dumps({"d": {"rows": [{"n": "A", "v": 1.5}, {"n": None, "x": {"y": [7, 8]}}]}})
    df = spark.createDataFrame([(doc,), ("broken",), (None,)], "body string")
    out = evidence_from_json(df, "body", path="d.rows", fields={"name": "n", "value": "v", "deep": "x.y[1]"}, claim="{name} has {value}{unit}{gone} {deep}", static={"unit": "%", "name": "?"})
    assert rows_of(out.select("claim")) == [("? has % 8",), ("A has 1.5% ",)]
    export_lines(out, str(tmp_path / "x"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "x")).collect()]
    assert len(lines) == 2 and all(set(x) == {"claim", "name", "value", "deep", "unit"} for x in lines)


def test_templates_and_backfill(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(fill_template("{x}-{y}-{z}{", {"x": F.col("x"), "y": F.col("y")})).first()[0] == "a--{"
    assert df.select(fill_template("", {})).first()[0] == ""
    assert backfill(df, ["y", "z", "x"]).columns == ["y", "z", "x"]
