"""The state data source: splits, strict rows, places of corruption, versions."""

import json

import pytest
from pyspark.sql import types as T

from gleaner.sources import reader

SCHEMA = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("at", T.TimestampType()), T.StructField("e", T.ArrayType(T.StructType([T.StructField("q", T.StringType())]))), T.StructField("m", T.MapType(T.StringType(), T.BooleanType()))])


def load(spark, path, layout="lines", schema=SCHEMA, **options):
    reader.register(spark)
    r = spark.read.format(reader.NAME).option("layout", layout).options(**options)
    return (r.schema(schema) if schema is not None else r).load(str(path))


def row(i):
    return {"id": f"é{i}", "n": i, "x": i / 2 if i % 2 else i, "at": "2026-07-01T08:00:00+08:00", "e": [{"q": "a\nb"}, {"q": None, "more": 1}], "m": {"k": True}, "unknown": 1}


@pytest.mark.parametrize("split", [150, 1 << 20])
def test_lines_in_parts(spark, tmp_path, split):
    lines = [json.dumps(row(i), ensure_ascii=False) for i in range(40)]
    (tmp_path / "a.jsonl").write_text("\n\n".join(lines[:30]) + "\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_text("\r\n".join(lines[30:]), encoding="utf-8")  # no closing line end
    (tmp_path / "_draft").write_text("junk")
    for path in (tmp_path, f"file://{tmp_path}"):
        got = sorted(load(spark, path, split=str(split)).collect(), key=lambda r: r.n)
        assert [r.id for r in got] == [f"é{i}" for i in range(40)] and got[3].x == 1.5 and got[0].e[0].q == "a\nb" and got[0].m == {"k": True}
    assert str(got[0]["at"]) == "2026-07-01 00:00:00"


@pytest.mark.parametrize(("bad", "why"), [("{", "line 3"), ('{"n": 1}', "id is null"), ('{"id": "a", "n": "1"}', "n is no whole number"), ('{"id": 5}', "id is no string"), ("[]", "row is no object"), ('{"id": "a", "at": "soon"}', "line 3"), ('{"id": "a", "e": {}}', "e is no array"), ('{"id": "a", "n": true}', "n is no whole number")])
def test_corrupt_lines_are_named(spark, tmp_path, bad, why):
    good = json.dumps(row(1))
    (tmp_path / "s.jsonl").write_text(f"{good}\n\n{bad}\n{good}\n")
    with pytest.raises(Exception, match="corrupt state.*s.jsonl, line 3") as e:
        load(spark, tmp_path / "s.jsonl", split="90").collect()
    assert why in str(e.value)


def test_arrays_and_versions(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([row(1), row(2)]))
    (tmp_path / "q.json").write_text(json.dumps({"rows": []}))
    assert sorted(r.n for r in load(spark, tmp_path / "p.json", "array").collect()) == [1, 2]
    with pytest.raises(Exception, match="corrupt state.*q.json: no array"):
        load(spark, tmp_path / "q.json", "array").collect()
    for held, version in (('{"schema_version": 2}', 2), ('{"schema_version": 1}', 1)):
        (tmp_path / "state.json").write_text(held)
        assert [tuple(r) for r in load(spark, tmp_path / "state.json", "version", None).collect()] == [(version,)]
    for held in ('{"schema_version": 3}', "[]", '{"schema_version": true}', "{"):
        (tmp_path / "state.json").write_text(held)
        with pytest.raises(Exception, match="corrupt state"):
            load(spark, tmp_path / "state.json", "version", None).collect()
    missing = tmp_path / "none"
    assert load(spark, missing).collect() == [] == load(spark, missing, "array").collect()
    assert [tuple(r) for r in load(spark, missing, "version", None).collect()] == [(1,)]
