"""Every registered query with SQL gives DuckDB's rows; the others have rows."""

import duckdb
import pytest

from gleaner.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(value):
    return "~" if value is None else f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    if name not in registry.SQL:
        assert got
        return
    rel = duck.execute(registry.SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted(tuple(shown(row[names.index(c)]) for c in cols) for row in rel.fetchall())
    assert got == want


def test_quotes_without_inner_words(spark, tmp_path):
    docs = spark.createDataFrame([(1, "全文は日本語の文章で、続きがある"), (2, "the year 1999-12 was long"), (3, "unrelated")], "doc_id long, text string")
    quotes = spark.createDataFrame([(1, "日本語の文"), (2, "本語の文章で、続き"), (3, "1999-12"), (4, "ear 1999-12 was lo"), (5, "elat")], "item_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    quotes.write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    got = sorted(map(tuple, registry.evidence_grounding(spark, str(tmp_path)).select("doc_id", "item_id").collect()))
    assert got == [(1, 1), (1, 2), (2, 3), (2, 4), (3, 5)] == sorted(con.execute(registry.SQL["evidence_grounding"]).fetchall())
