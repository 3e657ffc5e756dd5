import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_operators import line_brute, texts_of
from transitlens.llm import queries, toxicity


def test_stages_decide_as_their_operators_do(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    states = []
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        states.append(docs)
        if name != "pack":
            assert docs.columns == cp.COLUMNS
    start = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.fit(start, queries.table(spark, SF_SMALL, "labels"))
    clean = {r["doc_id"] for r in toxicity.score_with(start, model).filter("predicted = 0").collect()}
    tox, lines, near, decon, packed = states
    assert {d for d, _ in texts_of(tox)} == clean
    assert sorted(texts_of(lines)) == [(d, t) for d, _, _, t in line_brute(texts_of(tox))]
    assert sorted(d for d, _ in texts_of(near)) == [r[0] for r in brute.near(texts_of(lines)) if r[3]]
    judged = brute.decontam(texts_of(near), bench)
    assert sorted(d for d, _ in texts_of(decon)) == [r[0] for r in judged if not r[5]]
    untouched = {r[0] for r in judged if r[2] == 0}
    assert {x for x in texts_of(decon) if x[0] in untouched} == {x for x in texts_of(near) if x[0] in untouched}
    assert {r["doc_id"] for r in packed.collect()} == {d for d, _ in texts_of(decon)}
    assert decon.filter(F.length("text") != F.col("n_chars")).count() == 0


def test_near_dedup_keeps_one_row_of_a_group(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (3, b), (7, c), (7, c), (None, c), (8, None), (8, None), (9, a + " end")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.near_dedup(spark, docs, SF_SMALL)
    assert got.columns == cp.COLUMNS
    assert sorted(texts_of(got), key=str) == sorted([(5, a), (3, b), (7, c), (None, c), (8, None), (8, None)], key=str)


def test_empty_table_passes(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    rows = con.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, rows))
