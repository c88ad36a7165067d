"""Pipeline: every stage decides on its whole input, and the registered queries equal their SQL."""
import numpy as np
import pytest

import corpus_pipeline
from chartfold.llm import queries
from chartfold.llm.common import table
from tools.check_oracle import digest


def test_stages(spark, small_dir, tmp_path):
    docs = table(spark, small_dir, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small_dir)
        if name != "token_files":
            assert out.columns == docs.columns
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        now = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(now) <= ids and now
        ids = set(now)
        if name == "ngram_join":
            c = queries.jaccard_components(docs).where("doc_id != component_id")
            assert c.count() == 0
        if name == "decontaminate":
            assert queries.contamination(docs, table(spark, small_dir, "benchmark")).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_sql(spark, small_dir, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    df = queries.registry()[name](spark, small_dir)
    res = con.execute(queries.oracles()[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, res.fetchall())[0]


def test_ngram_stage_decides_by_row(spark):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 500, 200)]
    near = " ".join(base[:-1] + ["changed"])
    other = " ".join(f"v{x}" for x in rng.integers(0, 500, 120))
    rows = [(1, " ".join(base), "en"), (2, near, "en"), (2, other, "en"), (None, near, "en"), (5, "", "en"), (5, "", "en"), (6, None, "en"),
            (7, other + " tail", "de"), (8, "alone with words of its own", "en"), (8, "alone with words of its own", "de"), (None, "no id and no copy at all", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, corpus_pipeline.ngram_join(spark, docs, None).collect()), key=str)
    assert got == sorted([rows[0], rows[2], rows[4], rows[5], rows[6], (8, "alone with words of its own", "de"), rows[10]], key=str)
    assert corpus_pipeline.ngram_join(spark, docs.limit(0), None).count() == 0
