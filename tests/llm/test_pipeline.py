import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pageloom.llm import toxicity as X
from pageloom.llm.common import staged, table

from .test_decontamination import brute as hits
from .test_neardup import brute as classes
from .test_packing import check
from .test_secrets import brute as secrets


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, docs := staged(stage(spark, docs, sf_dir)))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_each_stage_decides_as_brute_force_does(spark, sf_dir, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "benchmark_decontamination", "secret_scan", "packing"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == table(spark, sf_dir, "documents").columns, name
    before, after = (texts(x) for x in stages["toxicity"])
    model = X.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    automaton = X.LexiconAutomaton(model.terms)
    assert set(after) == {i for i, t in before.items() if model.score(X.hits_of(automaton, t)) < 0.5}
    before, after = (texts(x) for x in stages["near_duplicates"])
    ids = sorted(before)
    assert set(after) == {i for i, c, _ in classes(ids, [before[i] for i in ids]) if i == c}
    before, after = (texts(x) for x in stages["benchmark_decontamination"])
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    ids = sorted(before)
    found = hits([before[i] for i in ids], items)
    assert set(after) == {i for k, i in enumerate(ids) if not found[k][1]}
    before, after = (texts(x) for x in stages["secret_scan"])
    assert set(before) == set(after)
    for i, t in before.items():
        if secrets(t):
            assert "[SECRET]" in after[i] and not secrets(after[i].replace("[SECRET]", " "))
        elif "[SECRET]" not in (after[i] or ""):
            assert after[i] == t
    for r in stages["secret_scan"][1].collect():
        assert r["n_chars"] == len(r["text"])
    packed = stages["packing"][1].collect()
    check(packed, 4096)
    assert {r["doc_id"] for r in packed} == set(after)


def test_run_gives_the_last_stage_s_rows(spark, sf_dir, stages):
    want = sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in stages["packing"][1].collect())
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in got) == want
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


def test_stages_of_odd_tables(spark, sf_dir, make_docs, edge_texts):
    for docs in (make_docs([]), make_docs([t for t in edge_texts if not t or len(t) < 5000])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            docs = staged(out)
        corpus_pipeline.packing(spark, docs, sf_dir).collect()


@pytest.mark.parametrize("name", ["op3_secret_scan", "op5_jaccard_join", "op8_benchmark_matches", "op10_chat_format"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda x: sorted(map(repr, x[columns].astype(object).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
    assert re.match(r"op\d+_", name)
