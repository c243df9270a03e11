"""The pipeline against a composition of brute-force stages, and the registered queries."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from folioflow.llm.language import train
from folioflow.llm.queries import QUERIES
from folioflow.llm.repetition import RepetitionRules, measure
from folioflow.llm.secrets import redact
from tests.llm.conftest import SF
from tests.llm.test_joins_and_pii import brute


def test_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "secret_scan", "packing"]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    model = train(docs)
    verdicts = zip(*model.predict([t for _, t in rows]))
    rows = [r for r, (lang, score) in zip(rows, verdicts) if lang != "und" and score >= 0.5]
    rows = [r for r, ok in zip(rows, measure([t for _, t in rows], RepetitionRules())["kept"]) if ok]
    rows = [r for r, (_, c) in zip(rows, brute(rows)) if r[0] == c]
    rows = [(i, redact(t)) for i, t in rows]

    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes, name
    got = frame.select("doc_id", "text", "n_chars").orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in got] == rows
    assert all(r.n_chars == len(r.text) for r in got)

    pieces = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert sorted(r.doc_id for r in pieces) == [i for i, _ in rows]
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)


def test_every_query_runs_over_its_whole_table(spark):
    documents = duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    pages = duckdb.sql(f"SELECT count(*) FROM '{SF}/pages.parquet'").fetchall()[0][0]
    vectors = duckdb.sql(f"SELECT count(*) FROM '{SF}/embeddings.parquet'").fetchall()[0][0]
    rows = {"doc_id": documents, "page_id": pages, "vec_id": vectors}
    for name, query in QUERIES.items():
        df = query(spark, SF)
        key = next(k for k in rows if k in df.columns)
        assert df.select(key).distinct().count() == rows[key], name


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def written(spark, folder, rows, more=""):
    """A folder with a table of documents, with clashing extra columns."""
    clash = [f for f in more.split(",") if f]
    schema = COLUMNS + "".join(f", {c} string" for c in clash)
    spark.createDataFrame([(*r, *("x" for _ in clash)) for r in rows], schema).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_pipeline_on_an_empty_table(spark, tmp_path):
    folder = written(spark, f"file:{tmp_path}", [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_pipeline_on_odd_rows(spark, tmp_path, documents):
    """NULL ids and texts, repeated rows, ties, other columns; each text that stays is packed whole."""
    plain = [(i, t, lang, "web", len(t or "")) for i, t, lang in documents[:60]]
    kept_text = next(t for i, t, _ in documents if t and len(t) > 400)
    odd = [(None, kept_text + " and a row of its own", "en", None, 0), (700, None, "en", "web", None), (701, "", None, None, 0), (702, " \n", None, None, 3), plain[0], plain[0]]
    folder = written(spark, f"file:{tmp_path}", plain + odd, "root,key,piece_id,c0")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes, name
    left = frame.select("doc_id", "text").collect()
    assert 700 not in {r.doc_id for r in left} and len({r.text for r in left}) == len(left)
    pieces = corpus_pipeline.run(spark, folder).groupBy("doc_id", "doc_tokens").agg({"length": "sum"}).collect()
    assert sorted(r.doc_id or -1 for r in pieces) == sorted(r.doc_id or -1 for r in left)
    assert all(r["sum(length)"] == r["doc_tokens"] for r in pieces)
