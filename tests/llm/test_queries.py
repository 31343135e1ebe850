"""The registered queries on the smallest tables, and the pipeline."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mailquarry.llm import jaccard, queries
from tests.llm import helpers as H


#: Their results hold whole numbers that may be null, which pandas turns into fractions.
NULLABLE = ("op12_importance_resampling", "op13_fill_in_middle")


@pytest.mark.parametrize("name", [n for n in sorted(queries.ORACLE_SQL) if n in NULLABLE])
def test_same_tuples(name, spark, duck, sf_dir):
    ours, theirs = queries.QUERIES[name](spark, sf_dir), duck.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    assert Counter(map(tuple, ours.select(*names).collect())) == Counter(theirs.fetchall())


@pytest.mark.parametrize("name", [n for n in sorted(queries.ORACLE_SQL) if n not in NULLABLE])
def test_same_rows(name, same_as_duck):
    same_as_duck(queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_repeated_bytes(spark, sf_dir):
    rows = queries.documents(spark, sf_dir).select("doc_id", "text").collect()
    got = queries.op7_repeated_bytes(spark, sf_dir).collect()
    want = H.repeated([(r.text or "").encode() for r in rows], 400)
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *w) for r, w in zip(rows, want, strict=True))


def test_stages_in_turn(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    inputs = {}
    for name, step in corpus_pipeline.STAGES:
        inputs[name] = docs.select("doc_id", "text", "source").collect()
        docs = step(spark, docs, sf_dir).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    before, after = inputs["n-gram Jaccard join"], inputs["mixing sources to target weights"]
    sets = {r.doc_id: H.shingles(r.text) for r in before}
    kept = {r.doc_id for r in after}
    for a in before:  # each document is kept, or in the group of one that is
        assert a.doc_id in kept or any(100 * len(sets[a.doc_id] & sets[b.doc_id]) >= 80 * len(sets[a.doc_id] | sets[b.doc_id]) for b in before if b.doc_id < a.doc_id)
    assert jaccard.near_duplicates(spark.createDataFrame(after)).where("doc_id <> component_id").count() == 0
    mixed = Counter(r.doc_id for r in inputs["best-fit packing"])
    assert set(mixed) <= kept and max(mixed.values()) <= 3
    assert Counter(r.doc_id for r in docs.where("piece = 0").collect()) == mixed
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    first = inputs["line dedup"]
    good = [r for r in inputs["quality classifier"] if labels.get(r.doc_id) == 1]
    assert len({r.doc_id for r in first} & {r.doc_id for r in good}) >= 0.97 * len(good)


def test_line_dedup_takes_long_lines_of_few_documents(spark, sf_dir):
    """Two documents are enough for a long line, digits apart; not for a short one, nor for rows of other numbers."""
    long, short = H.sentence(50, 60), "a short line of two documents"
    numbers = [" ".join(str(100 * k + i) for i in range(30)) for k in range(2)]
    texts = [f"{H.sentence(60 + k, 30)}\n{long} page {k}\n{short}\n{numbers[k % 2]}\n{H.sentence(70 + k, 9)}" for k in range(3)]
    docs = H.documents(spark, [*enumerate(texts), (3, texts[0]), (None, None)])
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, sf_dir).collect()}
    parts = [t.split("\n") for t in texts]
    assert got[0] == texts[0]
    assert got[1] == "\n".join([parts[1][0], *parts[1][2:]])
    assert got[2] == "\n".join([parts[2][0], parts[2][2], parts[2][4]])
    assert got[3] == "\n".join([parts[0][2], parts[0][4]])


def test_line_templates_as_in_sql(spark, tmp_path):
    """Repeated rows are one document, long lines take two documents and short ones five, alike in SQL."""
    long = H.sentence(50, 60)
    rows = [(k, f"order {k} of us shipped today\n{H.sentence(90 + k, 8)}\n{long} page {k}\n{long} page {k}") for k in range(2, 7)]
    rows += [*rows[:2], (8, "a line of two documents"), (9, "a line of two documents"), (None, None), *enumerate(H.texts(), 20)]
    docs = H.documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op3_line_templates(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(con.execute(queries.ORACLE_SQL["op3_line_templates"]).fetchall())
    assert sum(r.n_dropped for r in got) > 10


@pytest.mark.parametrize("rows", [None, []])
def test_stages_take_awkward_tables(spark, sf_dir, rows):
    """Nulls, repeated rows, clashing columns; and no row at all."""
    docs = H.documents(spark, rows)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf_dir).cache()
        assert (docs.count() > 0) == (rows is None)


def test_near_copies_of_rows_of_one_id(spark, sf_dir):
    """Rows are told by id and text: a copy goes although another row of its id stays, with ids and without."""
    a, b, c = (H.sentence(k, 60) for k in (81, 82, 83))
    docs = H.documents(spark, [(2, b), (5, a), (5, b), (None, b), (None, c), (None, c), (7, c + " x"), (2, b)])
    got = sorted(map(repr, [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()]))
    assert got == sorted(map(repr, [(2, b), (5, a), (7, c + " x")]))
