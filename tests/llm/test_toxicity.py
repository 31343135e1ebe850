"""Multiple-instance toxicity: gradients, held-out accuracy, offending sentences, awkward tables."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from mailquarry.llm import queries, toxicity
from tests.llm import helpers as H

RUDE = ("vexorit", "grulpan", "zintok")


def corpus(n=600, noise=0.02, seed=5):
    """(text, label, whether it is toxic): a rude word or an inflected one in one sentence of a tenth of the documents."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        parts = [H.sentence(int(rng.integers(1 << 30)), int(rng.integers(3, 12))) for _ in range(int(rng.integers(1, 30)))]
        bad = i % 8 == 0
        if bad:
            for _ in range(int(rng.integers(1, 3))):
                k = int(rng.integers(len(parts)))
                parts[k] += " " + RUDE[int(rng.integers(3))].upper() + "xyz"[int(rng.integers(3))]
        rows.append((". ".join(parts) + ".", int(bad or rng.random() < noise), bad))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus()
    return toxicity.fit([r[0] for r in rows], [r[1] for r in rows])


def test_fresh_documents(model):
    rows = corpus(400, 0, 6)
    scores = [s for s, _, _ in toxicity.scored([r[0] for r in rows], model)]
    right = sum((s >= 0.5) == r[2] for s, r in zip(scores, rows, strict=True))
    assert right >= 0.98 * len(rows)
    assert min(s for s, r in zip(scores, rows, strict=True) if r[2]) > max(s for s, r in zip(scores, rows, strict=True) if not r[2]) - 0.5


def test_offending_sentences_are_found(model):
    text = "Größe çà. " + H.sentence(9, 8) + "! VEXORITx is here. " + H.sentence(10, 5) + "\n\nno rude word\nzintoky"
    (score, n, spans), = toxicity.scored([text], model)
    assert score > 0.9 and n == 6
    assert [text[s["start"] : s["end"]] for s in spans] == ["VEXORITx is here", "zintoky"]


def test_a_sentence_among_very_many_is_enough(model):
    clean = ". ".join(H.sentence(1000 + i, 9) for i in range(800)) + ". "
    (a, n, none), (b, _, spans) = toxicity.scored([clean * 3, clean * 3 + "grulpanz you. " + clean], model)
    assert n == 2400 and a < 0.5 <= b and none == [] and len(spans) == 1


def test_noisy_or_of_plain_sums(model):
    """Scores against the definition, sentence by sentence."""
    texts = [r[0] for r in corpus(20, 0, 8)]
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    for text, (score, n, _) in zip(texts, toxicity.scored(texts, model), strict=True):
        clean, found = 1.0, 0
        for part in text.replace("\n", ".").split("."):
            if part.strip():
                found += 1
                one = toxicity.split([part.encode()])
                logit = model.bias + sum(weight.get(h, 0.0) for h in set(one.hashes.tolist()))
                clean *= 1 - 1 / (1 + np.exp(-logit))
        assert found == n and abs(score - (1 - clean)) < 1e-9


def test_copies_of_a_mislabelled_document_say_little():
    rows = corpus(400, 0, 3)
    copies = [(H.sentence(4, 40) + ". " + H.sentence(5, 30), 1)] * 40
    texts, labels = [*[r[0] for r in rows], *[c[0] for c in copies]], [*[r[1] for r in rows], *[c[1] for c in copies]]
    found = toxicity.fit(texts, labels)
    (score, *_), = toxicity.scored([H.sentence(4, 40)], found)
    assert score < 0.5


def test_words_split_alike():
    raws = ["ÉÀ×ß Abc,d'e\nx!  .", "", "ａ b"]
    lower = [toxicity.lowered(r.encode()).decode() for r in raws]
    assert lower == ["éà×ß abc,d'e\nx!  .", "", "ａ b"]
    found = toxicity.split([r.encode() for r in raws])
    assert found.text.tolist() == [0, 0, 2] and len(found.words) == 7
    assert toxicity.split([]).text.tolist() == [] and toxicity.split([b" ,"]).begin.tolist() == []


def test_awkward_tables(spark, model):
    docs = H.documents(spark).repartition(3)
    got = toxicity.find(docs, model).collect()
    want = dict(zip(map(repr, H.texts()), toxicity.scored(H.texts(), model), strict=True))
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    by_text = Counter((r.doc_id, round(r.score, 9), r.n_sentences) for r in got)
    assert by_text == Counter((i, round(next(toxicity.scored([t], model))[0], 9), next(toxicity.scored([t], model))[1]) for i, t in [(r.doc_id, r.text) for r in docs.collect()])
    assert want[repr(None)] == (0.0, 0, []) and want[repr("")] == (0.0, 0, [])
    assert toxicity.find(H.documents(spark, []), model).count() == 0


def test_labels_that_teach_nothing(spark):
    docs = H.documents(spark)
    for labels in ([], [(1, 1), (1, 0), (None, 1), (2, None)], [(i, 0) for i in range(20)]):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        got = toxicity.classify(docs, table)
        assert got.count() == docs.count() and got.where("predicted = 1").count() == 0


def test_bounded_training_rows_and_no_held_out_ones(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "doc_id long, toxic int")
    a = toxicity.train(docs, labels)
    kept = [(i, r) for i, r in enumerate(rows) if zlib.crc32(str(i).encode()) % 5]
    order = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    kept.sort(key=lambda x: order[x[0]])
    b = toxicity.fit([r[0] for _, r in kept], [r[1] for _, r in kept])
    assert a.features.tolist() == b.features.tolist() and np.allclose(a.weights, b.weights)
    few = toxicity.train(docs, labels, max_rows=50)
    c = toxicity.fit([r[0] for _, r in kept[:50]], [r[1] for _, r in kept[:50]])
    assert few.features.tolist() == c.features.tolist()


def test_held_out_labels_of_the_tables(spark):
    """Learned from sf0.01's labels that are not held out: right on the others, and no clean label is called toxic."""
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op11_toxicity(spark, sf_dir).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(labels[i], got[i].predicted) for i in labels if i in got and got[i].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.93 * len(held)
    assert not any(p for y, p in held if y == 0)
