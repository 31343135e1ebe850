"""Each operator against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailquarry.llm import _suffixes, binary, embeddings, jaccard, lines, mixing, packing, pii, quality, repeats
from mailquarry.llm._graph import components as graph_components
from mailquarry.llm._runtime import stage_path
from mailquarry.llm._suffixes import permuted_prefixes, suffix_array
from mailquarry.llm._tokens import Encoder
from mailquarry.llm.queries import tokenizer
from tests.llm import helpers as H

pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def docs(spark):
    return H.documents(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return H.documents(spark, [])


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


# --- mixing


def test_mix_meets_targets(docs, empty):
    got = mixing.mixed_sizes(mixing.mix(docs, slice_rows=2)).collect()
    assert len(got) == docs.count()
    size = lambda t: len(H.WORD.findall(t or ""))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t in rows_of(docs))
    assert all(r.taken <= 3 * r.size for r in got)
    taken, targets = defaultdict(int), {}
    for r in got:
        taken[r.source_size] += r.taken
        targets[r.source_size] = r.target
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    assert all(abs(taken[s] - t) <= largest for s, t in targets.items()) and total - 2 * largest <= sum(taken.values()) <= total
    again = mixing.mixed_sizes(mixing.mix(docs.repartition(5))).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in got)
    assert mixing.mix(empty).count() == 0


def test_mix_deals_rows_of_one_id_over_slices(spark, tmp_path):
    """A third of all rows without id, a third of one id and text: many slices give the takes of one, and reruns the same copies."""
    rows = [(None, H.sentence(k, 1 + k % 7)) for k in range(300)] + [(5, "same text here")] * 300 + [(1000 + k, H.sentence(k, 9)) for k in range(300)]
    docs = H.documents(spark, rows).withColumn("source", F.lit("a")).repartition(5)
    docs.write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    copies = mixing.mix(docs, slice_rows=30)
    got = Counter((r.doc_id, r.size, r.taken) for r in mixing.mixed_sizes(copies).collect())
    whole = Counter((r.doc_id, r.size, r.taken) for r in mixing.mixed_sizes(mixing.mix(docs, slice_rows=10_000)).collect())
    assert got == whole and sum(got.values()) == 900 and all(taken <= size for _, size, taken in got)
    mixed = mixing.mixed_documents(docs, copies)
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, mixing.mixed_documents(docs.repartition(3), copies).collect()))


def test_mix_stops_at_epochs(spark):
    rows = [(i, "w " * 10) for i in range(40)]
    df = H.documents(spark, rows).withColumn("source", F.when(F.col("doc_id") < 38, "a").otherwise("b"))
    got = {r.source: r for r in mixing.sources(df.withColumn("size", F.lit(10).cast("long")), (1, 9), 3).collect()}
    assert got["b"].target == 60 and abs(got["a"].target - 340) < 1e-9


def test_mixed_documents_repeat(docs):
    copies = mixing.mix(docs)
    got = mixing.mixed_documents(docs, copies)
    words = lambda df: df.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).head()[0]
    assert got.columns == docs.columns and words(got) == copies.agg(F.sum("taken")).head()[0]
    names = ["doc_row", "mix_id", "MIX_ROW", "_mix_row", "mix_times", "mix_copy", "mix_source"]
    clashing = mixing.mixed_documents(docs.withColumns({n: F.lit("own") for n in names}), copies)
    assert sorted(map(repr, clashing.select("doc_id", "text").collect())) == sorted(map(repr, got.select("doc_id", "text").collect()))
    assert {tuple(r) for r in clashing.select(*names).distinct().collect()} == {("own",) * len(names)}


# --- tokens


@pytest.mark.parametrize(("name", "keep_space"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cached_tokens_are_the_library_s(name, keep_space):
    texts = [t or "" for t in H.texts()] + [
        "É è, Œuf À. aª µm. .,", " a\tb  c\n\n d ", "it's  'll x<|endoftext|>y", "\x1c a \x85b", "\x01a b", "a　b", "ﬁń é İI Σς", "a\r\nb", "\n\n", "\n.", "1234 567-89 $$$ ###",
    ]
    encode = Encoder(tokenizer(name), keep_space)
    want = [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encode(texts)] == want
    encode._forget()
    assert [x.tolist() for x in encode(texts)] == want


def test_packing(docs, empty):
    path = tokenizer("word_bpe_49k.json")
    got = packing.pack(docs, path, capacity=256, group_pieces=10).collect()
    encode = Encoder(path, False)
    want = Counter()
    for key, text in rows_of(docs):
        ids = np.append(encode([text])[0], np.uint32(1))
        for k, at in enumerate(range(0, len(ids), 256)):
            piece = ids[at : at + 256]
            want[key, k, at, len(piece), zlib.crc32(piece.astype("<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 256
    assert packing.pack(empty, path).count() == 0


def test_sum_of_squares_follows_the_rule():
    """Every placement against a plain definition: of the open bins that fit, the one after which the squares sum to least; ties to the tightest."""
    for seed, most in ((0, 30), (1, 100), (2, 60)):
        lengths = np.random.default_rng(seed).integers(1, most, 200)
        bins, _ = packing.sum_of_squares(lengths, 100)
        gaps: list[int] = []
        for i in np.argsort(-lengths, kind="stable").tolist():
            n = int(lengths[i])
            fits = sorted({g for g in gaps if g >= n})
            if not fits:
                assert bins[i] == len(gaps)
                gaps.append(100 - n)
                continue

            def squares(g, n=n):
                after = Counter(gaps)
                after[g] -= 1
                after[g - n] += 1
                return sum(k * k for x, k in after.items() if x)

            best = min(fits, key=lambda g: (squares(g), g))
            assert gaps[bins[i]] == best
            gaps[bins[i]] -= n
    bins, _ = packing.sum_of_squares(np.array([70, 70, 60, 60, 60, 30]), 100)
    assert bins[5] in bins[2:5]


def test_whole_table_has_the_library_s_ids(spark, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    for name, keep_space in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = tokenizer(name)
        library, texts = tokenizers.Tokenizer.from_file(path), [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
        assert [x.tolist() for x in Encoder(path, keep_space)(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_beyond_the_width_are_refused():
    with pytest.raises(ValueError):
        binary.pack_bits(np.array([1, 70_000], np.uint32), 16)


def test_sum_of_squares_is_near_the_bound():
    lengths = np.random.default_rng(0).integers(1, 400, 3000)
    bins, offsets = packing.sum_of_squares(lengths, 1000)
    assert bins.max() + 1 <= -(-lengths.sum() // 1000) * 1.01 + 1
    assert (np.bincount(bins, lengths) <= 1000).all() and (offsets + lengths <= 1000).all()


def test_binary_round_trip(spark, docs, empty):
    path, vocabulary = stage_path(spark, "ids"), tokenizer("byte_bpe_50k.json")
    binary.write_ids(docs, path, vocabulary, block_ids=500)
    encode, start, want = Encoder(vocabulary, True), 0, []
    for key, text in sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.append(encode([text])[0], np.uint32(0)).astype("<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = binary.index(spark, path).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    assert binary.document_ids(spark, path, [9])[9] == [[*encode(["a b c d e"])[0].tolist(), 0]]
    binary.write_ids(empty, other := stage_path(spark, "ids"), vocabulary)
    assert binary.index(spark, other).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 15, 16, 17, 31])
def test_bits(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype(np.uint32)
    payload = binary.pack_bits(ids, bits)
    assert len(payload) == -(-1001 * bits // 8)
    assert (binary.unpack_bits(payload, bits, 0, 1001) == ids).all() and (binary.unpack_bits(payload, bits, 77, 501) == ids[77:501]).all()
    assert [binary.bits_for(n) for n in (2, 50_257, 65_536, 65_537)] == [1, 16, 16, 17]


# --- lines


def test_line_dedup(docs, empty):
    got = lines.dedup(docs, min_docs=3)
    assert set(got.columns) == {*docs.columns, "n_lines", "n_dropped"} and got.count() == docs.count()
    left = {(r.doc_id, r.text) for r in got.collect()}
    kept = sorted(t for i, t in left if i in (16, 17, 18, 19, 20))
    assert kept[0] == "" and sum("Line of order" in t for t in kept) == 1 and "Line of order 17 shipped\n" + H.sentence(6, 9) in kept
    assert (4, None) in left and (6, " \n\t ") in left and (None, None) in left
    assert lines.dedup(empty).count() == 0
    names = ["drop_id", "drop_twin", "Drop_Pos", "n_lines"]
    clashing = lines.dedup(docs.withColumns({n: F.lit("own") for n in names}), min_docs=3)
    assert {(r.doc_id, r.text) for r in clashing.collect()} == left
    assert {tuple(r) for r in clashing.select(*names[:3]).distinct().collect()} == {("own",) * 3}


def test_line_templates_need_alike_lines(spark):
    rows = [(i, f"alpha beta gamma {w} eta theta iota kappa lambda mu") for i, w in enumerate(["p", "q", "r", "s", "t"])]
    rows += [(10 + i, "alpha beta gamma " + H.sentence(i, 7)) for i in range(5)]
    got = {r.doc_id: r.n_dropped for r in lines.dedup(H.documents(spark, rows), min_docs=5).collect()}
    assert [got[i] for i in range(5)] == [0, 1, 1, 1, 1] and not any(got[10 + i] for i in range(5))


# --- quality


def test_classifier(spark):
    good = [(i, H.sentence(i, 40)) for i in range(150)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in H.sentence(i, 40).split())) for i in range(60)]
    docs = H.documents(spark, [*good, *bad, (5000, None), (5001, ""), (None, "x"), good[0]])
    labels = spark.createDataFrame([*((i, 1) for i, _ in good), *((i, 0) for i, _ in bad), (3, 0), (7, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == 213 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in got if i is not None and zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out and i is not None} == set(held)
    assert all(got[i].predicted == (i < 1000) for i in held if i < 5000)
    assert got[5000].score == got[5001].score
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.classify(docs, flipped).collect()} == {i: r.score for i, r in got.items()}
    none = quality.classify(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert quality.classify(H.documents(spark, []), labels).count() == 0


# --- embeddings


def vectors(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = [[float(v) for v in rng.standard_normal(12)] for _ in range(300)]
    rows += [[v + float(e) for v, e in zip(rows[i % 7], rng.normal(0, 0.12, 12), strict=True)] for i in range(120)]
    rows += [rows[3]] * 9 + [[2 * v for v in rows[4]]]
    rows += [None, [], [0.0] * 12, [float("nan")] * 12, [float("inf")] * 12, [None, 1.0], [1.0, 2.0, 3.0], [1.0, 2.0, 3.0]]
    return spark.createDataFrame([(i * 10, r, 0) for i, r in enumerate(rows)], "vec_id long, embedding array<double>, label int")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def test_embedding_duplicates(spark):
    df = vectors(spark)
    rows = df.orderBy("vec_id").collect()
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, block=16).collect()}
    unit = [np.array(r.embedding) / np.linalg.norm(r.embedding) if usable(r.embedding) and any(r.embedding) else None for r in rows]
    linked = [[i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9 for j, b in enumerate(unit)] for i, a in enumerate(unit)]
    want, found = np.array([sum(x) for x in linked]), np.array([got[r.vec_id].n_links for r in rows])
    assert (found <= want).all() and found.sum() >= 0.97 * want.sum()
    label = H.components(len(rows), linked)
    assert sum(got[r.vec_id].component_id == rows[label[i]].vec_id for i, r in enumerate(rows)) >= 0.98 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embedding_recall_holds_for_large_tables(spark, monkeypatch):
    """Pairs of cosine 0.9 are found with as many projections per table as a million vectors have."""
    hashes = embeddings.hashes_per_table(1_000_000)
    monkeypatch.setattr(embeddings, "hashes_per_table", lambda n: hashes)
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((2, 400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = 0.9 + 1e-9
    pairs = np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * b])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(pairs)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.component_id for r in embeddings.near_duplicates(df).collect()}
    assert sum(got[i] == got[400 + i] for i in range(400)) >= 0.92 * 400


def test_embedding_tables_grow_with_projections():
    for n in (10, 10_000, 100_000, 10**6, 10**7, 10**9):
        k = embeddings.hashes_per_table(n)
        assert 1 - (1 - embeddings.agreement(0.9, 2.0) ** k) ** embeddings.tables_for(k) >= 0.95


def test_top_products_leave_out_short_buckets_in_the_plan(spark):
    """Norms over three orders of magnitude: block pairs that cannot hold answers are not made, and the answers are those of brute force."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 6)) * np.exp(rng.uniform(0, 7, 1500))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embeddings.top_products(df, queries=F.pmod("vec_id", F.lit(10)) == 0, top=4, scale=1, query_block=16, row_block=25).collect()
    whole = np.floor(x).astype(np.int64)
    for i in range(0, 1500, 10):
        scores = whole @ whole[i]
        best = sorted((k for k in range(1500) if k != i), key=lambda k: (-scores[k], k))[:4]
        assert sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == i) == [(n + 1, k, scores[k]) for n, k in enumerate(best)]
    norm = np.linalg.norm(whole, axis=1)
    bands = spark.createDataFrame([(6, b, 2, 0, 2, float(norm[np.floor(np.log(norm) / np.log(1.05)) == b].max())) for b in np.unique(np.floor(np.log(norm) / np.log(1.05)).astype(int)).tolist()], "dim int, band int, blocks int, `from` int, `to` int, top double")
    theta = [(i, float(norm[i]), 6, float(sorted(whole @ whole[i])[-5])) for i in range(0, 1500, 10)]
    placed, pairs = embeddings._pairs(spark.createDataFrame(theta, "vec_id long, norm double, dim int, theta double"), bands, 16)
    all_pairs = placed.select("dim", "need", "q").distinct().count() * bands.count()
    assert 0 < pairs.count() < 0.5 * all_pairs


def test_top_products_of_repeated_ids_in_sql(spark, tmp_path):
    """Rows of one id are one vector, the least, and rows without id none, alike in SQL."""
    import duckdb

    rows = [(i, [float((i * 7) % 11), float(i % 5), 1.0]) for i in range(0, 400, 4)] + [(100, [9.0, -9.0, 0.0]), (100, [5.0, 5.0, 5.0]), (None, [99.0, 99.0, 99.0]), (8, [1.0, float("nan"), 0.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = embeddings.top_products(spark.read.parquet(f"{tmp_path}/embeddings.parquet"))
    assert Counter(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == Counter(con.execute(embeddings.TOP_SQL).fetchall())


def test_top_products(spark):
    df = vectors(spark, 3)
    got = embeddings.top_products(df, top=5, query_block=3, row_block=40).collect()
    whole = {r.vec_id: [int(np.floor(1024 * x)) for x in r.embedding] for r in df.collect() if usable(r.embedding)}
    want = []
    for q, v in whole.items():
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole.items() if i != q and len(v) == len(w))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert embeddings.top_products(df.limit(0)).count() == 0


def test_large_components_multiply_exactly(spark):
    rows = [(0, [3e9, -2e9]), (1, [2.5e9, 1e9]), (2, [-1e9, 1.0]), (3, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embeddings.top_products(df, scale=1).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 5_500_000_000_000_000_000), (3, 0), (2, -3_000_000_002_000_000_000)]


# --- near duplicates and repeats


def test_jaccard_join(docs, empty, monkeypatch):
    rows = rows_of(docs)
    sets = [H.shingles(t) for _, t in rows]
    linked = [[i != j and bool(a and b) and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    label = H.components(len(rows), linked)
    ids = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[label[i]].append(key)
    want = Counter((key, len(sets[i]), min(ids[label[i]], default=None)) for i, (key, _) in enumerate(rows))
    for tile_rows in (4096, 2):
        if tile_rows == 2:
            monkeypatch.setattr(jaccard, "BROADCAST_CLASSES", 0)
        got = jaccard.near_duplicates(docs, tile_rows=tile_rows).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert jaccard.near_duplicates(empty).count() == 0


def test_jaccard_chain_of_near_copies(spark):
    """A chain whose ends are unlike is one group; a large group of near copies and a common passage too."""
    base = H.sentence(11, 200).split()
    chain = [" ".join(base[7 * k : 7 * k + 120]) for k in range(10)]
    rng = np.random.default_rng(1)
    copies = []
    for _ in range(60):
        words = H.sentence(12, 150).split()
        words[int(rng.integers(0, 150))] = "new"
        copies.append(" ".join(words))
    passage = [H.sentence(12, 60) + " " + H.sentence(100 + k, 90) for k in range(40)]
    texts = [*chain, *copies, *passage]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(H.documents(spark, list(enumerate(texts))), tile_rows=16).collect()}
    sets = [H.shingles(t) for t in texts]
    linked = [[i != j and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    assert [got[i] for i in range(len(texts))] == H.components(len(texts), linked)


def test_repeated_rows_are_one_row_of_a_tile(spark):
    """Thousands of repeats of one row next to a near copy: one array per class, whatever the partitions; and links stay."""
    base = H.sentence(21, 200)
    near = base.rsplit(" ", 3)[0] + " other end"
    rows = [(1, base)] * 3000 + [(2, near), (3, H.sentence(22, 80)), (2, H.sentence(23, 80)), (None, near), (None, H.sentence(24, 60)), (None, ""), (4, "")]
    docs = H.documents(spark, rows).repartition(6)
    got = jaccard.near_duplicates(docs, with_groups=True).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter({(1, 1): 3000, (2, 1): 1, (2, 2): 1, (3, 3): 1, (None, 1): 1, (None, None): 2, (4, 4): 1})
    arrays = spark.createDataFrame([(7, base)] * 3000 + [(8, near)], "cls long, text string").repartition(3).mapInArrow(jaccard._arrays(5), "cls long, shingles binary")
    assert arrays.count() <= 6
    kept = Counter(map(tuple, jaccard.kept_rows(jaccard.near_duplicates(docs, with_groups=True)).join(docs.select(F.col("doc_id").alias("i"), "text", F.xxhash64("text").alias("t")).distinct(), F.expr("doc_id <=> i AND twin = t")).select("doc_id", "text").collect()))
    assert kept == Counter([(1, base), (3, rows[3001][1]), (2, rows[3002][1]), (None, rows[3004][1]), (None, ""), (4, "")])


def test_repeats(docs, empty):
    rows = rows_of(docs)
    want = Counter((key, *x) for (key, _), x in zip(rows, H.repeated([(t or "").encode() for _, t in rows], 400), strict=True))
    for shard in (6000, 3):
        got = repeats.remove_repeats(docs, shard_contexts=shard).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
        assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_of_near_copies(spark):
    rng = np.random.default_rng(4)
    base = H.sentence(20, 300)
    texts = []
    for k in range(25):
        words = base.split()
        for at in rng.integers(0, 300, 2):
            words[at] = f"w{k}"
        texts.append(" ".join(words[int(rng.integers(0, 60)) :]))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(H.documents(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(25)] == H.repeated([t.encode() for t in texts], 400)


def test_repeats_at_the_ends_of_texts(spark):
    texts = [H.sentence(30 + k, 80) + " " + H.sentence(29, 200)[: 330 + 10 * (k % 10)] for k in range(30)]
    texts += [H.sentence(29, 200)[k : 400 + k] + H.sentence(70 + k, 30) for k in range(0, 60, 7)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(H.documents(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == H.repeated([t.encode() for t in texts], 400)


def test_repeats_of_passages_in_words(spark):
    """A passage of over 50 words goes if it has 400 bytes; shorter ones go where shorter strings are asked for."""
    passages = [H.sentence(44, 120)[:400], H.sentence(45, 120)[:399], H.sentence(46, 120)[:300]]
    assert min(len(p.split()) for p in passages) > 50
    texts = [x + p + x + H.sentence(500 + 2 * k + (x == "|"), 60) for k, p in enumerate(passages) for x in "|/"]
    for length, anchor in ((400, 340), (250, 190)):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(H.documents(spark, list(enumerate(texts))), length=length, anchor=anchor).collect()}
        assert [got[i] for i in range(len(texts))] == H.repeated([t.encode() for t in texts], length)
        assert [got[i][1] > 0 for i in range(0, len(texts), 2)] == ([True, False, False] if length == 400 else [True, True, True])


def test_repeats_split_hot_anchors(spark, monkeypatch):
    """A passage among different surroundings, some of them shared by two: no shard gets more contexts of an anchor than it takes."""
    passage = H.sentence(40, 200)[:450]
    texts = [H.sentence(200 + k // 2 * (k < 30) + k * (k >= 30), 40)[-70:] + passage + H.sentence(400 + k, 40) for k in range(80)]
    texts += [H.sentence(300 + k, 40) + passage[:430] + H.sentence(400 + k // 2, 40)[:70] for k in range(20)] + [passage[:405], passage[9:], texts[3]]
    docs = H.documents(spark, list(enumerate(texts)))
    sizes = spark.sparkContext.accumulator(0)
    sort = repeats._sorted_shard

    def counted(length, anchor):
        run = sort(length, anchor)

        def one(key: tuple, rows: pa.Table) -> pa.Table:
            if max(Counter(rows["h"].to_pylist()).values()) > 20:
                sizes.add(1)
            return run(key, rows)

        return one

    monkeypatch.setattr(repeats, "_sorted_shard", counted)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs, shard_contexts=20).collect()}
    assert [got[i] for i in range(len(texts))] == H.repeated([t.encode() for t in texts], 400)
    assert sizes.value == 0


def test_repeats_come_from_the_arrays(spark, monkeypatch):
    """Without what the suffix arrays find, nothing goes but exact copies."""
    base = H.sentence(20, 300)
    texts = [base, base, base + " end", H.sentence(21, 200) + " " + base[:900], (H.sentence(22, 100) + "\n") * 3, "a" * 3000]
    docs = H.documents(spark, list(enumerate(texts)))
    sort = repeats._sorted_shard

    def emptied(length, anchor):
        run = sort(length, anchor)
        return lambda key, rows: run(key, rows).slice(0, 0)

    def removed() -> list[int]:
        return [r.n_removed for r in repeats.remove_repeats(docs).orderBy("doc_id").collect()]

    assert removed() == [x[1] for x in H.repeated([t.encode() for t in texts], 400)]
    monkeypatch.setattr(repeats, "_sorted_shard", emptied)
    assert removed() == [len(base), len(base), 0, 0, 0, 0]


@pytest.mark.parametrize("block", [0, 10**9])  # induced by numpy, one by one
def test_suffix_array(monkeypatch, block):
    """Arrays equal sorted suffixes, and carried prefixes equal compared ones, each up to the end of its sequence."""
    monkeypatch.setattr(_suffixes, "_BLOCK", block)
    rng = np.random.default_rng(0)
    for trial in range(200):
        s = np.append(rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(0, 60))), 0)
        if trial % 4 == 0:
            s = np.concatenate([s[:-1], s])  # long shared prefixes
        text = s.tolist()
        order = suffix_array(s)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        ends = np.append(np.flatnonzero(s == 1) if trial % 2 else np.zeros(0, np.int64), len(s) - 1)
        rest = ends[np.searchsorted(ends, np.arange(len(s)))] - np.arange(len(s))
        before, shared = permuted_prefixes(s, order, rest)
        for i in range(len(text)):
            a, b = text[i : i + rest[i]], text[before[i] :] if before[i] >= 0 else []
            assert shared[i] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), *((100 + i, 101 + i) for i in range(30)), *((50, 60 + i) for i in range(20)), (1, 2)]
    got = {r.id: r.component for r in graph_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[3] == 1 and got[5] == 4 and got[130] == 100 and got[79] == 50 and 9 not in got


# --- personal data


def test_personal_data(docs, empty):
    got = pii.find(docs).collect()
    assert len(got) == docs.count()
    row = next(r for r in got if r.doc_id == 22)
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    assert row.base_sha256 == hashlib.sha256(b"email:5:20,ip:66:74,card:43:62,phone:24:41").hexdigest()
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.spans == "" for r in got if r.doc_id in (4, 5, 6))
    assert pii.find(empty).count() == 0
    masked = {r.text for r in pii.redact(docs.where("doc_id = 22")).collect()}
    assert masked == {"mail <email> or <phone>, <card> at <ip>"}


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("a@b.c%d@e.f", ["email:0:5", "email:5:11"]),
        ("a@@b.c @x.y", []),
        ("1.2.3.4.5.6.7.8 999.1.1.1 1..2.3.4.5", ["ip:0:7", "ip:8:15", "ip:29:36"]),
        ("4111-1111 1111 1111 4111111111111112", ["card:0:19"]),
        ("+12345678+123456789 +1 (2) 3", ["phone:9:19"]),
    ],
)
def test_fixed_patterns(text, spans):
    found = pii.base_spans(text)
    if "card" not in "".join(spans):
        assert pii.written(found).split(",") == (spans or [""])
    else:  # a run of digits and single blanks is one match, which then fails as a whole
        assert found == []


def test_random_field_generalises():
    field = pii.train(pii.training_rows())
    table = pii.training_table(seed=99)
    right = sum([pii.LABELS[x] for x in got] == want for got, (_, want) in zip(field.decode([w for w, _ in table]), table, strict=True))
    assert right >= 0.95 * len(table)
    text = 'pay 2531585014589253 with token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" in 2024, version 2.0'
    assert [k for k, _, _ in pii.added_spans(field, [text], [pii.base_spans(text)])[0]] == ["account", "secret"]


def test_field_on_sentences_held_out():
    """F1 of whole spans on labelled sentences that were not trained on."""
    field, rows = pii.train(pii.training_rows()), pii.sentences()[-pii.HELD :]

    def spans(labels):
        ends = [*labels, "O"]
        return {(x[2:], i, next(j for j in range(i + 1, len(ends)) if ends[j][0] != "I")) for i, x in enumerate(labels) if x[0] == "B"}

    right = wrong = 0
    for labels, (_, want) in zip(field.decode([w for w, _ in rows]), rows, strict=True):
        got, gold = spans([pii.LABELS[k] for k in labels]), spans(want)
        right, wrong = right + len(got & gold), wrong + len(got ^ gold)
    assert 2 * right / (2 * right + wrong) >= 0.75


def test_lines_left_closed_hold_no_span(spark, sf_dir):
    """Every line decoded word by word gives labels only where open_lines says so."""
    field = pii.train(pii.training_rows())
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()][:150] + ["", "\n\n", "a\nkey = \"9f86d081884c7d659a2feaa0c55ad015\"\n"]
    for text, numbers in zip(texts, field.open_lines(texts), strict=True):
        lines = text.split("\n")
        labels = field.decode([pii._WORD.findall(x) for x in lines])
        assert {i for i, x in enumerate(labels) if x.any()} <= set(numbers)


def test_spans_do_not_depend_on_what_a_worker_holds(spark, sf_dir, monkeypatch):
    """Any limit of words and any order of texts give the spans of a fresh field for each text."""
    field = pii.train(pii.training_rows())
    texts = sorted(r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()) + H.texts()[:1]
    texts = [t + '\nmy key: "9f86d081884c7d659a2feaa0c55ad015"' * (k % 9 == 0) for k, t in enumerate(texts)]
    bases = [pii.base_spans(t) for t in texts]
    want = []
    for t, b in zip(texts, bases, strict=True):
        field.rows = None
        want += pii.added_spans(field, [t], [b])
    assert sum(map(len, want)) > 10
    for limit, steps in ((50, (7, len(texts))), (3_000, (40,))):
        monkeypatch.setattr(pii, "_MOST_WORDS", limit)
        for step in steps:
            for order in (range(len(texts)), range(len(texts) - 1, -1, -1)):
                order = list(order)
                got = [x for a in range(0, len(order), step) for x in pii.added_spans(field, [texts[i] for i in order[a : a + step]], [bases[i] for i in order[a : a + step]])]
                assert got == [want[i] for i in order]


def test_base_patterns_on_a_whole_table(spark, sf_dir):
    """The contract's patterns by plain regular expressions, over all documents."""
    import re

    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, x):
        digits = re.sub("[^0-9]", "", x)
        if kind == "ip":
            return all(int(p) <= 255 for p in x.split("."))
        return kind == "email" or (13 <= len(digits) <= 19 and pii.luhn(digits) if kind == "card" else 9 <= len(digits) <= 15)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        spans = [(k, m.start(), m.end()) for k, p in plain.items() for m in re.finditer(p, r.text or "") if good(k, m[0])]
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert (got[r.doc_id].n_email, got[r.doc_id].n_ip) == tuple(sum(s[0] == k for s in spans) for k in ("email", "ip"))
        assert got[r.doc_id].n_spans == len([x for x in got[r.doc_id].spans.split(",") if x])


def test_vectors_without_id_or_of_one_id(spark):
    rows = [(None, [1.0, 0.0]), (0, [1.0, 0.1]), (0, [1.0, 0.1]), (1, [1.0, 0.0]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    near = embeddings.near_duplicates(df).collect()
    assert sorted((r.n_links, r.kept) for r in near if r.vec_id is None) == [(0, False), (0, False)]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in near if r.vec_id is not None) == [(0, 2, 0), (0, 2, 0), (1, 2, 0)]
    assert [tuple(r) for r in embeddings.top_products(df).select("query_id", "rank", "vec_id").collect()] == [(0, 1, 1)]


def test_ftrl_is_the_plain_update():
    """Weights after each row's update, by the textbook formulas on a dictionary."""
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(50, 6, replace=False)).astype(np.int32), rng.random(6), int(rng.integers(0, 2))) for _ in range(40)]
    z, n, alpha, beta, l1, l2 = defaultdict(float), defaultdict(float), 0.5, 1.0, 0.02, 0.1
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)
    for _ in range(2):
        for buckets, values, label in rows:
            x = {**dict(zip(buckets.tolist(), values.tolist(), strict=True)), 1 << quality.BITS: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
                n[i] += g * g
    got = quality.ftrl(rows, epochs=2)
    assert np.allclose([got[i] for i in range(50)] + [got[-1]], [weight(i) for i in range(50)] + [weight(1 << quality.BITS)])


def test_line_dedup_of_very_long_texts(spark, tmp_path):
    """Two texts of 60,000 lines that share half of them: rows of lines carry no text, and the work grows with the lines."""
    n = 60_000
    texts = ["\n".join(f"{k if j % 2 else 'both'} line {j} of the long text " + "with more words " * 7 for j in range(n)) for k in ("one", "two")]
    spark.createDataFrame([*enumerate(texts), (9, None), (10, "")], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r for r in lines.dedup(spark.read.parquet(str(tmp_path / "d")), min_docs=3, long_tokens=lines.LONG_TOKENS).collect()}
    assert got[9].text is None and got[10].text == ""
    # Tokens with digits are fields: all lines of "both" are one long line of two documents, which stays at its first place only.
    assert (got[0].n_lines, got[0].n_dropped) == (n, n // 2 - 1) and (got[1].n_lines, got[1].n_dropped) == (n, n // 2)
    for r, t in ((got[0], texts[0]), (got[1], texts[1])):
        own = [x for j, x in enumerate(t.split("\n")) if j % 2 or (j == 0 and r.doc_id == 0)]
        assert r.text.split("\n") == own
