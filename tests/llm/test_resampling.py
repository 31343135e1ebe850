"""Importance resampling against a plain definition, over awkward tables and longer runs of words."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailquarry.llm import resampling
from tests.llm import helpers as H


def grams(text, n):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(H.LOWER))
    return [zlib.crc32(" ".join(found[i : i + k]).encode()) for k in range(1, n + 1) for i in range(len(found) - k + 1)], len(found)


def plain_definition(rows, target, n=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    source, goal = Counter(), Counter()
    for _, text in rows:
        source.update(g % buckets for g in grams(text, n)[0])
    for text in target:
        goal.update(g % buckets for g in grams(text, n)[0])
    all_s, all_t = sum(source.values()), sum(goal.values())
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (all_s + buckets) / ((source[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in rows:
        found, n_words = grams(text, n)
        weight = sum(gain[g % buckets] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words >= min_words))
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = Counter()
    ranked = []
    for place, r in enumerate(fit[: percent * len(fit) // 100], 1):
        ranked.append((*r[:4], place))
        drawn[r] += 1
    rest = Counter(out) - drawn
    return Counter(ranked) + Counter({(*r[:4], None): k for r, k in rest.items()})


def rows():
    texts = [*H.texts(), "One.TWO\n\nthree\nfour five\n", "a\nb\nc\nd e f\ng", "\n\n", "Éé x1_y2-z", "same line\nsame line\nsame line"]
    found = [(i, t) for i, t in enumerate(texts)] + [(100 + i, H.sentence(i % 30, 18 + i % 9) + "\nthe shared line of all") for i in range(90)]
    return [*found, (0, texts[0]), (7, "another text of id seven"), (None, "no id"), (None, None), (None, H.sentence(77, 40))]


@pytest.mark.parametrize(("n", "buckets", "percent"), [(1, 10_000, 10), (3, 70_000, 50), (2, 97, 100)])
def test_equals_the_definition(spark, n, buckets, percent):
    target = ["the end and the line", None, "", H.sentence(3, 30) + "\nsecond line of it"]
    docs = H.documents(spark, rows()).withColumn("row_id", F.lit("own")).repartition(4)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, goal, max_words=n, buckets=buckets, percent=percent).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == plain_definition(rows(), target, n, buckets, percent=percent)


def test_runs_across_lines_are_the_others():
    lines = [b"a b", b"", b"c", b"d e f"]
    whole = [w for x in lines for w in resampling.words(x)]
    for n in (1, 2, 3, 5):
        split = Counter(resampling.crossing([resampling.words(x) for x in lines], n))
        for x in lines:
            split.update(resampling.inside(resampling.words(x), n, resampling._Codes()))
        assert split == Counter(resampling.inside(whole, n, resampling._Codes()))


def test_each_distinct_line_is_one_segment(spark):
    docs = H.documents(spark, [(i, "the line\nthe line\nown " + str(i % 3)) for i in range(12)])
    found = {r.times: r for r in resampling.segments(docs, "text", 1, 100).where("n_words = 2").collect()}
    assert set(found) == {24, 4} and resampling.segments(docs, "text", 1, 100).count() == 4
    assert resampling.bucket_counts(resampling.segments(docs, "text", 1, 100), 100).sum() == 72


def test_empty_tables(spark):
    none, some = H.documents(spark, []), H.documents(spark)
    assert resampling.resample(none, some).count() == 0
    got = resampling.resample(some, none, percent=100)
    assert got.count() == some.count() and got.where("rank IS NOT NULL").count() == got.where("n_words >= 20").count()
    kept = resampling.drawn_documents(some, got)
    assert kept.columns == some.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got.where("rank IS NOT NULL").collect()}
