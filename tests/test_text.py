"""Column functions against small independent definitions in Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from mailquarry.functions import text as T
from mailquarry.functions.body import body_columns, body_features
from mailquarry.functions.ngrams import char_ngrams, word_ngrams
from mailquarry.functions.urls import extract_urls

STRINGS = [
    "", " ", " x y", "a\x1cb\x1fc", "aaaa aa", "expires expire", "One. Two three four!? Five", "x" * 300, "A\U0001d7d8 \U00010400B", "ΑΣ Σας",
    "a\n\nb\n \t\nc\n", "\n\nlead\n\n\n\ntrail\n\n", "word " * 51 + ".", "Hi. the the The", "1/8 2.675", "dear bob", "tab\tsep\r\nline",
]


@pytest.fixture(scope="module")
def strings(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(STRINGS)], "i int, s string")


def values(df, column):
    return [r[0] for r in df.select("i", column.alias("v")).orderBy("i").select("v").collect()]


def test_counts_do_not_overlap(strings):
    assert values(strings, T.count_of(F.col("s"), "aa")) == [s.count("aa") for s in STRINGS]
    assert values(strings, T.count_all(F.col("s"), ["expire", "expires"])) == [s.count("expire") + s.count("expires") for s in STRINGS]


def test_words_and_strip_know_all_white_space(strings):
    assert values(strings, T.words(F.col("s"))) == [s.split() for s in STRINGS]
    assert values(strings, T.strip(F.col("s"))) == [s.strip() for s in STRINGS]


def test_body_features_match_plain_python(strings):
    rows = {r.i: r for r in strings.select("i", *[c.alias(n) for n, c in body_columns(F.col("s")).items()]).collect()}
    for i, s in enumerate(STRINGS):
        s = s if s.strip() else ""
        sentences = [x for x in re.split(r"[.!?]+", s) if x.strip()]
        words = [w.lower() for w in s.split()]
        assert rows[i].word_count == len(words)
        assert rows[i].sentence_count == len(sentences)
        assert rows[i].paragraph_count == len([p for p in re.split(r"\n\s*\n", s) if p.strip()])
        assert rows[i].line_count == len([x for x in s.split("\n") if x.strip()])
        assert rows[i].body_length == len(s)
        assert rows[i].has_irregular_sentences == any(not 3 <= len(x.split()) <= 50 for x in sentences)
        assert rows[i].repeated_word_count == sum(a == b for a, b in zip(words, words[1:], strict=False))
        assert rows[i].has_excessive_spacing == bool(re.search(r"\s{4,}", s))
        assert abs(rows[i].avg_word_length - sum(map(len, words)) / max(1, len(words))) <= 0.005 + 1e-9


def test_ratio_rounds_halves_up(spark):
    row = spark.range(1).select(T.ratio(F.lit(1), F.lit(8), 2).alias("a"), T.ratio(F.lit(5), F.lit(0), 2).alias("b")).head()
    assert (row.a, row.b) == (0.13, 5.0)


def test_ngrams_stay_in_words(spark):
    def plain(text):
        out = []
        for w in text.split():
            for n in (3, 4):
                out += [f" {w} "[i : i + n] for i in range(len(w) + 3 - n)]
        return out

    texts = ["ab http", "a", "", "x  yz\tlonger"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(char_ngrams(F.col("t"))).collect()] == [plain(t) for t in texts]
    assert spark.createDataFrame([("A b C",)], "t string").select(word_ngrams(F.col("t"), 1, 2)).head()[0] == ["a", "b", "c", "a b", "b c"]


def test_urls_keep_order_and_drop_trailing_marks(spark):
    text = "go example.com. then http://a.example.org/x). and HTTPS://A.example.org/?q,1! bob@example.com www.site.net\nexample.net/p?,"
    got = spark.createDataFrame([(text,), (None,)], "t string").select(extract_urls(F.col("t"))).collect()
    assert got[0][0] == ["http://a.example.org/x", "HTTPS://A.example.org/?q,1", "www.site.net", "example.net/p?"[:-1]]
    assert got[1][0] == []


def test_body_plan_has_no_python_and_no_shuffle(spark):
    df = body_features(spark.range(1).select(F.lit("1").alias("email_id"), F.lit("x").alias("body")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_white_space_and_repeated_words_by_explicit_characters(spark):
    """The explicit class is that of (?U)\\s and U+001C to U+001F, character by character; repeated words count as tokens side by side do."""
    from mailquarry.functions import body as B

    chars = spark.range(1, 0x10FFFF).where("id < 55296 OR id > 57343").select(F.decode(F.expr("unhex(lpad(hex(id), 8, '0'))"), "UTF-32").alias("c"))
    assert chars.where(F.rlike("c", F.lit(rf"\A[{T.SPACE}]\z")) != F.rlike("c", F.lit(r"(?U)\A[\s\x1c-\x1f]\z"))).count() == 0
    assert chars.where(F.rlike("c", F.lit(rf"\A[^{T.SPACE}]\z")) != F.rlike("c", F.lit(r"(?U)\A[^\s\x1c-\x1f]\z"))).count() == 0
    texts = ["a a a", "aa a", "a aa", " a a a ", "", " ", "x\x1cx y", "\U0001f600 \U0001f600", "ab ab, ab", "you you you", "a.a a.a\n\na.a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    tokens = T.words(F.col("t"))
    pairs = F.size(F.filter(F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), lambda x, y: x == y), lambda x: x))
    got = rows.select(T.count_matches(F.col("t"), B.REPEATED_WORD).alias("ours"), pairs.alias("theirs")).collect()
    assert [r.ours for r in got] == [r.theirs for r in got] and sum(r.ours for r in got) > 7


def test_flags_reuse_their_counts(spark):
    """A flag that says whether a count is above 0 is a comparison with it, not a search of its own."""
    from mailquarry.functions import body as B

    b = B.Body(F.col("t"), F.col("t"))
    for group, flag in (("urgency", "has_urgency"), ("authority", "has_authority_language"), ("threat", "has_threat"), ("request", "has_request"), ("structural", "has_html_tags"), ("money", "mentions_money")):
        assert str(B.GROUPS[group](b)[flag]).startswith("Column<'>(")
