"""Parsing of mails, attachments, the pipeline and the stream."""

from __future__ import annotations

import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from mailquarry.functions.headers import header_features, header_list, header_table, register_sql
from mailquarry.functions.html import html_to_text
from mailquarry.operators import attachments, classifier, convert, profile, sample
from mailquarry.plans import fixtures
from mailquarry.plans.pipeline import joined_features, run_pipeline, wide_features
from mailquarry.sources import files
from mailquarry.sources.eml import ingest, parse_mails
from mailquarry.streaming.features import read_arriving, write_features

HEAD = b"From: Ann <ann@example.com>\r\nSubject: Hi\r\n"
MIXED = (
    HEAD + b"Content-Type: multipart/mixed; boundary=Q\r\n\r\n--Q\r\nContent-Type: multipart/alternative; boundary=R\r\n\r\n"
    b"--R\r\nContent-Type: text/plain\r\n\r\nplain part\r\n--R\r\nContent-Type: text/html\r\n\r\n<p>html part</p>\r\n--R--\r\n"
    b'--Q\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment; filename="a/b:c.pdf"\r\nContent-Transfer-Encoding: base64\r\n\r\n'
    + base64.b64encode(b"%PDF-data")
    + b"\r\n--Q\r\nContent-Type: image/png\r\nContent-Disposition: inline\r\nContent-Transfer-Encoding: base64\r\n\r\n"
    + base64.b64encode(b"PNG")
    + b"\r\n--Q--\r\n"
)
MAILS = {
    "plain.eml": HEAD + b"\r\n  hello \r\n",
    "deep/html.eml": HEAD + b"Content-Type: text/html; charset=utf-8\r\n\r\n<style>x</style><p>Caf\xc3\xa9 &amp; bar</p><script>y</script>",
    "deep/er/mixed.eml": MIXED,
    "charset.eml": HEAD + b"Content-Type: text/plain; charset=DEFAULT\r\n\r\nna\xc3\xafve",
    "wrong.eml": HEAD + b"Content-Type: text/plain; charset=utf-8\r\n\r\nbad \xff byte",
    "lf.eml": b"From: a@example.com\nX: 1\n\nbody\r\n\r\ntail",
    "lf_only.eml": b"From: a@example.com\nX: 1\n\nbody",
    "bare.eml": b"From: a@example.com\r\nX: 1",
    "quoted.eml": HEAD + b"Content-Transfer-Encoding: quoted-printable\r\n\r\na=3Db",
    "b64.eml": HEAD + b"Content-Transfer-Encoding: base64\r\n\r\n" + base64.b64encode(b"coded"),
    "folded.eml": b"Received: a\r\n\tby b\r\nReceived: c\r\n\r\nx",
    "empty.eml": b"",
    "other.txt": HEAD + b"\r\nno eml",
}


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("mails")
    for name, raw in MAILS.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(raw)
    return str(root)


@pytest.fixture(scope="module")
def mails(spark, corpus):
    return {r.og_fname: r for r in ingest(spark, corpus, label="ham").collect()}


def test_every_file_is_parsed(mails):
    assert set(mails) == {n.rsplit("/", 1)[-1] for n in MAILS}
    assert {r.label for r in mails.values()} == {"ham"} and not any(r._parse_error for r in mails.values())


def test_bodies(mails):
    want = {"plain.eml": "hello", "html.eml": "Café & bar", "mixed.eml": "plain part", "charset.eml": "naïve", "wrong.eml": "bad � byte", "lf_only.eml": "body", "bare.eml": "", "quoted.eml": "a=b", "b64.eml": "coded", "other.txt": "no eml"}
    assert {n: mails[n].body for n in want} == want


def test_header_split(mails):
    assert mails["lf.eml"].raw_headers == "From: a@example.com\nX: 1\n\nbody"  # CRLF first, wherever it stands
    assert mails["lf_only.eml"].raw_headers == "From: a@example.com\nX: 1"
    assert mails["bare.eml"].raw_headers == "From: a@example.com\r\nX: 1"
    assert mails["folded.eml"].header_list == "Received,Received"


def test_attachments(mails):
    found = mails["mixed.eml"].attachments
    assert [(a.filename, a.content_type, base64.b64decode(a.data_base64)) for a in found] == [("a_b_c.pdf", "application/pdf", b"%PDF-data"), ("unnamed_attachment.png", "image/png", b"PNG")]
    assert found[0].hash == hashlib.sha256(b"%PDF-data").hexdigest()


def test_empty_and_missing_content(spark):
    rows = parse_mails(spark.createDataFrame([("/a", bytearray()), ("/b", None)], "path string, content binary")).collect()
    assert [(r.og_fname, r.body, r.header_list, r.attachments) for r in rows] == [("a", "", "", []), ("b", "", "", [])]


def test_ids_are_stable_and_glob_selects(spark, corpus, mails):
    again = ingest(spark, corpus, glob="*.txt").collect()
    assert [r.email_id for r in again] == [mails["other.txt"].email_id]
    assert ingest(spark, [f"{corpus}/plain.eml", f"{corpus}/b64.eml"]).count() == 2


def test_pipeline_round_trip(spark, corpus, tmp_path):
    paths = run_pipeline(spark, corpus, str(tmp_path / "out"), label="spam")
    wide = joined_features(spark, paths)
    assert wide.count() == len(MAILS) and len(wide.columns) == 1 + 27 + 43
    mails = spark.read.parquet(paths["parsed"])
    files.write_json(mails, str(tmp_path / "lines"))
    files.write_json(mails.limit(1), str(tmp_path / "lines"))
    back = files.read_parsed(spark, str(tmp_path / "lines"))
    assert back.count() == len(MAILS) + 1 and back.where("body = 'Café & bar'").count() == 1


def test_rebuild(spark, corpus, tmp_path):
    mails = ingest(spark, corpus)
    assert {(r.n_bytes, r.n_same) for r in attachments.rebuild(mails).collect()} == {(9, 1), (3, 1)}
    assert not list(tmp_path.rglob("*.pdf"))
    attachments.rebuild(mails, str(tmp_path / "out"), str(tmp_path / "staging"))
    found = {p.name: p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert found == {"a_b_c.pdf": b"%PDF-data", "unnamed_attachment.png": b"PNG"}
    with pytest.raises(ValueError):
        attachments.rebuild(mails, str(tmp_path / "out"))


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    mails = fixtures.emails(spark, sf_dir)
    mails.write.json(str(tmp_path / "in"))
    write_features(read_arriving(spark, str(tmp_path / "in"), 2), str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    got, want = spark.read.parquet(str(tmp_path / "out")), wide_features(mails)
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_malformed_headers(spark):
    raw = "A: 1\r\n  folded\r\nno colon here\r\nFrom: late@example.com"
    df = spark.createDataFrame([("1", raw), ("2", None), ("3", ""), ("4", "FROM: =?u?q?x?= <A1@Gmail.com>\nDate: 32 Jan")], "email_id string, raw_headers string")
    assert [r[0] for r in df.select(header_list(header_table(F.col("raw_headers")))).collect()] == ["A", "", "", "FROM,Date"]
    rows = {r.email_id: r for r in header_features(df).collect()}
    assert rows["4"].from_free_provider and rows["4"].from_has_numbers and rows["4"].unicode_in_from and rows["4"].day_of_week == -1
    assert rows["1"].display_name_empty and rows["2"].missing_message_id and rows["3"].data_quality_score == 2
    register_sql(spark)
    assert spark.sql("SELECT rfc_parts('a <b@c.d>', '', 'Mon, 06 Jan 2025 09:15:00 -0200').tz").head()[0] == -7200


def test_html(spark):
    cases = {"a<br><br>b": "a\nb", "<!-- x --><p>1</p>": "1", "<noscript>n</noscript>k": "k", "1 < 2 &lt;b&gt; &amp;lt;": "1 < 2 <b> &lt;", None: ""}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert [r[0] for r in df.select(html_to_text(F.col("h"))).collect()] == list(cases.values())


ODD = [
    '{"a.b": 1.50, "it\'s": "x", "q\\"q": [1, {"k": null}], "$": null, "": "empty"}', '{"a.b": {"c": true}, "z": 12345678901234567890}', '{"z": 2}',
    "[1, 2]", "{broken", '{"d": 1, "d": 2}', None, "{}",
]


def test_json_keys_of_any_characters(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "id int, j string")
    wide = convert.json_union(df, "j", keep=("id",), corrupt="bad")
    assert wide.columns == ["id", "", "$", "a.b", "it's", "q\"q", "z", "bad"]
    got = {r[0]: tuple(r)[1:] for r in wide.collect()}
    assert got[0] == ("empty", None, "1.5", "x", '[1,{"k":null}]', None, None)
    assert got[1][2:3] == ('{"c":true}',) and got[1][5] == "12345678901234567890" and got[2][5] == "2"
    assert [i for i in got if got[i][6] is not None] == [3, 4, 5] and got[6] == got[7] == (None,) * 7
    few = convert.json_union(df, "j", keep=("id",), max_columns=2)
    assert few.columns == ["id", "a.b", "z", "_rest"]  # the keys of most rows; the others stay together
    rest = {r.id: r._rest for r in few.collect()}
    assert json.loads(rest[0]) == {"": "empty", "it's": "x", 'q"q': '[1,{"k":null}]'} | ({"$": None} if "$" in rest[0] else {}) and rest[1] is None and rest[7] is None
    kinds = {r.key: (r.n, r.kind) for r in profile.json_types(df, "j").collect()}
    assert kinds["z"] == (2, "DECIMAL(20,0)") and kinds["a.b"] == (2, "VARIANT") and kinds["it's"] == (1, "STRING")
    assert {r.key for r in profile.keys(df, "j").collect()} == {"", "$", "a.b", "it's", 'q"q', "z"}
    assert convert.json_union(df.where("id > 5"), "j", keep=("id",)).columns == ["id"]


def test_lines_that_are_no_json(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n\n{"a": \n{"b, c": "x\\ny"}\n')
    convert.jsonl_to_csv(spark, str(tmp_path / "x.json"), str(tmp_path / "csv"), corrupt="bad")
    back = files.read_csv(spark, str(tmp_path / "csv"), ["a", "b, c", "bad"])
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, [("1", None, None), (None, "x\ny", None), (None, None, '{"a": ')]))
    with pytest.raises(Exception, match="no JSON object"):
        convert.jsonl_to_csv(spark, str(tmp_path / "x.json"), str(tmp_path / "other"))
    (tmp_path / "mails").write_text('{"email_id": "1", "body": "b"}\n{"email_id": \n')
    got = files.read_parsed(spark, str(tmp_path / "mails"), corrupt="bad").collect()
    assert [(r.email_id, r.bad) for r in got] == [("1", None), (None, '{"email_id": ')]
    assert files.read_parsed(spark, str(tmp_path / "mails")).count() == 2


def test_slopes_in_sql_from_exported_weights(spark, sf_dir, duck):
    """The gradient at the fitted weights, recomputed in DuckDB; and away from the optimum it is no longer flat."""
    from mailquarry.plans.other_queries import url_grams

    rows = classifier.with_grams(fixtures.urls(spark, sf_dir))
    for rounds, flat in ((1000, True), (2, False)):
        model = classifier.train(rows, size=300, rounds=rounds, tolerance=1e-12)
        ours = {r.term: r.gradient for r in classifier.gradient(model, rows, "page_id").collect()}
        counts, fitted = model.stages
        weights = [(t, float(w)) for t, w in zip(counts.vocabulary, fitted.coefficients.toArray(), strict=True)]
        duck.execute("CREATE OR REPLACE TABLE weights (term VARCHAR, weight DOUBLE)")
        duck.executemany("INSERT INTO weights VALUES (?, ?)", weights)
        theirs = dict(duck.execute(f"""
{url_grams}, counts AS (SELECT page_id, gram AS term, count(*) AS n FROM listed SEMI JOIN weights ON gram = term GROUP BY page_id, gram),
margins AS (SELECT p.page_id, label, {fitted.intercept!r} + coalesce(sum(n * weight), 0) AS m FROM ({fixtures.urls_sql()}) p LEFT JOIN (SELECT * FROM counts JOIN weights USING (term)) USING (page_id) GROUP BY p.page_id, label),
residuals AS (SELECT page_id, 1 / (1 + exp(-m)) - label AS r FROM margins)
SELECT term, coalesce(sum(n * r), 0) / (SELECT count(*) FROM residuals) + {fitted.getOrDefault("regParam")!r} * any_value(weight) FROM weights LEFT JOIN counts USING (term) LEFT JOIN residuals USING (page_id) GROUP BY term
UNION ALL SELECT NULL, avg(r) FROM residuals""").fetchall())
        assert set(ours) == set(theirs) and all(abs(ours[t] - theirs[t]) < 1e-9 for t in ours)
        assert (max(map(abs, ours.values())) < 1e-5) == flat


def test_profile_and_conversion(spark, tmp_path):
    lines = [{"a": 1, "b": [1, 2]}, {"a": 1, "c": {"d": 2}}, {"b": []}]
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, lines)))
    df = spark.read.json(str(tmp_path / "x.json"))
    assert {(r.key, r.value): r.n for r in profile.value_counts(df).collect()} == {("a", "1"): 2, ("b", "list_length_2"): 1, ("b", "list_length_0"): 1, ("c", '{"d":2}'): 1}
    assert {r.key: r.pct_missing for r in profile.completeness(df).collect()} == {"a": 33.33, "b": 33.33, "c": 66.67}
    assert {r.key for r in profile.keys(df).collect()} == {"a", "b", "c"}
    with pytest.raises(ValueError):
        profile.value_counts(df, ["z"])
    convert.jsonl_to_csv(spark, str(tmp_path / "x.json"), str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), ["a", "b", "c"])
    assert sorted(map(tuple, back.fillna("").collect())) == sorted([("1", "[1,2]", ""), ("1", "", '{"d":2}'), ("", "[]", "")])
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "csv"), ["nope"])


def test_classifier_learns_saves_and_loads(spark, tmp_path):
    rows = [(f"http://{'bad-bets' if i % 3 == 0 else 'fine-news'}{i}.example.com/p", int(i % 3 == 0)) for i in range(90)]
    df = classifier.with_grams(spark.createDataFrame(rows, "url string, label int")).withColumn("test", classifier.is_test(F.col("url")))
    model = classifier.train(df.where(~F.col("test")), size=300, rounds=30)
    assert classifier.metrics(model.transform(df.where("test"))).head().f1 == 1.0
    classifier.save(model, str(tmp_path), "u1")
    assert classifier.load(str(tmp_path), "u1").transform(df).where("prediction = label").count() == 90
    assert classifier.metrics(df.withColumn("prediction", F.lit(0))).head().precision == 0.0


def test_slopes_hold_for_rows_of_one_id(spark):
    """Residuals go with their own row's grams: rows that share an id give the slopes of rows that do not, and nothing is joined by it."""
    rows = classifier.with_grams(spark.createDataFrame([(k, f"http://a{k}.com/{'x' * (k % 4)}", int(k % 3 == 0)) for k in range(40)], "page_id long, url string, label int"))
    model = classifier.train(rows, size=30, rounds=2)
    slopes = lambda r: {x.term: x.gradient for x in classifier.gradient(model, r, "page_id").collect()}
    apart, shared = slopes(rows), slopes(rows.withColumn("page_id", F.lit(1)))
    assert len(apart) == 31 and max(map(abs, apart.values())) > 1e-6
    assert shared == pytest.approx(apart, abs=1e-12)
