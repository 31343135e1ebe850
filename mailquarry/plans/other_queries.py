"""Queries beside body, header and URL features: parsing, profiling, attachments, n-grams, the classifier, streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.functions import attachments as A
from mailquarry.functions import html as M
from mailquarry.functions import ngrams as N
from mailquarry.operators import attachments as AO
from mailquarry.operators import classifier as C
from mailquarry.operators import convert, profile, sample
from mailquarry.plans import fixtures, scratch
from mailquarry.plans.body_sql import EXPRESSIONS as BODY
from mailquarry.plans.body_sql import SPACE, _typed, quoted
from mailquarry.plans.mail_sql import EXPRESSIONS as HEAD
from mailquarry.plans.mail_sql import URLS_PER_MAIL, headers_sql
from mailquarry.plans.pipeline import wide_features
from mailquarry.sources.eml import parse_mails
from mailquarry.streaming.features import read_arriving, write_features

SAMPLE_SEED, SAMPLE_ROWS, TOP_TERMS, WIDE_TERMS = 11, 25, 500, 10

PARTS = """
SELECT d.doc_id AS email_id, CASE WHEN d.doc_id % 3 = 0 THEN '' WHEN d.doc_id % 7 = 0 THEN NULL ELSE concat('  ', d.text, chr(10)) END AS plain, p.html
FROM {docs} d LEFT JOIN {pages} p ON d.doc_id = p.page_id"""
RAW = """
SELECT doc_id AS email_id, CASE doc_id % 4
  WHEN 0 THEN concat('A: 1', chr(13), chr(10), 'B: 2', chr(13), chr(10), chr(13), chr(10), text)
  WHEN 1 THEN concat('A: 1', chr(10), 'B: 2', chr(10), chr(10), text)
  WHEN 2 THEN concat('A: 1', chr(10), chr(10), text, chr(13), chr(10), chr(13), chr(10), 'tail')
  ELSE concat('A: ', doc_id) END AS raw
FROM {docs}"""
#: Mails of seven kinds with what their parsing gives: plain, html, both, nested with a file, base64, undeclared charset with an unnamed inline part and a file, latin-1.
MIME = """
WITH texts AS (SELECT doc_id, doc_id % 7 AS kind, coalesce(text, '') AS t, concat(chr(13), chr(10)) AS nl FROM {docs}),
pages AS (SELECT *, concat('<html><head><style>p</style></head><body><p>', replace(replace(t, '<', ''), '&', ''), '</p>&amp; more</body></html>') AS h,
  concat('From: a', doc_id, '@example.com', nl, 'Subject: Mail ', doc_id, nl, 'MIME-Version: 1.0', nl, 'Content-Type: ') AS top FROM texts)
SELECT concat('mail_', doc_id, '.eml') AS og_fname, kind, t, h,
  CASE WHEN kind IN (0, 2, 4, 5) THEN t WHEN kind = 6 THEN concat('Caf', chr(233), ' = ', doc_id) ELSE '' END AS plain,
  CASE WHEN kind IN (1, 2, 3) THEN h ELSE '' END AS html,
  CASE kind
    WHEN 0 THEN concat(top, 'text/plain; charset=utf-8', nl, 'Content-Transfer-Encoding: 8bit', nl, nl, t)
    WHEN 1 THEN concat(top, 'text/html; charset=utf-8', nl, nl, h)
    WHEN 2 THEN concat(top, 'multipart/alternative; boundary=zz_alt', nl, nl, '--zz_alt', nl, 'Content-Type: text/plain; charset=utf-8', nl, nl, t, nl, '--zz_alt', nl, 'Content-Type: text/html; charset=utf-8', nl, nl, h, nl, '--zz_alt--', nl)
    WHEN 3 THEN concat(top, 'multipart/mixed; boundary=zz_mix', nl, nl, '--zz_mix', nl, 'Content-Type: multipart/alternative; boundary=zz_alt', nl, nl, '--zz_alt', nl, 'Content-Type: text/html; charset=utf-8', nl, nl, h, nl, '--zz_alt--', nl,
      '--zz_mix', nl, 'Content-Type: application/pdf', nl, 'Content-Disposition: attachment; filename="a/b:c.pdf"', nl, 'Content-Transfer-Encoding: base64', nl, nl, @b64@, nl, '--zz_mix--', nl)
    WHEN 4 THEN concat(top, 'text/plain; charset=utf-8', nl, 'Content-Transfer-Encoding: base64', nl, nl, @b64@)
    WHEN 5 THEN concat(top, 'multipart/mixed; boundary=zz_mix', nl, nl, '--zz_mix', nl, 'Content-Type: text/plain; charset=DEFAULT', nl, 'Content-Transfer-Encoding: 8bit', nl, nl, t, nl, '--zz_mix', nl, 'Content-Type: image/png', nl, 'Content-Disposition: inline', nl,
      'Content-Transfer-Encoding: base64', nl, nl, 'cG5n', nl, '--zz_mix', nl, 'Content-Type: text/plain', nl, 'Content-Disposition: attachment; filename=note.txt', nl, nl, 'note', nl, '--zz_mix--', nl)
    ELSE concat(top, 'text/plain; charset=iso-8859-1', nl, 'Content-Transfer-Encoding: quoted-printable', nl, nl, 'Caf=E9 =3D ', doc_id) END AS raw
FROM pages"""
NAMED = """
SELECT conv_id, turn, text,
       CASE conv_id % 5 WHEN 0 THEN concat('report:', turn, '.pdf') WHEN 1 THEN concat('a/b', chr(92), 'c*?"<>|.txt') WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'plain.txt' END AS filename,
       CASE WHEN conv_id % 2 = 0 THEN concat('name', turn, '.bin') END AS name,
       CASE turn % 3 WHEN 0 THEN '.png' WHEN 1 THEN '' END AS extension
FROM {talks}"""
RAGGED = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN '{{"k": 1, "list": [1, 2]}}' ELSE '{{"name": "x", "sub": {{"a": 1}}}}' END AS props FROM {events}"""

_named = NAMED.format(talks="conversations")
_name = r"""regexp_replace(coalesce(nullif(filename, ''), nullif(name, ''), concat('unnamed_attachment', coalesce(nullif(extension, ''), '.bin'))), '[/\\:*?"<>|]', '_', 'g')"""
_entities = "@"
for _entity, _char in M.ENTITIES.items():
    _entities = f"replace({_entities}, {quoted(_entity)}, {quoted(_char)})"


def html_sql(column: str) -> str:
    """Text of html, as the column function gives it; RE2 has no back references, so each element is taken out by itself."""
    text = f"regexp_replace(coalesce({column}, ''), '(?is)<!--.*?-->|<![^>]*>', '<!>', 'g')"
    for name in M.SILENT:
        text = rf"regexp_replace({text}, '(?is)<{name}\b[^>]*>.*?</{name}\s*>', '<!>', 'g')"
    text = f"regexp_replace({text}, '(?:<[!/a-zA-Z][^>]*>)+', chr(10), 'g')"
    return strip_sql(_entities.replace("@", text))


def strip_sql(text: str) -> str:
    return f"regexp_replace({text}, {quoted(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def _counts_sql(table: str, columns: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS key, {e} AS value FROM {table}" for c, e in columns.items())
    return f"SELECT key, value, count(*) AS n FROM ({rows}) WHERE value IS NOT NULL GROUP BY key, value"


url_grams = """
WITH pages_urls AS (SELECT page_id, list_filter(regexp_split_to_array(url, '[\\s]+'), lambda w: w <> '') AS w FROM pages),
pieces AS (SELECT page_id, unnest(range(len(w))) AS word_no, concat(' ', unnest(w), ' ') AS p FROM pages_urls),
sized AS (SELECT page_id, word_no, p, n FROM pieces, (VALUES (3), (4)) s(n) WHERE length(p) >= n),
grams AS (SELECT page_id, word_no, n, unnest(range(1, length(p) - n + 2)) AS i, p FROM sized),
listed AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY word_no, n, i) - 1 AS BIGINT) AS pos, substr(p, i, n) AS gram FROM grams)"""
_top = lambda k: f""",
counted AS (SELECT gram AS term, count(*) AS tf FROM listed GROUP BY gram ORDER BY tf DESC, term LIMIT {k})"""  # noqa: E731


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_grams(fixtures.urls(spark, sf_dir))


def register_all(register) -> None:
    """Add every query of this module."""
    table = fixtures.table

    @register("label_static", "SELECT doc_id, 'ham' AS label FROM documents")
    def label_static(spark, sf_dir):
        return sample.with_label(table(spark, sf_dir, "documents").select("doc_id"), "ham")

    @register("contiguous_sample", f"""
SELECT * EXCLUDE (row_no, total) FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS row_no, count(*) OVER () AS total FROM documents)
WHERE row_no - CAST(floor({sample.start_share(SAMPLE_SEED)!r} * (total - {SAMPLE_ROWS} + 1)) AS BIGINT) BETWEEN 0 AND {SAMPLE_ROWS - 1}""")
    def contiguous_sample(spark, sf_dir):
        return sample.contiguous(table(spark, sf_dir, "documents"), "doc_id", SAMPLE_ROWS, SAMPLE_SEED, scratch.folder(spark, "sample"))

    @register("profile_value_counts", _counts_sql("events", {"event_type": "event_type", "user_id": "CAST(user_id AS VARCHAR)"}))
    def profile_value_counts(spark, sf_dir):
        return profile.value_counts(table(spark, sf_dir, "events"), ["event_type", "user_id"])

    @register("profile_list_lengths", _counts_sql("embeddings", {"embedding": "concat('list_length_', len(embedding))", "label": "CAST(label AS VARCHAR)"}))
    def profile_list_lengths(spark, sf_dir):
        return profile.value_counts(table(spark, sf_dir, "embeddings"), ["embedding", "label"])

    @register("profile_disregard", _counts_sql("documents", {"lang": "lang", "source": "source"}))
    def profile_disregard(spark, sf_dir):
        return profile.value_counts(table(spark, sf_dir, "documents"), disregard=["doc_id", "text", "n_chars"])

    @register("profile_keys", f"SELECT DISTINCT unnest(json_keys(props)) AS key FROM ({RAGGED.format(events='events')})")
    def profile_keys(spark, sf_dir):
        return profile.keys(spark.sql(RAGGED, events=table(spark, sf_dir, "events")), "props")

    missing = " UNION ALL ".join(f"SELECT '{c}' AS key, count(*) AS total, count({c}) AS present FROM mails" for c in ("body", "raw_headers", "label"))

    @register("profile_missing", f"WITH mails AS ({fixtures.emails_sql()}), sums AS ({missing}) SELECT *, (((total - present) * 100 * 200 + total) // (2 * total)) / CAST(100 AS DOUBLE) AS pct_missing FROM sums")
    def profile_missing(spark, sf_dir):
        return profile.completeness(fixtures.emails(spark, sf_dir), ["body", "raw_headers", "label"])

    fields = ", ".join(f"json_extract_string(props, '$.{k}') AS {k}" for k in ("k", "list", "name", "sub"))

    @register("jsonl_union_columns", f"SELECT event_id, k, regexp_replace(list, '\\s', '', 'g') AS list, name, regexp_replace(sub, '\\s', '', 'g') AS sub FROM (SELECT event_id, {fields} FROM ({RAGGED.format(events='events')}))")
    def jsonl_union_columns(spark, sf_dir):
        rows = spark.sql(RAGGED, events=table(spark, sf_dir, "events"))
        return convert.json_union(rows, "props", keep=("event_id",))

    @register("raw_header_split", f"SELECT email_id, CASE WHEN contains(raw, concat(chr(13), chr(10), chr(13), chr(10))) THEN string_split(raw, concat(chr(13), chr(10), chr(13), chr(10)))[1] ELSE string_split(raw, concat(chr(10), chr(10)))[1] END AS raw_headers FROM ({RAW.format(docs='documents')})")
    def raw_header_split(spark, sf_dir):
        rows = spark.sql(RAW, docs=table(spark, sf_dir, "documents"))
        return rows.select("email_id", M.raw_headers(F.col("raw")).alias("raw_headers"))

    @register("html_to_text", f"SELECT page_id, {html_sql('html')} AS body FROM pages")
    def html_to_text(spark, sf_dir):
        return table(spark, sf_dir, "pages").select("page_id", M.html_to_text(F.col("html")).alias("body"))

    @register("body_select", f"SELECT email_id, CASE WHEN coalesce(plain, '') <> '' THEN {strip_sql('plain')} ELSE {html_sql('html')} END AS body FROM ({PARTS.format(docs='documents', pages='pages')})")
    def body_select(spark, sf_dir):
        rows = spark.sql(PARTS, docs=table(spark, sf_dir, "documents"), pages=table(spark, sf_dir, "pages"))
        return rows.select("email_id", M.select_body(F.col("plain"), F.col("html")).alias("body"))

    def named(spark, sf_dir):
        return spark.sql(NAMED, talks=table(spark, sf_dir, "conversations"))

    @register("attachment_names", f"SELECT conv_id, turn, {_name} AS filename FROM ({_named})")
    def attachment_names(spark, sf_dir):
        return named(spark, sf_dir).select("conv_id", "turn", A.safe_name(F.col("filename"), F.col("name"), F.col("extension")).alias("filename"))

    @register("attachment_hash", "SELECT conv_id, turn, sha256(text) AS hash FROM conversations")
    def attachment_hash(spark, sf_dir):
        return table(spark, sf_dir, "conversations").select("conv_id", "turn", A.content_hash(F.col("text").cast("binary")).alias("hash"))

    @register("base64_roundtrip", "SELECT conv_id, turn, to_base64(encode(text)) AS data_base64, text FROM conversations")
    def base64_roundtrip(spark, sf_dir):
        rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", A.encode(F.col("text").cast("binary")).alias("data_base64"))
        return rows.withColumn("text", A.decode(F.col("data_base64")).cast("string"))

    @register("attachment_manifest", f"""
WITH files AS (SELECT CAST(conv_id AS VARCHAR) AS email_id, concat('test_attachments/', conv_id, '/', {_name}) AS key, octet_length(encode(text)) AS n_bytes, sha256(text) AS hash FROM ({_named}) WHERE text IS NOT NULL)
SELECT email_id, key, CAST(n_bytes AS BIGINT) AS n_bytes, hash, count(*) OVER (PARTITION BY email_id, key) AS n_same FROM files""")
    def attachment_manifest(spark, sf_dir):
        data = F.col("text").cast("binary")
        one = F.struct(A.safe_name(F.col("filename"), F.col("name"), F.col("extension")).alias("filename"), F.lit("text/plain").alias("content_type"), A.content_hash(data).alias("hash"), A.encode(data).alias("data_base64"))
        mails = named(spark, sf_dir).where("text IS NOT NULL").groupBy(F.col("conv_id").cast("string").alias("email_id")).agg(F.collect_list(one).alias("attachments"))
        return AO.manifest(mails)

    @register("eml_mime", f"""
WITH mails AS ({MIME.replace('@b64@', 'to_base64(encode(t))').format(docs='documents')}), ids AS (SELECT *, sha256(concat('/mails/', og_fname, raw)) AS id FROM mails)
SELECT concat_ws('-', substr(id, 1, 8), substr(id, 9, 4), substr(id, 13, 4), substr(id, 17, 4), substr(id, 21, 12)) AS email_id, og_fname,
  concat('From,Subject,MIME-Version,Content-Type', CASE WHEN kind IN (0, 4, 6) THEN ',Content-Transfer-Encoding' ELSE '' END) AS header_list,
  CASE WHEN plain <> '' THEN {strip_sql('plain')} ELSE {html_sql('html')} END AS body,
  CASE kind WHEN 3 THEN 'a_b_c.pdf' WHEN 5 THEN 'unnamed_attachment.png,note.txt' ELSE '' END AS names,
  CASE kind WHEN 3 THEN sha256(t) WHEN 5 THEN concat(sha256('png'), ',', sha256('note')) ELSE '' END AS hashes,
  CASE kind WHEN 3 THEN to_base64(encode(t)) WHEN 5 THEN 'cG5n,bm90ZQ==' ELSE '' END AS contents,
  CASE kind WHEN 3 THEN 'application/pdf' WHEN 5 THEN 'image/png,text/plain' ELSE '' END AS kinds, label, _parse_error
FROM (SELECT *, 'ham' AS label, CAST(NULL AS VARCHAR) AS _parse_error FROM ids)""")
    def eml_mime(spark, sf_dir):
        mails = spark.sql(MIME.replace("@b64@", "translate(base64(encode(t, 'UTF-8')), concat(chr(13), chr(10)), '')"), docs=table(spark, sf_dir, "documents"))
        parsed = parse_mails(mails.select(F.concat(F.lit("/mails/"), "og_fname").alias("path"), F.col("raw").cast("binary").alias("content")), label="ham")
        listed = [F.array_join(F.col(f"attachments.{field}"), ",").alias(name) for field, name in (("filename", "names"), ("hash", "hashes"), ("data_base64", "contents"), ("content_type", "kinds"))]
        return parsed.select("email_id", "og_fname", "header_list", "body", *listed, "label", "_parse_error")

    @register("url_ngrams", url_grams + " SELECT page_id, pos, gram FROM listed")
    def url_ngrams(spark, sf_dir):
        return _urls(spark, sf_dir).select("page_id", F.posexplode("grams").alias("pos", "gram")).withColumn("pos", F.col("pos").cast("long"))

    @register("url_vocab_topk", url_grams + _top(TOP_TERMS) + " SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS idx, term, tf FROM counted")
    def url_vocab_topk(spark, sf_dir):
        return N.vocabulary(_urls(spark, sf_dir), "grams", TOP_TERMS)

    @register("url_term_counts", url_grams + _top(TOP_TERMS) + " SELECT page_id, gram AS term, count(*) AS n FROM listed JOIN counted ON gram = term GROUP BY page_id, gram")
    def url_term_counts(spark, sf_dir):
        rows = _urls(spark, sf_dir)
        return N.term_counts(rows, "page_id", "grams", N.vocabulary(rows, "grams", TOP_TERMS))

    @register("url_wide_top", url_grams + _top(WIDE_TERMS) + """,
ranked AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM counted),
hits AS (SELECT page_id, idx, count(*) AS n FROM listed JOIN ranked ON gram = term GROUP BY page_id, idx)
SELECT p.page_id, """ + ", ".join(f"CAST(coalesce(sum(CASE WHEN idx = {i} THEN n END), 0) AS BIGINT) AS t{i}" for i in range(WIDE_TERMS)) + " FROM pages p LEFT JOIN hits h USING (page_id) GROUP BY p.page_id")
    def url_wide_top(spark, sf_dir):
        rows = _urls(spark, sf_dir)
        terms = [r.term for r in N.vocabulary(rows, "grams", WIDE_TERMS).orderBy("idx").collect()]
        return N.wide_counts(rows, "page_id", "grams", terms).toDF("page_id", *[f"t{i}" for i in range(len(terms))])

    @register("split_8020", "SELECT page_id, substr(md5(url), 1, 2) < '33' AS is_test FROM pages")
    def split_8020(spark, sf_dir):
        return table(spark, sf_dir, "pages").select("page_id", C.is_test(F.col("url")).alias("is_test"))

    @register("binary_metrics", f"""
WITH rows AS (SELECT label = 1 AS y, page_id % 3 = 0 AS p FROM ({fixtures.urls_sql()})),
sums AS (SELECT count(*) AS n, sum(CASE WHEN y = p THEN 1 ELSE 0 END) AS r, sum(CASE WHEN y AND p THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p THEN 1 ELSE 0 END) AS said, sum(CASE WHEN y THEN 1 ELSE 0 END) AS real FROM rows),
whole AS (SELECT n, CAST(r AS BIGINT) AS r, CAST(tp AS BIGINT) AS tp, CAST(said AS BIGINT) AS said, CAST(real AS BIGINT) AS real FROM sums)
SELECT n, ((r * 20000 + n) // (2 * n)) / 10000.0::DOUBLE AS accuracy, ((tp * 20000 + greatest(said, 1)) // (2 * greatest(said, 1))) / 10000.0::DOUBLE AS precision,
       ((tp * 20000 + greatest(real, 1)) // (2 * greatest(real, 1))) / 10000.0::DOUBLE AS recall,
       ((2 * tp * 20000 + greatest(said + real, 1)) // (2 * greatest(said + real, 1))) / 10000.0::DOUBLE AS f1 FROM whole""".replace("WITH rows AS", "WITH scored AS").replace("FROM rows)", "FROM scored)"))
    def binary_metrics(spark, sf_dir):
        return C.metrics(fixtures.urls(spark, sf_dir).withColumn("prediction", (F.pmod("page_id", F.lit(3)) == 0).cast("int")))

    @register("url_classifier")
    def url_classifier(spark, sf_dir):
        rows = _urls(spark, sf_dir).withColumn("test", C.is_test(F.col("url")))
        model = C.train(rows.where(~F.col("test")), size=1000)
        return model.transform(rows.where("test")).select("page_id", "label", F.col("prediction").cast("int").alias("prediction"))

    columns = [_typed(n, e) for g in BODY.values() for n, e in g.items()]
    body_all = f"SELECT email_id, {', '.join(columns)} FROM texts"
    heads = headers_sql(tuple(HEAD))
    wide = f"""
WITH filled_bodies AS (SELECT email_id, CASE WHEN regexp_matches(body, {quoted(f"[^{SPACE}]")}) THEN body ELSE '' END AS t FROM ({fixtures.emails_sql()})),
lowered AS (SELECT email_id, t, lower(t) AS l FROM filled_bodies),
texts AS (SELECT email_id, t, l, list_filter(regexp_split_to_array(l, {quoted(f"[{SPACE}]+")}), lambda w: w <> '') AS w FROM lowered),
bodies AS ({body_all}),
heads AS ({heads}),
found AS (SELECT email_id, count(*) AS url_count FROM ({URLS_PER_MAIL}) GROUP BY email_id)
SELECT * EXCLUDE (url_count), CAST(coalesce(url_count, 0) AS BIGINT) AS url_count FROM bodies JOIN heads USING (email_id) LEFT JOIN found USING (email_id)"""

    @register("pipeline_wide", wide)
    def pipeline_wide(spark, sf_dir):
        return wide_features(fixtures.emails(spark, sf_dir))

    @register("stream_features", wide)
    def stream_features(spark, sf_dir):
        base = scratch.folder(spark, "stream")
        fixtures.emails(spark, sf_dir).write.json(f"{base}/in")
        write_features(read_arriving(spark, f"{base}/in"), f"{base}/out", f"{base}/progress").awaitTermination()
        return spark.read.parquet(f"{base}/out")
