"""Queries that write files to the shared folder and read them back: mails, samples of a listing, arriving mails, attachments, JSON lines, CSV, models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.functions import urls
from mailquarry.operators import attachments as AO
from mailquarry.operators import classifier as C
from mailquarry.operators import convert, sample
from mailquarry.plans import fixtures, scratch
from mailquarry.plans.mail_sql import URL_WORDLIST
from mailquarry.plans.other_queries import MIME, html_sql, strip_sql, url_grams
from mailquarry.sources import eml, files, mailfiles
from mailquarry.streaming.features import read_arriving_files, write_parsed

SAMPLE_SEED, SAMPLE_FILES = 5, 40
#: Documents of this remainder, of 11, make empty files where empty files are read.
EMPTY = 4
_SPARK_B64 = "translate(base64(encode(t, 'UTF-8')), concat(chr(13), chr(10)), '')"

#: What parsing gives of each mail of MIME, ids apart: they depend on the folder.
PARSED = f"""
SELECT doc_no, og_fname, concat('From,Subject,MIME-Version,Content-Type', CASE WHEN kind IN (0, 4, 6) THEN ',Content-Transfer-Encoding' ELSE '' END) AS header_list,
  CASE WHEN plain <> '' THEN {strip_sql('plain')} ELSE {html_sql('html')} END AS body,
  CASE kind WHEN 3 THEN 'a_b_c.pdf' WHEN 5 THEN 'unnamed_attachment.png,note.txt' ELSE '' END AS names,
  CASE kind WHEN 3 THEN sha256(t) WHEN 5 THEN concat(sha256('png'), ',', sha256('note')) ELSE '' END AS hashes
FROM (SELECT *, CAST(regexp_extract(og_fname, '[0-9]+') AS BIGINT) AS doc_no FROM ({MIME.replace('@b64@', 'to_base64(encode(t))').format(docs='documents')}))"""
_fields = ("header_list", "body", "names", "hashes")
INGEST = f"SELECT og_fname, {', '.join(f"CASE WHEN doc_no % 11 = {EMPTY} THEN '' ELSE {c} END AS {c}" for c in _fields)} FROM ({PARSED})"
SAMPLE = f"""
SELECT og_fname, {', '.join(_fields)} FROM (SELECT *, row_number() OVER (ORDER BY og_fname) - 1 AS row_no, count(*) OVER () AS total FROM ({PARSED}))
WHERE row_no - CAST(floor({sample.start_share(SAMPLE_SEED)!r} * (total - {SAMPLE_FILES} + 1)) AS BIGINT) BETWEEN 0 AND {SAMPLE_FILES - 1}"""
ARRIVING = f"SELECT og_fname, {', '.join(_fields)} FROM ({PARSED})"
REBUILT = f"""
WITH files AS (
  SELECT og_fname, unnest(CASE kind WHEN 3 THEN ['a_b_c.pdf'] WHEN 5 THEN ['unnamed_attachment.png', 'note.txt'] ELSE [] END) AS name, kind, t
  FROM ({MIME.replace('@b64@', 'to_base64(encode(t))').format(docs='documents')}))
SELECT og_fname, name, CASE kind WHEN 3 THEN octet_length(encode(t)) ELSE CASE name WHEN 'note.txt' THEN 4 ELSE 3 END END AS n_bytes,
       sha256(CASE kind WHEN 3 THEN t ELSE CASE name WHEN 'note.txt' THEN 'note' ELSE 'png' END END) AS hash FROM files"""

#: Objects with keys of any characters, and what is no object: a list, a broken one, none.
ODD = """
SELECT event_id, CASE event_id % 7
  WHEN 0 THEN concat('{{"a.b":', event_id, ',"it', chr(39), 's":"x"}}')
  WHEN 1 THEN concat('{{"[x]":[1,{{"k":null}}],"a.b":"t', event_id, '"}}')
  WHEN 2 THEN concat('{{"q', chr(92), '"q":true,"$":null,"":"empty"}}')
  WHEN 3 THEN concat('{{"a":{{"b.c":', event_id, '}},"$[0]":"path"}}')
  WHEN 4 THEN '[1,2]' WHEN 5 THEN concat('{{"a":', event_id) ELSE NULL END AS props FROM {events}"""
#: Pointers of the keys in JSON, by the columns' order.
ODD_KEYS = {"": "/", "$": "/$", "$[0]": "/$[0]", "[x]": "/[x]", "a": "/a", "a.b": "/a.b", "it's": "/it''s", 'q"q': '/q"q'}
ODD_SQL = "SELECT event_id, " + ", ".join(f"CASE WHEN event_id % 7 < 4 THEN json_extract_string(props, '{pointer}') END AS {chr(34)}c{k}{chr(34)}" for k, pointer in enumerate(ODD_KEYS.values()))
ODD_SQL += f", CASE WHEN event_id % 7 IN (4, 5) THEN props END AS corrupt FROM ({ODD.format(events='events')})"
#: The largest slope that counts as an optimum.
LEAST_SLOPE = 1e-5


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """og_fname, raw, doc_no of the mails of MIME, one per document, over the session's cores."""
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    cores = spark.sparkContext.defaultParallelism
    docs = docs.repartition(2 * cores) if len(docs.inputFiles()) < cores else docs
    rows = spark.sql(MIME.replace("@b64@", _SPARK_B64), docs=docs)
    return rows.select("og_fname", "raw", F.regexp_extract("og_fname", "[0-9]+", 0).cast("long").alias("doc_no"))


def written(spark: SparkSession, rows: DataFrame, base: str, key: Column, content: Column) -> str:
    """The mails as files below ``base``/mails."""
    mailfiles.write_files(rows.select(key.alias("key"), content.alias("content")), f"{base}/mails", base)
    return f"{base}/mails"


def shown(parsed: DataFrame) -> DataFrame:
    listed = [F.array_join(F.col(f"attachments.{field}"), ",").alias(name) for field, name in (("filename", "names"), ("hash", "hashes"))]
    return parsed.select("og_fname", "header_list", "body", *listed)


def register_all(register) -> None:
    """Add every query of this module."""

    @register("eml_ingest", INGEST)
    def eml_ingest(spark, sf_dir):
        """Mail files in nested folders, some of them empty."""
        rows = mails(spark, sf_dir)
        key = F.concat_ws("/", F.concat(F.lit("kind"), F.pmod("doc_no", F.lit(7))), F.concat(F.lit("deep"), F.pmod("doc_no", F.lit(13))), "og_fname")
        content = F.when(F.pmod("doc_no", F.lit(11)) == EMPTY, "").otherwise(F.col("raw"))
        return shown(eml.ingest(spark, written(spark, rows, scratch.folder(spark, "ingest"), key, content), glob="*.eml"))

    @register("eml_sample", SAMPLE)
    def eml_sample(spark, sf_dir):
        """Files that follow each other by path; only these are opened."""
        base = scratch.folder(spark, "sampled")
        target = written(spark, mails(spark, sf_dir), base, F.col("og_fname"), F.col("raw"))
        return shown(eml.ingest_sample(spark, target, SAMPLE_FILES, SAMPLE_SEED, base))

    @register("eml_stream", ARRIVING)
    def eml_stream(spark, sf_dir):
        """Mail files that arrive in two portions; the stream is started anew for the second."""
        base = scratch.folder(spark, "arriving")
        rows = mails(spark, sf_dir)
        for part in (0, 1):
            written(spark, rows.where(F.pmod("doc_no", F.lit(2)) == part), base, F.concat_ws("/", F.pmod("doc_no", F.lit(3)), "og_fname"), F.col("raw"))
            write_parsed(shown(read_arriving_files(spark, f"{base}/mails", glob="*.eml", staging=base)), f"{base}/parsed", f"{base}/progress").awaitTermination()
        return spark.read.parquet(f"{base}/parsed")

    @register("attachment_rebuild", REBUILT)
    def attachment_rebuild(spark, sf_dir):
        """Attachments of parsed mails, written as files and read back."""
        base = scratch.folder(spark, "rebuilt")
        rows = mails(spark, sf_dir).select(F.concat(F.lit("/mails/"), "og_fname").alias("path"), F.col("raw").cast("binary").alias("content"))
        parsed = eml.parse_mails(rows).withColumn("email_id", F.col("og_fname"))
        AO.rebuild(parsed, f"{base}/files", base)
        parts = F.split("path", "/")
        found = mailfiles.read_files(spark, f"{base}/files")
        return found.select(F.get(parts, F.size(parts) - 2).alias("og_fname"), F.get(parts, F.size(parts) - 1).alias("name"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("hash"))

    @register("jsonl_odd_keys", ODD_SQL)
    def jsonl_odd_keys(spark, sf_dir):
        """Keys with quotes, dots, brackets and dollar signs, and rows that are no objects."""
        rows = spark.sql(ODD, events=fixtures.table(spark, sf_dir, "events"))
        wide = convert.json_union(rows, "props", keep=("event_id",), corrupt="corrupt")
        assert wide.columns == ["event_id", *ODD_KEYS, "corrupt"]
        return wide.toDF("event_id", *[f"c{k}" for k in range(len(ODD_KEYS))], "corrupt")

    @register("jsonl_round_trip", f"SELECT email_id, raw_headers, body, og_fname, label, CASE WHEN CAST(email_id AS BIGINT) % 10 = 0 THEN 2 ELSE 1 END AS times, CAST(0 AS BIGINT) AS corrupt FROM ({fixtures.emails_sql()})")
    def jsonl_round_trip(spark, sf_dir):
        """Mails to JSON lines, a tenth of them appended again, and back by the fixed schema."""
        base = scratch.folder(spark, "lines")
        rows = fixtures.emails(spark, sf_dir)
        files.write_json(rows, f"{base}/mails")
        files.write_json(rows.where("CAST(email_id AS BIGINT) % 10 = 0"), f"{base}/mails")
        back = files.read_parsed(spark, f"{base}/mails", corrupt="corrupt")
        same = back.groupBy("email_id", "raw_headers", "body", "og_fname", "label").agg(F.count("*").cast("int").alias("times"), F.count("corrupt").alias("corrupt"))
        return same

    @register("csv_round_trip", "SELECT CAST(page_id AS VARCHAR) AS page_id, url, html FROM pages")
    def csv_round_trip(spark, sf_dir):
        """Pages as JSON lines, these as CSV, and chosen columns back; the markup has quotes, commas and line breaks."""
        base = scratch.folder(spark, "csv")
        files.write_json(fixtures.table(spark, sf_dir, "pages").withColumn("extra", F.array(F.lit(1), F.lit(2))), f"{base}/lines")
        convert.jsonl_to_csv(spark, f"{base}/lines", f"{base}/csv")
        return files.read_csv(spark, f"{base}/csv", ["page_id", "url", "html"])

    @register("wordlist_round_trip", URL_WORDLIST)
    def wordlist_round_trip(spark, sf_dir):
        """The URL list as a text file of one URL a line, and back."""
        base = scratch.folder(spark, "words")
        files.write_wordlist(urls.url_wordlist(fixtures.emails(spark, sf_dir)), f"{base}/urls")
        return spark.read.text(f"{base}/urls").withColumnRenamed("value", "url")

    train_rows = "SELECT page_id, label, substr(md5(url), 1, 2) < '33' AS is_test FROM (" + fixtures.urls_sql() + ")"

    @register("url_classifier_optimum", f"""
{url_grams}, training AS (SELECT page_id FROM ({train_rows}) WHERE NOT is_test)
SELECT (SELECT count(*) FROM training) AS n_rows, least(1000, (SELECT count(DISTINCT gram) FROM listed SEMI JOIN training USING (page_id))) + 1 AS n_weights, true AS optimal""")
    def url_classifier_optimum(spark, sf_dir):
        """Whether the fitted weights are an optimum: no slope of the penalised loss is over LEAST_SLOPE."""
        rows = C.with_grams(fixtures.urls(spark, sf_dir)).where(~C.is_test(F.col("url")))
        base = scratch.folder(spark, "train")
        rows.write.parquet(base)
        rows = spark.read.parquet(base)
        model = C.train(rows, size=1000, rounds=1000, tolerance=1e-12)
        slopes = C.gradient(model, rows, "page_id").agg(F.max(F.abs("gradient")).alias("steepest"), F.count("gradient").alias("n_weights"))
        return slopes.select(F.lit(rows.count()).alias("n_rows"), "n_weights", (F.col("steepest") <= LEAST_SLOPE).alias("optimal"))

    @register("url_classifier_reload", f"SELECT page_id, CAST(label AS INTEGER) AS label, true AS alike FROM ({train_rows}) WHERE is_test")
    def url_classifier_reload(spark, sf_dir):
        """A model saved and loaded again scores every test row alike."""
        rows = C.with_grams(fixtures.urls(spark, sf_dir)).withColumn("test", C.is_test(F.col("url")))
        model = C.train(rows.where(~F.col("test")), size=1000)
        base = scratch.folder(spark, "models")
        again = C.load(base, "u1") if C.save(model, base, "u1") else model
        scored = model.transform(rows.where("test")).withColumnsRenamed({"probability": "p_before", "prediction": "before"}).drop("features", "rawPrediction")
        both = again.transform(scored)
        alike = (F.col("before") == F.col("prediction")) & (vector_to_array("p_before")[1] == vector_to_array("probability")[1])
        return both.select("page_id", F.col("label").cast("int").alias("label"), alike.alias("alike"))
