"""E-mail views over the driver's tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Bodies open with one of these, by document number; `~` is a line break.
PHRASES = (
    "URGENT: act now, your offer expires within 24 hours! Hurry!! Final notice.",
    "We need this within 3 days. In the next 12 hours decide. 5 days to go, before 10:30.",
    "We are from the security team. Official notice on behalf of an authorized agent: verify your identity at paypal.com.",
    "Your account will be suspended and may be deleted. You lose access. Unable to log in. Legal action, court, police.",
    "Click here to reset password. Enter your credit card and routing number, social security, date of birth. Fill out the form.",
    "you you must reply. Dear customer,  hi bob     hello there the the end. you, and you. your yours you're you've you'll",
    "<html><body><p class=x>Hello <b>world</b></p></body></html> < not a tag",
    "Dear valued customer, greetings. I am here and I have my name.",
    "I won $1,000,000.00 and 5 million dollars, 20 EUR and 3 USD, 7.50 GBP. You have won the lottery prize!",
    "Visit https://www.example.org/a?b=c, or http://sub.example.com/x). See https://example.net.",
    "see example.com/path, and sub.domain.co.uk. mail bob@example.com or www.site.org/a) www.local www.two.words.io!",
    "We at our firm think we're and we've and we'll help us now. ~~~  ~ Next paragraph. ~~Third one!",
    "Congratulations, claim your refund, wire transfer the payment and invoice. You are selected.",
    "Hi. No. OK. This is a sentence of more words? Yes!",
    "Plain opening with no feature at all in it",
    "ALL CAPS HERE AND lower there. Password and PIN and CVV. http and www. and x@y.z",
)
#: Documents of these remainders have a blank body, and none.
BLANK, MISSING = len(PHRASES), len(PHRASES) + 1
MODULUS = len(PHRASES) + 2


def emails_sql(documents: str = "documents", labels: str = "labels") -> str:
    """email_id, body, raw_headers, og_fname, label: a mail per document."""
    rows = ", ".join("({}, '{}')".format(k, p.replace("'", "''")) for k, p in enumerate(PHRASES))
    return f"""
SELECT CAST(d.doc_id AS STRING) AS email_id,
       CASE WHEN d.doc_id % {MODULUS} = {BLANK} THEN concat(' ', chr(10), chr(9)) WHEN d.doc_id % {MODULUS} = {MISSING} THEN NULL
            ELSE concat(replace(p.phrase, '~', chr(10)), chr(10), chr(10), d.text) END AS body,
       concat_ws(concat(chr(13), chr(10)),
         CASE d.doc_id % 8
           WHEN 0 THEN concat('From: Alice Smith <alice', d.doc_id, '@example.com>') WHEN 1 THEN 'From: bob@gmail.com'
           WHEN 2 THEN 'FROM: "carol@example.org" <carol@example.org>' WHEN 3 THEN 'From: =?UTF-8?B?QWJj?= <dave@yahoo.com>'
           WHEN 4 THEN concat('From: J', chr(252), 'rgen <j99@example.net>') WHEN 5 THEN 'From: "Eve" <eve@hotmail.com>'
           WHEN 6 THEN NULL ELSE 'from: <frank@Example.COM>' END,
         CASE d.doc_id % 4 WHEN 0 THEN 'Return-Path: <bounce@example.com>' WHEN 1 THEN 'Return-Path: <x@other.org>' WHEN 2 THEN NULL ELSE 'Return-Path: frank@example.com' END,
         CASE d.doc_id % 5 WHEN 0 THEN 'Reply-To: Help <help@example.info>' WHEN 1 THEN 'Reply-To: BOB@gmail.com' END,
         CASE WHEN d.doc_id % 3 = 0 THEN 'DKIM-Signature: v=1; a=rsa-sha256; d=example.com' END,
         CASE d.doc_id % 3 WHEN 0 THEN 'Authentication-Results: mx.example.com; SPF=pass' WHEN 1 THEN 'Authentication-Results: mx.example.com; dkim=none' END,
         CASE WHEN d.doc_id % 6 <> 0 THEN concat('Message-ID: <', d.doc_id, '@mx.example.com>') END,
         CASE WHEN d.doc_id % 7 = 0 THEN 'x-mailer: Mailer 1.0' END,
         CASE d.doc_id % 3 WHEN 0 THEN 'Content-Type: text/plain' WHEN 1 THEN 'Content-Type: multipart/mixed; boundary=a; charset=utf-8' ELSE 'Content-Type: a;b;c;d;e;f;g;h;i;j;k;l;m' END,
         CASE d.doc_id % 4 WHEN 0 THEN 'Content-Transfer-Encoding: BASE64' WHEN 1 THEN 'Content-Transfer-Encoding: quoted-printable' WHEN 2 THEN 'Content-Transfer-Encoding: 8bit' END,
         CASE d.doc_id % 9
           WHEN 0 THEN 'Date: Mon, 06 Jan 2025 09:15:00 +0100' WHEN 1 THEN 'Date: Tue, 07 Jan 2025 07:59:59 -0500' WHEN 2 THEN 'Date: Sat, 11 Jan 2025 12:00:00 +0000'
           WHEN 3 THEN 'Date: Wed, 08 Jan 2025 18:00:00 -0000' WHEN 4 THEN 'Date: Thu, 09 Jan 2025 17:59:59 +1500' WHEN 5 THEN 'Date: yesterday'
           WHEN 6 THEN NULL WHEN 7 THEN 'Date: Fri, 32 Jan 2025 10:00:00 +0000' ELSE 'Date: Sun, 12 Jan 2025 08:00:00 +0530' END,
         CASE d.doc_id % 3 WHEN 0 THEN 'Subject: Hello' WHEN 1 THEN 'Subject: =?utf-8?q?Hi?=' ELSE concat('Subject: Caf', chr(233)) END,
         CASE WHEN d.doc_id % 5 >= 1 THEN 'Received: from a (10.0.0.1) by b' END,
         CASE WHEN d.doc_id % 5 >= 2 THEN concat('Received: from c ([192.168.1.', d.doc_id % 200, '] helo 8.8.8.8)') END,
         CASE WHEN d.doc_id % 5 >= 3 THEN concat('Received: from d', chr(13), chr(10), chr(9), 'by 172.16.5.4; x') END,
         CASE WHEN d.doc_id % 5 = 4 THEN 'Received: from a (10.0.0.1) by e' WHEN d.doc_id % 10 = 0 THEN 'Received: by 127.0.0.1' END) AS raw_headers,
       concat('mail_', d.doc_id, '.eml') AS og_fname,
       CAST(l.toxic AS STRING) AS label
FROM {documents} d JOIN (SELECT * FROM (VALUES {rows}, ({BLANK}, ''), ({MISSING}, '')) AS t(k, phrase)) p ON d.doc_id % {MODULUS} = p.k
LEFT JOIN {labels} l ON d.doc_id = l.doc_id"""


def urls_sql(pages: str = "pages") -> str:
    """page_id, url, label: hosts of some kinds are the positive class."""
    return f"""
SELECT page_id, url, CASE WHEN url LIKE '%free-bets%' OR url LIKE '%adult-%' OR url LIKE '%ads-track%' THEN 1 ELSE 0 END AS label FROM {pages}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mails of ``emails_sql``. Few input files are spread over the session's cores before the work per text; many are read as they lie."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cores = spark.sparkContext.defaultParallelism
    docs = docs.repartition(2 * cores) if len(docs.inputFiles()) < cores else docs
    return spark.sql(emails_sql("{docs}", "{labels}"), docs=docs, labels=table(spark, sf_dir, "labels"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled URLs of ``urls_sql``."""
    return spark.sql(urls_sql("{pages}"), pages=table(spark, sf_dir, "pages"))
