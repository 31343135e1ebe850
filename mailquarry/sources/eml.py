"""Raw mails to parsed mails: one distributed job over binary files or any (path, content) frame."""

from __future__ import annotations

import hashlib
import mimetypes
from base64 import b64encode
from collections.abc import Iterator
from email import policy
from email.message import EmailMessage
from email.parser import BytesParser
from functools import lru_cache

import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.functions.html import select_body
from mailquarry.operators.sample import contiguous
from mailquarry.sources import mailfiles
from mailquarry.sources.schema import ATTACHMENT

_ILLEGAL = str.maketrans(dict.fromkeys('/\\:*?"<>|', "_"))
#: Charset names that say nothing.
_NO_CHARSET = ("", "default", "unknown", "none")
#: Characters of a header whose reading is kept.
LONGEST_KEPT = 500
_JOB = f"email_id string, og_fname string, header_list string, raw_headers string, plain string, html string, attachments array<{ATTACHMENT}>, _parse_error string"

_files = pa.list_(pa.struct([(n, pa.string()) for n in ("filename", "content_type", "hash", "data_base64")]))
_ARROW = pa.schema([(n, _files if n == "attachments" else pa.string()) for n in ("email_id", "og_fname", "header_list", "raw_headers", "plain", "html", "attachments", "_parse_error")])


def read_binary(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """Files by Spark's own binary source, for stores that only the JVM reaches: path, modificationTime, length, content. It leaves out files without a byte."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(paths)


@lru_cache(maxsize=4096)
def _header(name: str, value: str):
    """A header as the library reads it; its values never change, so mails that share one share the reading."""
    return policy.SMTP.header_fetch_parse(name, value)


class Remembering(policy.EmailPolicy):
    """The policy SMTP, which reads a header anew at each question about it, with the last headers' readings kept; long ones, few of which recur, are not."""

    def header_fetch_parse(self, name, value):
        return _header(name, value) if type(value) is str and len(value) <= LONGEST_KEPT else super().header_fetch_parse(name, value)


SMTP = Remembering(linesep="\r\n")


def decoded(part: EmailMessage) -> str:
    """A text part's content under its charset, or the first of the usual ones that exists; undecodable bytes are replaced."""
    try:
        return part.get_content()
    except (KeyError, AttributeError, LookupError, UnicodeDecodeError):
        data = part.get_payload(decode=True)
    if data is None:
        return str(part.get_payload() or "")
    named = (part.get_content_charset() or "").lower()
    for charset in (*([] if named in _NO_CHARSET else [named]), "utf-8", "latin-1"):
        try:
            return data.decode(charset, errors="replace")
        except LookupError:
            continue
    return ""


def text_parts(message: EmailMessage) -> tuple[str, str]:
    """The plain and the html text. Of several parts, all that are no attachments are joined; a lone text part of another kind counts as plain."""
    found = {"text/plain": "", "text/html": ""}
    if not message.is_multipart():
        kind = message.get_content_type()
        if message.get_content_maintype() == "text":
            found[kind if kind == "text/html" else "text/plain"] = decoded(message)
        return found["text/plain"], found["text/html"]
    for part in message.walk():
        if part.get_content_type() in found and part.get_content_disposition() != "attachment":
            found[part.get_content_type()] += decoded(part)
    return found["text/plain"], found["text/html"]


def attachments(message: EmailMessage) -> list[dict[str, str]]:
    """Attached and inline parts; one that cannot be decoded is left out and the mail kept."""
    found = []
    for part in message.walk():
        if part.get_content_maintype() == "multipart" or part.get_content_disposition() not in ("attachment", "inline"):
            continue
        kind = part.get_content_type()
        name = part.get_filename() or part.get_param("name") or f"unnamed_attachment{mimetypes.guess_extension(kind) or '.bin'}"
        try:
            data = part.get_payload(decode=True)
        except Exception:  # whatever a broken encoding raises
            continue
        if data is not None:
            found.append({"filename": str(name).translate(_ILLEGAL), "content_type": kind, "hash": hashlib.sha256(data).hexdigest(), "data_base64": b64encode(data).decode()})
    return found


def header_block(raw: bytes) -> str:
    """What stands before the first blank line, CRLF first, as UTF-8 with replacements."""
    for blank in (b"\r\n\r\n", b"\n\n"):
        if blank in raw:
            raw = raw.partition(blank)[0]
            break
    return raw.decode("utf-8", errors="replace")


def mail_id(path: str, raw: bytes) -> str:
    """An id in the form of a UUID that a rerun gives again."""
    h = hashlib.sha256(path.encode() + raw).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"


def _parsed(path: str, raw: bytes, failfast: bool) -> dict:
    row = {"email_id": mail_id(path, raw), "og_fname": path.rsplit("/", 1)[-1], "raw_headers": header_block(raw), "attachments": []}
    try:
        message = BytesParser(policy=SMTP).parsebytes(raw)
        row["header_list"] = ",".join(message.keys())
        row["plain"], row["html"] = text_parts(message)
        row["attachments"] = attachments(message)
    except Exception as e:
        if failfast:
            raise
        row["_parse_error"] = f"{type(e).__name__}: {e}"[:500]
    return row


def parse_mails(files: DataFrame, label: str | None = None, failfast: bool = False) -> DataFrame:
    """Parsed mails from (path, content), in the columns of ``schema.PARSED``.

    A mail that cannot be parsed keeps its row, with the reason in _parse_error; failfast stops the run instead.
    The standard library reads the MIME structure, a few mails of a batch at a time; everything else is done in columns. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in mailfiles.slices(batch):
                rows = [_parsed(p, c or b"", failfast) for p, c in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    rows = files.select("path", "content").mapInArrow(run, _JOB)
    return rows.select(
        "email_id",
        F.coalesce("header_list", F.lit("")).alias("header_list"),
        "raw_headers",
        select_body(F.col("plain"), F.col("html")).alias("body"),
        "og_fname",
        "attachments",
        F.lit(label).cast("string").alias("label"),
        "_parse_error",
    )


def ingest(spark: SparkSession, paths: str | list[str], glob: str | None = None, label: str | None = None, failfast: bool = False, binary: bool = False) -> DataFrame:
    """Parsed mails of all files at or below the paths, empty files too; ``binary`` reads by Spark's binary source instead."""
    files = read_binary(spark, paths, glob) if binary else mailfiles.read_files(spark, paths, glob)
    return parse_mails(files, label, failfast)


def ingest_sample(spark: SparkSession, paths: str | list[str], n: int, seed: int, folder: str, glob: str | None = None, label: str | None = None, opened_files: Accumulator | None = None) -> DataFrame:
    """Parsed mails of ``n`` files that follow each other by path, from a seeded random start.

    The paths are ranked first, over a listing that is written under ``folder``; only the sample's files are opened. ``opened_files`` counts them.
    """
    mailfiles.read_files(spark, paths, glob, content=False).drop("content").write.parquet(f"{folder}/listing")
    listing = spark.read.parquet(f"{folder}/listing")
    return parse_mails(mailfiles.contents(contiguous(listing, "path", n, seed, folder), opened_files=opened_files), label)
