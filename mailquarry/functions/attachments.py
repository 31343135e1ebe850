"""Attachment names, hashes and base64, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that file names may not hold.
ILLEGAL = r'[/\\:*?"<>|]'


def safe_name(filename: Column, name: Column, extension: Column) -> Column:
    """The file name, else the name parameter, else a made-up one; illegal characters become underscores."""
    given = F.coalesce(F.when(filename != "", filename), F.when(name != "", name))
    made = F.concat(F.lit("unnamed_attachment"), F.coalesce(F.when(extension != "", extension), F.lit(".bin")))
    return F.regexp_replace(F.coalesce(given, made), ILLEGAL, "_")


def content_hash(data: Column) -> Column:
    """SHA-256 of the bytes, in hex."""
    return F.sha2(data, 256)


def encode(data: Column) -> Column:
    """Base64 without line breaks."""
    return F.regexp_replace(F.base64(data), "[\r\n]", "")


def decode(text: Column) -> Column:
    return F.unbase64(text)
