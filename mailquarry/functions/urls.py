"""URLs in mail bodies: three kinds, cleaned and in order, per mail and over all mails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailquarry.functions.text import SPACE, strip

# What a host, a path and a known top-level domain are.
HOST = r"[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
PATH = r"""[/?#][^\s<>"{}|\\^`\[\]]*"""
TOP_LEVEL = (
    "com", "org", "net", "edu", "gov", "mil", "co", "io", "ai", "app", "dev", "tech", "info", "biz", "name", "pro", "xyz", "online", "site",
    "website", "store", "shop", "blog", "news", "media", "tv", "me", "us", "uk", "ca", "au", "de", "fr", "jp", "cn", "in", "br", "ru", "it", "es",
    "nl", "se", "no", "dk", "fi", "pl", "be", "ch", "at", "cz", "gr", "pt", "ie", "nz", "sg", "hk", "kr", "tw", "th", "my", "id", "ph", "vn", "za",
    "ae", "il", "tr", "mx", "ar", "cl",
)
TRAILING = r"[.,;!?)\]]+\z"

_PATH = PATH.replace(r"\s", SPACE)
#: Bare and www. forms begin after white space or a line's start and end before white space, a line's end or a closing mark.
#: What a form needs at least is looked for before the rest of it, so that most words are left at their first characters.
_BEGIN, _END = rf"(?:(?<=[{SPACE}])|^)", rf"(?=[{SPACE}]|$|[,;!?)])"
HTTP = rf"https?://(?:{HOST}\.)+[a-zA-Z]{{2,}}(?:{_PATH})?"
BARE = rf"{_BEGIN}(?=[a-zA-Z0-9-]++\.)(?![\w.-]*@)(?:{HOST}\.)+(?:{'|'.join(TOP_LEVEL)})(?:{_PATH})?{_END}"
WWW = rf"(?=www\.){_BEGIN}www\.(?:{HOST}\.)*{HOST}(?:{_PATH})?{_END}"


def _all(text: Column, pattern: str, flags: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?{flags}){pattern}"), F.lit(0))


def http_urls(text: Column) -> Column:
    """Explicit http and https URLs."""
    return _all(text, HTTP, "iuU")


def bare_urls(text: Column) -> Column:
    """Domains under known top-level domains without a scheme; not those of addresses."""
    return _all(text, BARE, "idmuU")


def www_urls(text: Column) -> Column:
    """Hosts that start with www."""
    return _all(text, WWW, "idmuU")


def extract_urls(text: Column) -> Column:
    """All URLs of a text in order of kind, without trailing marks, each once."""
    found = F.concat(http_urls(text), bare_urls(text), www_urls(text))
    clean = F.transform(found, lambda u: F.regexp_replace(strip(u), TRAILING, ""))
    return F.array_distinct(F.filter(clean, lambda u: u != ""))


def url_table(mails: DataFrame, body: str = "body", key: str = "email_id") -> DataFrame:
    """(key, pos, url): a row per URL of a mail; mails without URLs have none."""
    return mails.select(key, F.posexplode(extract_urls(F.col(body))).alias("pos", "url")).withColumn("pos", F.col("pos").cast("long"))


def url_wordlist(mails: DataFrame, body: str = "body") -> DataFrame:
    """The distinct URLs of all mails; the shuffle carries each task's distinct URLs only."""
    return mails.select(F.explode(extract_urls(F.col(body))).alias("url")).distinct()
