"""Header features: 27 columns from a raw header block."""

from __future__ import annotations

from datetime import datetime
from email.utils import parseaddr, parsedate_tz

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.functions import rfc
from mailquarry.functions.text import count_char, matches

# Fixed values.
FREE_PROVIDERS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com", "mail.com", "protonmail.com", "yandex.com", "zoho.com", "gmx.com")
RELAY_IP = r"\[?(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\]?"
PRIVATE_IP = r"^(127\.|10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)"
OFFICE_HOURS = (8, 18)
MOST_SEMICOLONS = 10
LARGEST_OFFSET = 50_400



def header_table(raw: Column) -> Column:
    """The headers in order as (name, value); folded lines belong to the header before, and what is no header ends the list."""
    lines = F.split(F.coalesce(raw, F.lit("")), r"(?>\r\n|\r|\n)(?![ \t])")
    is_header = F.transform(lines, lambda x: F.rlike(x, F.lit("^[!-9;-~]+:")))
    end = F.array_position(is_header, F.lit(False))
    heads = F.slice(lines, F.lit(1), F.when(end == 0, F.size(lines)).otherwise(end - 1).cast("int"))
    name = lambda x: F.substring_index(x, ":", 1)
    value = lambda x: F.regexp_replace(x, r"\A[^:]*:[ \t]*", "")
    return F.transform(heads, lambda x: F.struct(name(x).alias("name"), value(x).alias("value")))


def header_values(headers: Column, name: str) -> Column:
    """All values of a header, whatever the case of its name."""
    return F.transform(F.filter(headers, lambda h: F.lower(h["name"]) == name.lower()), lambda h: h["value"])


def header_value(headers: Column, name: str) -> Column:
    """The first value of a header, empty if it is absent."""
    return F.coalesce(F.get(header_values(headers, name), F.lit(0)), F.lit(""))


def has_header(headers: Column, name: str) -> Column:
    return F.exists(headers, lambda h: F.lower(h["name"]) == name.lower())


def header_list(headers: Column) -> Column:
    """The names, in order, joined by commas."""
    return F.array_join(F.transform(headers, lambda h: h["name"]), ",")


@F.pandas_udf(rfc.PARTS)
def rfc_parts(sender: pd.Series, reply_to: pd.Series, date: pd.Series) -> pd.DataFrame:
    """What the mail standards' own parser reads: addresses and dates. Weekday -1 means no valid date."""

    def when(value: str) -> tuple[int, int, int]:
        try:
            parts = parsedate_tz(value)
            moment = datetime(*parts[:6])
            return moment.weekday(), moment.hour, parts[9] or 0
        except Exception:  # whatever a malformed date raises
            return -1, 0, 0

    rows = [(*parseaddr(s), parseaddr(r)[1], *when(d)) for s, r, d in zip(sender, reply_to, date, strict=True)]
    return pd.DataFrame(rows, columns=rfc.PARTS.names)


def _domain(address: Column) -> Column:
    return F.when(F.contains(address, F.lit("@")), F.lower(F.substring_index(address, "@", -1))).otherwise(F.lit(""))


def _foreign(text: Column) -> Column:
    return (F.contains(text, F.lit("=?")) & F.contains(text, F.lit("?="))) | F.rlike(text, F.lit(r"[^\x00-\x7F]"))


def authenticity(h: Column, rfc: Column) -> dict[str, Column]:
    results = header_value(h, "Authentication-Results")
    sender, returned = _domain(rfc["address"]), _domain(F.regexp_replace(header_value(h, "Return-Path"), r"\A[<>]+|[<>]+\z", ""))
    return {
        "has_dkim": has_header(h, "DKIM-Signature"),
        "has_spf": F.contains(F.lower(results), F.lit("spf=")),
        "from_return_mismatch": (sender != "") & (returned != "") & (sender != returned),
        "has_auth_results": results != "",
    }


def sender(h: Column, rfc: Column) -> dict[str, Column]:
    address, display = rfc["address"], rfc["display"]
    blank = F.trim(display) == ""
    return {
        "from_free_provider": _domain(address).isin(*FREE_PROVIDERS),
        "from_has_numbers": matches(F.substring_index(address, "@", 1), r"\d"),
        "display_name_empty": blank,
        "display_name_is_email": (display != "") & (F.trim(F.lower(display)) == F.trim(F.lower(address))),
        "reply_to_differs": (rfc["reply"] != "") & (F.lower(rfc["reply"]) != F.lower(address)),
    }


def structural(h: Column, rfc: Column) -> dict[str, Column]:
    return {
        "missing_message_id": ~has_header(h, "Message-ID"),
        "has_x_mailer": has_header(h, "X-Mailer"),
        "content_type_complexity": count_char(header_value(h, "Content-Type"), ";"),
    }


def temporal(h: Column, rfc: Column) -> dict[str, Column]:
    return {
        "sent_business_hours": rfc["weekday"].between(0, 4) & (rfc["hour"] >= OFFICE_HOURS[0]) & (rfc["hour"] < OFFICE_HOURS[1]),
        "timezone_offset": rfc["tz"].cast("long"),
        "day_of_week": rfc["weekday"].cast("long"),
    }


def encoding(h: Column, rfc: Column) -> dict[str, Column]:
    transfer = F.lower(header_value(h, "Content-Transfer-Encoding"))
    return {
        "uses_base64": F.contains(transfer, F.lit("base64")),
        "uses_quoted_printable": F.contains(transfer, F.lit("quoted-printable")),
        "unicode_in_from": _foreign(header_value(h, "From")),
        "unicode_in_subject": _foreign(header_value(h, "Subject")),
    }


def received(h: Column, rfc: Column) -> dict[str, Column]:
    hops = header_values(h, "Received")
    addresses = F.flatten(F.transform(hops, lambda x: F.regexp_extract_all(x, F.lit("(?U)" + RELAY_IP), F.lit(1))))
    n_hops, n_unique = F.size(hops), F.size(F.array_distinct(addresses))
    return {
        "received_count": n_hops.cast("long"),
        "unique_relay_ips": n_unique.cast("long"),
        "all_private_ips": (F.size(addresses) > 0) & F.forall(addresses, lambda a: F.rlike(a, F.lit(PRIVATE_IP))),
        "ip_diversity_ratio": F.when(n_hops == 0, F.lit(0.0)).otherwise(n_unique / F.greatest(n_hops, F.lit(1))),
    }


def quality(h: Column, rfc: Column) -> dict[str, Column]:
    valid = rfc["weekday"] != -1
    extreme = structural(h, rfc)["content_type_complexity"] > MOST_SEMICOLONS
    unusual = F.abs(rfc["tz"]) > LARGEST_OFFSET
    score = valid.cast("long") + (~extreme).cast("long") + (~unusual).cast("long")
    return {"has_valid_date": valid, "has_extreme_complexity": extreme, "has_unusual_timezone": unusual, "data_quality_score": score}


GROUPS = {
    "authenticity": authenticity,
    "sender": sender,
    "structural": structural,
    "temporal": temporal,
    "encoding": encoding,
    "received": received,
    "quality": quality,
}
#: Groups that need no address or date, and so no Python.
NATIVE = ("structural", "encoding", "received")


def header_features(df: DataFrame, raw: str = "raw_headers", key: str = "email_id", groups: tuple[str, ...] = tuple(GROUPS), one_pass: bool = False) -> DataFrame:
    """(key, features): a row per mail, on tables and streams alike. Absent headers count as empty.

    Addresses and dates of the usual forms are read by column expressions. Mails with others go through the standard library's
    parser: in a branch of their own, which has no task at run time if there are none, so that regular mails meet no Python at all; the table is
    scanned twice then, for keys and headers alone. ``one_pass`` keeps to one scan, for frames that hold much more than headers: the
    three values of every row go through the parser.
    """
    if not set(groups) - set(NATIVE):
        rows = df.select(key, header_table(F.col(raw)).alias("_h"), F.lit(None).cast(rfc.PARTS).alias("_r"))
        return _features(rows, key, groups)
    values = [header_value(F.col("_h"), n).alias(c) for n, c in (("From", "_from"), ("Reply-To", "_reply"), ("Date", "_date"))]
    parsed = lambda rows: rows.select(key, header_table(F.col(raw)).alias("_h")).select("*", *values)
    read = lambda rows: parsed(rows).select(key, "_h", rfc_parts("_from", "_reply", "_date").alias("_r"))
    if one_pass:
        return _features(read(df), key, groups)
    usual = rfc.regular(F.col(raw))
    cut = [rfc.cut_address(F.col("_from")).alias("_f"), rfc.cut_address(F.col("_reply")).alias("_t"), rfc.cut_date(F.col("_date")).alias("_d")]
    # Exploding one value holds Spark back from working it out again for every feature that reads it.
    plain = parsed(df.where(usual)).select("*", *cut).select(key, "_h", F.explode(F.array(rfc.parts(F.col("_f"), F.col("_t"), F.col("_d")))).alias("_r"))
    # A shuffle of the other mails: they are spread evenly, and if there are none no task runs beyond it.
    return _features(plain.unionByName(read(df.where(~usual).select(key, raw).hint("rebalance"))), key, groups)


def _features(rows: DataFrame, key: str, groups: tuple[str, ...]) -> DataFrame:
    columns = {n: c for g in groups for n, c in GROUPS[g](F.col("_h"), F.col("_r")).items()}
    return rows.select(key, *[c.alias(n) for n, c in columns.items()])


def register_sql(spark: SparkSession) -> None:
    """Make the parser of addresses and dates callable from SQL as rfc_parts(from, reply_to, date)."""
    spark.udf.register("rfc_parts", rfc_parts)
