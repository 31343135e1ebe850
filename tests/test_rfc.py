"""Addresses and dates by column expressions against the standard library, over listed and generated headers."""

from __future__ import annotations

import random
from datetime import datetime
from email.utils import parseaddr, parsedate_tz

from pyspark.sql import functions as F

from mailquarry.functions import rfc
from mailquarry.functions.headers import header_features, header_table, header_value
from mailquarry.plans import fixtures

ADDRESSES = [
    "", " ", "bob@gmail.com", " bob@gmail.com\t", "Bob <bob@gmail.com>", "Bob  B. \tSmith   <bob.b@x-y.co.uk> ", '"Smith, Bob" <b@x.org>', '"" <b@x.org>', "<b@x.org>", "J\u00fcrgen \u00df <j@x.org>", "=?UTF-8?B?QWJj?= <d@x.org>",
    "a\u00a0b <d@x.org>", '" in  side " <b@x.org>', "O'Neil!#$%&*+/=?^_`{|}~- <o'n@x.org>", "a@b", "a.b.c@d", "Bob<b@x>", '"q"<b@x>',
    "Bob (comment) <b@x.org>", "b@x.org (Bob)", "a@x.org, b@x.org", "Bob <b@x.org>, c@d", "group: a@b;", "b @ x.org", "<b@x.org", "Bob", "b@", "@x", '"un <b@x>', '"a\\"b" <c@d>', "a@[1.2.3.4]", "Bob <b@x.org> tail", "a..b@x.org", ".a@x", "a@x.",
    "Bob [x] <b@x>", "<<b@x>>", "b@x.org\x00", "a@b@c", "\u00fc@x.org", "a@\u00fc.org", "Bob <>", "Bob: <b@x>", "a;b <c@d>", "\\ <a@b>", "Bob\x7f <a@b>",
]
DATES = [
    "", "yesterday", "Mon, 06 Jan 2025 09:15:00 +0100", "6 Jan 2025 9:15 -0530", "tue, 7 FEB 2024 23:59:59 gmt", "29 Feb 2024 00:00:00 +0000", "29 Feb 2023 00:00:00 +0000", "32 Jan 2025 10:00:00 +0000", "1 Jan 2025 24:00:00 +0000",
    "1 Jan 2025 10:60:00 Z", "1 Jan 2025 10:00:60 EST", "1 Jan 2025 10:00:00 +9999", "1 Jan 2025 10:00:00 -0000", "Fri, 1 Jan 2025 10:00:00 PDT (a zone)", "1 Jan 2025 10:00:00 UT", "0 Jan 2025 10:00:00 UT", "1 Jan 9999 10:00 AST", "Wed,1 Jan 2025 01:02:03 +0130",
    "Mon Jan 6 09:15:00 2025", "1 Jan 25 10:00:00 +0000", "1 January 2025 10:00:00 +0000", "2025-01-06T09:15:00Z", "1 Jan 2025", "1 Jan 2025 10:00:00", "1 Jan 2025 10.00.00 +0000", "1-Jan-2025 10:00:00 +0000", "Monday, 6 Jan 2025 10:00:00 +0000",
    "1 Jan 2025 10:00:00 +01:00", "\u0661 Jan 2025 10:00:00 +0000", "1 Jan 0050 10:00:00 +0000", "1 Jan 2025 10:00:00 XYZ", "x 1 Jan 2025 10:00:00 UT", "Mon, Tue, Wed, Thu, Fri", "1 Jan 2025 10:00:00 +0000 more",
]


def moment(value):
    try:
        parts = parsedate_tz(value)
        at = datetime(*parts[:6])
        return at.weekday(), at.hour, parts[9] or 0
    except Exception:
        return -1, 0, 0


def generated(values, seed, n):
    """The listed values with characters changed, dropped, doubled or put in."""
    rng = random.Random(seed)
    out = list(values)
    for _ in range(n):
        text = list(rng.choice(values))
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randrange(3)] = rng.choice(["", rng.choice(' \t<>@,.;:"()[]\\-+09aZ\u00e9'), "".join(text[at : at + 2]) * 2])
        out.append("".join(text))
    return out


def test_addresses_are_the_standard_library_s(spark):
    values = generated(ADDRESSES, 1, 4000)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.a for r in df.select("i", rfc.address(F.col("v")).alias("a")).collect()}
    read = {i: tuple(a) for i, a in got.items() if a is not None}
    assert all(read[i] == parseaddr(values[i]) for i in read)
    assert all(i in read for i in range(18)) and len(read) > 500


def test_dates_are_the_standard_library_s(spark):
    values = generated(DATES, 2, 4000)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.a for r in df.select("i", rfc.date(F.col("v")).alias("a")).collect()}
    read = {i: tuple(a) for i, a in got.items() if a is not None}
    assert all(read[i] == moment(values[i]) for i in read)
    assert all(i in read for i in range(18)) and len(read) > 300


def test_features_of_odd_mails_in_both_plans(spark):
    """Whole header blocks, folded, repeated and with odd line ends: both plans give what the parser gives for every row."""
    senders, dates, rng = generated(ADDRESSES, 3, 150), generated(DATES, 4, 150), random.Random(5)
    rows = [(None, None), ("e", ""), ("lf", "From: a@b\nDate: 1 Jan 2025 10:00 UT"), ("cr", "From: a@b\rDate: odd 1"), ("fold", "From: A\r\n b <a@b>\r\nX: 1"), ("two", "From: a@b\r\nfrom: odd, <x"), ("no", "From: a@b\nno header\nDate: 7")]
    for i in range(300):
        end = rng.choice(["\r\n", "\n"])
        heads = [f"{rng.choice(['From', 'FROM', 'from'])}: {rng.choice(senders)}", f"Date:{rng.choice(dates)}", f"reply-to: {rng.choice(senders)}", "Subject: x"]
        rng.shuffle(heads)
        rows.append((str(i), end.join(heads[: rng.randrange(2, 5)])))
    df = spark.createDataFrame(rows, "email_id string, raw_headers string")
    split, single = (sorted(map(repr, header_features(df, one_pass=x).collect())) for x in (False, True))
    assert split == single and len(split) == len(rows)
    values = df.select("email_id", *[header_value(header_table(F.col("raw_headers")), n).alias(n) for n in ("From", "Date")]).collect()
    got = {r.email_id: r for r in header_features(df).collect()}
    for r in values:
        display, address = parseaddr(r.From)
        weekday, _, tz = moment(r.Date)
        mine = got[r.email_id]
        assert (mine.day_of_week, mine.timezone_offset, mine.has_valid_date) == (weekday, tz, weekday != -1)
        assert mine.display_name_empty == (display.strip(" ") == "") and mine.from_has_numbers == any(c.isdigit() for c in address.split("@")[0])


def test_regular_mails_meet_no_python(spark, sf_dir):
    """At run time the branch of other mails is found empty, and its Python node gets a relation without partitions."""
    mails = fixtures.emails(spark, sf_dir)
    assert mails.where(~rfc.regular(F.col("raw_headers"))).count() == 0
    features = header_features(mails)
    features.collect()
    final = features._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and final.count("ArrowEvalPython") == 1
    assert "EmptyRelation" in final[final.index("ArrowEvalPython") :]
