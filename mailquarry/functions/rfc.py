"""Addresses and dates of mail headers by regular expressions: the usual forms whole, all others refused."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = T.StructType([T.StructField(n, T.StringType()) for n in ("display", "address", "reply")] + [T.StructField(n, T.IntegerType()) for n in ("weekday", "hour", "tz")])
# Month and day names, and the zones that have a name, with hours from UTC.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
DAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}

_atom = r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]++"
_spec = rf"{_atom}(?:\.{_atom})*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
_word = r'[^\x00-\x20\x7F()<>@,:;"\[\]\\]++'
_phrase = rf"{_word}(?:[ \t]++{_word})*+"
_quoted = r'"[^"\\\x00-\x08\x0A-\x1F\x7F]*+"'
#: A lone address; or one in angle brackets, after a phrase of words, a quoted name, or nothing.
ADDRESS = rf"[ \t]*+(?:({_spec})|(?:({_phrase})|({_quoted}))?+[ \t]*+<({_spec})>)[ \t]*+"
#: Day, month by name, year of four digits, time, zone; a comment may follow.
DATE = (
    rf"(?i:[ \t]*+(?:(?:{'|'.join(DAYS)}),[ \t]*+)?+(\d{{1,2}})[ \t]++({'|'.join(MONTHS)})[ \t]++([1-9]\d{{3}})[ \t]++(\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?+"
    rf"[ \t]++(?:([+-])(\d{{2}})(\d{{2}})|({'|'.join(sorted(ZONES, key=len, reverse=True))}))(?:[ \t]++\([^()\x00-\x08\x0A-\x1F\x7F]*+\))?+[ \t]*+)"
)
#: No digit of any script: surely no date.
NO_DATE = r"(?U:[^\d\x00-\x08\x0A-\x1F\x7F]*+)"
_nothing = r"[ \t]*+"
#: Parts the groups of a match; no form has it.
CUT = "\x01"


def _line(name: str, *forms: str) -> str:
    """A header line of this name, with a value of none of the forms, or folded."""
    return rf"(?md)^(?i:{name}):(?![ \t]*+(?:{'|'.join(f'(?:{x})' for x in forms)})\r?+(?:\n(?![ \t])|\z))"


#: Header blocks with an address or a date that only a full parser reads, or with line ends that are odd.
ODD = "|".join([_line("from", ADDRESS, _nothing), _line("reply-to", ADDRESS, _nothing), _line("date", DATE, NO_DATE), r"\r(?!\n)"])


def regular(raw: Column) -> Column:
    """Whether all senders, reply addresses and dates of a header block have the usual forms; no block is regular too."""
    return ~F.coalesce(F.rlike(raw, F.lit(ODD)), F.lit(False))


def _whole(form: str) -> str:
    return rf"\A(?:{form})\z"


def _cut(value: Column, form: str, groups: int) -> Column:
    """The groups of a form that a whole value has, by one match; of another value the value alone."""
    return F.split(F.regexp_replace(value, _whole(form), CUT.join(f"${k}" for k in range(1, groups + 1))), CUT, -1)


def cut_address(value: Column) -> Column:
    """The parts of a value in the form ADDRESS."""
    return _cut(value, ADDRESS, 4)


def cut_date(value: Column) -> Column:
    """The parts of a value in the form DATE."""
    return _cut(value, DATE, 10)


def of_address(cut: Column) -> Column:
    """(display, address) of a value's parts; both empty for any other value."""
    quoted = F.substring(cut[2], F.lit(2), F.length(cut[2]) - 2)
    name = F.when(cut[2] != "", quoted).otherwise(F.regexp_replace(cut[1], "[ \t]+", " "))
    found = F.struct(name.alias("display"), F.concat(cut[0], cut[3]).alias("address"))
    return F.when(F.size(cut) == 4, found).otherwise(F.struct(F.lit("").alias("display"), F.lit("").alias("address")))


def of_date(cut: Column) -> Column:
    """(weekday, hour, tz) of a value's parts; weekday -1 if there is no such moment, and for any other value."""
    number = lambda k: F.coalesce(cut[k].try_cast("int"), F.lit(0))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(cut[1]))
    day = F.try_to_date(F.concat_ws("-", cut[2], F.lpad(month.cast("string"), 2, "0"), F.lpad(cut[0], 2, "0")), "yyyy-MM-dd")
    valid = day.isNotNull() & (number(3) < 24) & (number(4) < 60) & (number(5) < 60)
    named = F.coalesce(F.create_map(*[F.lit(x) for z, h in ZONES.items() for x in (z, h)])[F.upper(cut[9])], F.lit(0)) * 3600
    offset = F.when(cut[6] == "", named).otherwise((number(7) * 3600 + number(8) * 60) * F.when(cut[6] == "-", -1).otherwise(1))
    moment = lambda w, h, z: F.struct(w.cast("int").alias("weekday"), h.cast("int").alias("hour"), z.cast("int").alias("tz"))
    return F.when((F.size(cut) == 10) & valid, moment(F.weekday(day), number(3), offset)).otherwise(moment(F.lit(-1), F.lit(0), F.lit(0)))


def address(value: Column) -> Column:
    """(display, address) of a value; null if its form is not a usual one."""
    return F.when(F.rlike(value, F.lit(_whole(f"{ADDRESS}|{_nothing}"))), of_address(cut_address(value)))


def date(value: Column) -> Column:
    """(weekday, hour, tz) of a value, weekday -1 if there is no such moment; null if its form is not a usual one."""
    return F.when(F.rlike(value, F.lit(_whole(f"{DATE}|{NO_DATE}"))), of_date(cut_date(value)))


def parts(sender: Column, reply_to: Column, sent: Column) -> Column:
    """What the parts of three values of usual forms say, as PARTS."""
    a, r, d = of_address(sender), of_address(reply_to), of_date(sent)
    return F.struct(a["display"].alias("display"), a["address"].alias("address"), r["address"].alias("reply"), d["weekday"].alias("weekday"), d["hour"].alias("hour"), d["tz"].alias("tz"))
