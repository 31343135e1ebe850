"""Header and URL features in DuckDB."""

from __future__ import annotations

from mailquarry.functions import headers as H
from mailquarry.functions import urls as U
from mailquarry.plans.body_sql import SPACE, quoted
from mailquarry.plans.fixtures import emails_sql

_one = lambda name: f"coalesce(list_filter(h, lambda x: x.name = '{name}')[1].value, '')"
_has = lambda name: f"len(list_filter(h, lambda x: x.name = '{name}')) > 0"
_foreign = lambda v: f"((contains({v}, '=?') AND contains({v}, '?=')) OR regexp_matches({v}, '[^\\x00-\\x7F]'))"
_domain = lambda a: f"CASE WHEN contains({a}, '@') THEN lower(string_split({a}, '@')[-1]) ELSE '' END"
_stamp = "try_strptime(regexp_extract(date, '^[A-Z][a-z]{2}, (.*) [+-][0-9]{4}$', 1), '%d %b %Y %H:%M:%S')"
_valid = f"{_stamp} IS NOT NULL"
_zone = "regexp_extract(date, '([+-][0-9]{4})$', 1)"
_offset = f"CASE WHEN {_valid} OR regexp_matches(date, '^[A-Z][a-z]{{2}}, [0-9]') THEN coalesce(CASE WHEN {_zone} <> '' THEN (CASE WHEN {_zone}[1] = '-' THEN -1 ELSE 1 END) * (CAST({_zone}[2:3] AS BIGINT) * 3600 + CAST({_zone}[4:5] AS BIGINT) * 60) END, 0) ELSE 0 END"
_tz = f"CASE WHEN {_valid} THEN {_offset} ELSE 0 END"
_relays = f"list_transform(regexp_extract_all(x.value, {quoted(H.RELAY_IP)}), lambda y: trim(y, '[]'))"
_ips = f"flatten(list_transform(list_filter(h, lambda x: x.name = 'received'), lambda x: {_relays}))"
_hops = "len(list_filter(h, lambda x: x.name = 'received'))"
_complexity = f"length({_one('content-type')}) - length(replace({_one('content-type')}, ';', ''))"
_returned = f"trim({_one('return-path')}, '<>')"

EXPRESSIONS: dict[str, dict[str, tuple[str, str]]] = {
    "authenticity": {
        "has_dkim": (_has("dkim-signature"), "BOOLEAN"),
        "has_spf": (f"contains(lower({_one('authentication-results')}), 'spf=')", "BOOLEAN"),
        "from_return_mismatch": (f"{_domain('address')} <> '' AND {_domain(_returned)} <> '' AND {_domain('address')} <> {_domain(_returned)}", "BOOLEAN"),
        "has_auth_results": (f"{_one('authentication-results')} <> ''", "BOOLEAN"),
    },
    "sender": {
        "from_free_provider": (f"{_domain('address')} IN ({', '.join(map(quoted, H.FREE_PROVIDERS))})", "BOOLEAN"),
        "from_has_numbers": ("regexp_matches(string_split(address, '@')[1], '[0-9]')", "BOOLEAN"),
        "display_name_empty": ("trim(display) = ''", "BOOLEAN"),
        "display_name_is_email": ("display <> '' AND trim(lower(display)) = trim(lower(address))", "BOOLEAN"),
        "reply_to_differs": ("reply <> '' AND lower(reply) <> lower(address)", "BOOLEAN"),
    },
    "structural": {
        "missing_message_id": (f"NOT ({_has('message-id')})", "BOOLEAN"),
        "has_x_mailer": (_has("x-mailer"), "BOOLEAN"),
        "content_type_complexity": (_complexity, "BIGINT"),
    },
    "temporal": {
        "sent_business_hours": (f"{_valid} AND isodow({_stamp}) <= 5 AND hour({_stamp}) >= 8 AND hour({_stamp}) < 18", "BOOLEAN"),
        "timezone_offset": (_tz, "BIGINT"),
        "day_of_week": (f"CASE WHEN {_valid} THEN isodow({_stamp}) - 1 ELSE -1 END", "BIGINT"),
    },
    "encoding": {
        "uses_base64": (f"contains(lower({_one('content-transfer-encoding')}), 'base64')", "BOOLEAN"),
        "uses_quoted_printable": (f"contains(lower({_one('content-transfer-encoding')}), 'quoted-printable')", "BOOLEAN"),
        "unicode_in_from": (_foreign(_one("from")), "BOOLEAN"),
        "unicode_in_subject": (_foreign(_one("subject")), "BOOLEAN"),
    },
    "received": {
        "received_count": (_hops, "BIGINT"),
        "unique_relay_ips": (f"len(list_distinct({_ips}))", "BIGINT"),
        "all_private_ips": (f"len({_ips}) > 0 AND len(list_filter({_ips}, lambda y: NOT regexp_matches(y, {quoted(H.PRIVATE_IP)}))) = 0", "BOOLEAN"),
        "ip_diversity_ratio": (f"CASE WHEN {_hops} = 0 THEN 0.0 ELSE CAST(len(list_distinct({_ips})) AS DOUBLE) / {_hops} END", "DOUBLE"),
    },
    "quality": {
        "has_valid_date": (_valid, "BOOLEAN"),
        "has_extreme_complexity": (f"{_complexity} > 10", "BOOLEAN"),
        "has_unusual_timezone": (f"abs({_tz}) > 50400", "BOOLEAN"),
        "data_quality_score": (f"CAST({_valid} AS BIGINT) + CAST(NOT ({_complexity} > 10) AS BIGINT) + CAST(NOT (abs({_tz}) > 50400) AS BIGINT)", "BIGINT"),
    },
}

#: Headers of every mail, with folds as single spaces; addresses in the forms that the fixture has.
HEADERS = """
blocks AS (SELECT email_id, string_split(regexp_replace(raw_headers, '\\r\\n[ \\t]+', ' ', 'g'), concat(chr(13), chr(10))) AS lines FROM mails),
tables AS (SELECT email_id, list_transform(list_filter(lines, lambda x: contains(x, ':')), lambda x: {'name': lower(string_split(x, ':')[1]), 'label': string_split(x, ':')[1], 'value': ltrim(x[instr(x, ':') + 1:])}) AS h FROM blocks),"""


def headers_sql(groups: tuple[str, ...]) -> str:
    """The groups' features of every mail of the fixture."""
    address = lambda v: f"CASE WHEN contains({v}, '<') THEN regexp_extract({v}, '<([^>]*)>', 1) ELSE trim({v}) END"
    columns = ",\n  ".join(f"CAST({e} AS {t}) AS {n}" for g in groups for n, (e, t) in EXPRESSIONS[g].items())
    return f"""
WITH mails AS ({emails_sql()}),{HEADERS}
parsed AS (
  SELECT email_id, h, {address(_one("from"))} AS address, {address(_one("reply-to"))} AS reply, {_one("date")} AS date,
         CASE WHEN contains({_one("from")}, '<') THEN trim(trim(string_split({_one("from")}, '<')[1]), '"') ELSE '' END AS display
  FROM tables)
SELECT email_id, {columns} FROM parsed"""


HEADER_LIST = f"""
WITH mails AS ({emails_sql()}),{HEADERS.rstrip(",")}
SELECT email_id, array_to_string(list_transform(h, lambda x: x.label), ',') AS header_list FROM tables"""

_path = U.PATH.replace(r"\s", SPACE)
_http = rf"(?i)https?://(?:{U.HOST}\.)+[a-zA-Z]{{2,}}(?:{_path})?"
_ends = r"(?:$|[,;!?)])"
_bare = rf"(?i)^((?:{U.HOST}\.)+(?:{'|'.join(U.TOP_LEVEL)})(?:{_path})?){_ends}"
_www = rf"(?i)^(www\.(?:{U.HOST}\.)*{U.HOST}(?:{_path})?){_ends}"
_pieces = f"list_filter(regexp_split_to_array(t, {quoted(f'[{SPACE}]+')}), lambda x: x <> '')"
_no_mail = rf"list_filter(w, lambda x: NOT regexp_matches(x, '^[\w.-]*@'))"
_first = lambda of, p: f"list_filter(list_transform({of}, lambda x: regexp_extract(x, {quoted(p)}, 1)), lambda x: x <> '')"
LISTS = {"http": f"regexp_extract_all(t, {quoted(_http)})", "bare": _first(_no_mail, _bare), "www": _first("w", _www)}
_clean = f"list_filter(list_transform(list_concat({', '.join(LISTS.values())}), lambda x: regexp_replace(x, '[.,;!?)\\]]+$', '')), lambda x: x <> '')"
_texts = f"""
WITH mails AS ({emails_sql()}),
filled AS (SELECT email_id, coalesce(body, '') AS t FROM mails),
texts AS (SELECT email_id, t, {_pieces} AS w FROM filled),
lists AS (SELECT email_id, @list AS l FROM texts)"""
_rows = "\nSELECT email_id, CAST(unnest(range(len(l))) AS BIGINT) AS pos, unnest(l) AS url FROM {}"
_once = ",\nonce AS (SELECT email_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM lists)"


def url_kind_sql(kind: str) -> str:
    return _texts.replace("@list", LISTS[kind]) + _rows.format("lists")


URLS_PER_MAIL = _texts.replace("@list", _clean) + _once + _rows.format("once")
URL_WORDLIST = _texts.replace("@list", _clean) + "\nSELECT DISTINCT url FROM (SELECT unnest(l) AS url FROM lists)"
