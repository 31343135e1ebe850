"""The body features in DuckDB."""

from __future__ import annotations

from mailquarry.functions import body as B
from mailquarry.plans.fixtures import emails_sql

#: White space of all scripts, inside a class.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_S, _W = f"[{SPACE}]", f"[^.!?{SPACE}]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _count(text: str, phrases: tuple[str, ...] | list[str]) -> str:
    return "(" + " + ".join(f"(length({text}) - length(replace({text}, {quoted(p)}, ''))) // {len(p)}" for p in phrases) + ")"


def _any(text: str, phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(p)})" for p in phrases) + ")"


def _portable(pattern: str) -> str:
    return pattern.replace(r"\s", _S).replace(r"\d", r"\p{Nd}")


def _match(text: str, patterns: tuple[str, ...], flags: str = "") -> str:
    return f"regexp_matches({text}, {quoted(flags + _portable('|'.join(f'(?:{p})' for p in patterns)))})"


def _matches(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {quoted(pattern)}))"


def _ratio(part: str, whole: str, digits: int) -> str:
    return f"((({part}) * {2 * 10**digits} + greatest({whole}, 1)) // (2 * greatest({whole}, 1))) / CAST({10**digits} AS DOUBLE)"


_words = _matches("t", f"[^{SPACE}]+")
_sentences = _matches("t", f"{_W}[^.!?]*")
_trimmed = f"regexp_replace(t, {quoted(f'^{_S}+|{_S}+$')}, '', 'g')"
_pieces = f"list_filter(regexp_split_to_array(t, '[.!?]+'), lambda s: regexp_matches(s, {quoted(f'[^{SPACE}]')}))"
_second = " + ".join(f"{_count('l', [f' {p} ', f' {p},', f' {p}.'])} + CAST(starts_with(l, {quoted(p + ' ')}) AS BIGINT)" for p in B.SECOND_PERSON)
_tokens = f"list_filter(regexp_split_to_array(l, {quoted(_S + '+')}), lambda w: w <> '')"

EXPRESSIONS: dict[str, dict[str, str]] = {
    "urgency": {
        "urgency_keyword_count": _count("l", B.URGENCY),
        "has_urgency": f"{_count('l', B.URGENCY)} > 0",
        "has_time_pressure": _match("l", B.TIME_PRESSURE),
        "exclamation_count": "length(t) - length(replace(t, '!', ''))",
        "excessive_exclamation": "length(t) - length(replace(t, '!', '')) >= 3",
    },
    "authority": {
        "authority_keyword_count": _count("l", B.AUTHORITY),
        "has_authority_language": f"{_count('l', B.AUTHORITY)} > 0",
        "has_impersonation_pattern": _match("l", B.IMPERSONATION),
        "claims_trusted_domain": _any("l", B.TRUSTED_DOMAINS),
    },
    "threat": {
        "threat_keyword_count": _count("l", B.THREAT),
        "has_threat": f"{_count('l', B.THREAT)} > 0",
        "has_consequence_language": _match("l", B.CONSEQUENCE),
    },
    "request": {
        "request_keyword_count": _count("l", B.REQUEST),
        "has_request": f"{_count('l', B.REQUEST)} > 0",
        "requests_password": _any("l", B.PASSWORD),
        "requests_financial": _any("l", B.FINANCIAL),
        "requests_personal": _any("l", B.PERSONAL),
        "mentions_form": _any("l", B.FORM),
    },
    "linguistic": {
        "word_count": _words,
        "avg_word_length": _ratio(f"length(regexp_replace(t, {quoted(_S + '+')}, '', 'g'))", _words, 2),
        "sentence_count": _sentences,
        "avg_sentence_length": _ratio(_words, _sentences, 2),
        "capitalization_ratio": _ratio(r"length(regexp_replace(t, '\P{Lu}+', '', 'g'))", r"length(regexp_replace(t, '\P{L}+', '', 'g'))", 3),
        "repeated_word_count": "len(list_filter(list_zip(w[:len(w) - 1], w[2:]), lambda p: p[1] = p[2]))",
        "has_excessive_spacing": _match("t", (r"\s{4}",)),
        "has_irregular_sentences": f"len(list_filter({_pieces}, lambda s: len(regexp_extract_all(s, {quoted(f'[^{SPACE}]+')})) NOT BETWEEN 3 AND 50)) > 0",
        "imperative_verb_count": _count("l", B.IMPERATIVES),
        "second_person_pronoun_ratio": _ratio(_second, _words, 3),
        "first_person_plural_ratio": _ratio(_count("l", B.FIRST_PLURAL), _words, 3),
    },
    "structural": {
        "body_length": "length(t)",
        "line_count": f"len(list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, {quoted(f'[^{SPACE}]')})))",
        "paragraph_count": f"len(list_filter(regexp_split_to_array(t, {quoted(f'\\n{_S}*\\n')}), lambda s: regexp_matches(s, {quoted(f'[^{SPACE}]')})))",
        "has_html_tags": "regexp_matches(t, '<[^>]+>')",
        "html_tag_count": _matches("t", "<[^>]+>"),
        "special_char_ratio": _ratio(r"length(regexp_replace(t, '[\x00-\x7F]+', '', 'g'))", "length(t)", 3),
    },
    "personalization": {
        "has_generic_greeting": _any(f"substr(l, 1, {B.GREETING_CHARS})", B.GREETINGS),
        "has_name_in_greeting": _match(f"substr(l, 1, {B.GREETING_CHARS})", B.NAMED_GREETING),
        "uses_first_person": _any("l", B.FIRST_PERSON),
    },
    "money": {
        "money_mention_count": _matches("t", _portable(B.AMOUNT)),
        "mentions_money": f"{_matches('t', _portable(B.AMOUNT))} > 0",
        "mentions_large_sum": _match("t", (B.LARGE_SUM,), "(?i)"),
        "money_keyword_count": _count("l", B.MONEY),
        "has_prize_language": _any("l", B.PRIZE),
    },
}
BOOLEANS = ("has_", "requests_", "mentions_", "excessive_", "claims_", "uses_")


def _typed(name: str, expression: str) -> str:
    kind = "BOOLEAN" if name.startswith(BOOLEANS) else "DOUBLE" if "ratio" in name or name.startswith("avg_") else "BIGINT"
    return f"CAST({expression} AS {kind}) AS {name}"


def body_sql(groups: tuple[str, ...], where: str = "true", emails: str | None = None) -> str:
    """The groups' features of every mail of the fixture, or of another relation of email_id and body."""
    columns = ",\n  ".join(_typed(n, e) for g in groups for n, e in EXPRESSIONS[g].items())
    return f"""
WITH mails AS ({emails or emails_sql()}),
filled AS (SELECT email_id, CASE WHEN regexp_matches(body, {quoted(f"[^{SPACE}]")}) THEN body ELSE '' END AS t FROM mails WHERE {where}),
lowered AS (SELECT email_id, t, lower(t) AS l FROM filled),
texts AS (SELECT email_id, t, l, {_tokens} AS w FROM lowered)
SELECT email_id, {columns} FROM texts"""
