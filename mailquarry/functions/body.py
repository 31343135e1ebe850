"""Body features: 43 columns in eight groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailquarry.functions.text import SPACE, contains_any, count_all, count_char, count_matches, matches, ratio, strip

# The phrase lists and patterns that the features are defined by.
URGENCY = (
    "urgent", "immediately", "asap", "right now", "expire", "expires", "expiring", "limited time", "act now", "don't wait", "hurry", "quick",
    "fast", "deadline", "today only", "last chance", "final notice", "time sensitive", "respond now", "immediate action", "within 24 hours",
    "within 48 hours",
)
AUTHORITY = (
    "verify", "confirm", "validate", "authenticate", "security alert", "account", "suspended", "locked", "unauthorized", "unusual activity",
    "fraud", "fraudulent", "verify your identity", "confirm your identity", "security team", "security department", "customer service",
    "support team", "administrator", "system administrator", "it department",
)
TRUSTED_DOMAINS = (
    "google.com", "microsoft.com", "apple.com", "amazon.com", "facebook.com", "paypal.com", "ebay.com", "netflix.com", "linkedin.com",
    "twitter.com", "instagram.com", "yahoo.com", "outlook.com", "gmail.com",
)
THREAT = (
    "suspend", "terminated", "cancelled", "closed", "blocked", "restricted", "legal action", "lawsuit", "court", "penalty", "fine", "police",
    "arrest", "criminal", "prosecution", "consequences", "lose access", "permanently deleted", "violation", "breach", "compromised",
)
REQUEST = (
    "click here", "click the link", "click below", "log in", "login", "sign in", "update", "confirm", "verify", "provide", "enter", "submit",
    "reset password", "change password", "update payment", "billing information", "credit card", "social security", "ssn", "account number",
    "routing number", "date of birth", "mother's maiden name",
)
GREETINGS = (
    "dear customer", "dear user", "dear member", "dear sir/madam", "dear sir or madam", "hello user", "valued customer",
    "dear valued customer", "dear account holder", "dear client", "greetings",
)
IMPERATIVES = (
    "click", "verify", "confirm", "update", "download", "open", "call", "contact", "respond", "reply", "send", "provide", "enter", "submit",
    "reset", "change", "renew", "activate", "complete", "review",
)
SECOND_PERSON = ("you", "your", "yours", "you're", "you've", "you'll")
FIRST_PLURAL = (" we ", " our ", " us ", "we're", "we've", "we'll")
FIRST_PERSON = ("i am", "i have", "i will", "i need", "i want", "my name")
PASSWORD = ("password", "passphrase", "pin", "security code")
FINANCIAL = ("credit card", "bank account", "routing number", "card number", "cvv", "billing")
PERSONAL = ("social security", "ssn", "date of birth", "driver's license", "passport")
FORM = ("fill out", "complete the form", "enter your", "input your", "provide your")
MONEY = ("refund", "prize", "lottery", "inheritance", "compensation", "owed", "transfer", "wire", "payment", "invoice")
PRIZE = ("you have won", "you've won", "congratulations", "claim your", "you are selected", "you have been chosen")
TIME_PRESSURE = (r"within\s+\d+\s+(hour|day|minute)s?", r"in\s+the\s+next\s+\d+\s+(hour|day)s?", r"\d+\s+(hour|day)s?\s+to\s+", r"before\s+\d+[:/]\d+")
IMPERSONATION = (
    r"(we are|this is|i am)\s+(from|with|representing)\s+",
    r"official\s+(notice|notification|communication|email)",
    r"on\s+behalf\s+of",
    r"authorized\s+(representative|agent|personnel)",
)
CONSEQUENCE = (
    r"(will|may|could)\s+be\s+(suspended|terminated|closed|deleted|removed)",
    r"(lose|loss of)\s+(access|account|data|information)",
    r"unable\s+to\s+(access|use|log in|sign in)",
)
NAMED_GREETING = ("dear [a-z]+", "hi [a-z]+", "hello [a-z]+")
AMOUNT = r"[$£€¥]\s*\d+(?:,\d{3})*(?:\.\d{2})?|\d+(?:,\d{3})*(?:\.\d{2})?\s*(?:dollars|USD|EUR|GBP)"
LARGE_SUM = r"[$£€¥]\s*\d{1,3}(?:,\d{3})+|\d+\s*(?:million|billion|thousand)"
GREETING_CHARS = 200

_S = f"[{SPACE}]"
_W = f"[^.!?{SPACE}]"
#: A sentence of one or two words, and one of over fifty, each tried only where a sentence begins.
SHORT_SENTENCE = rf"(?:^|[.!?]){_S}*+{_W}++(?:{_S}++{_W}++)?{_S}*+(?:[.!?]|\z)"
LONG_SENTENCE = rf"(?:^|[.!?]){_S}*+(?:{_W}++{_S}++){{50}}{_W}"

#: A word that the next one repeats: a whole one, as it begins after white space and is never given back.
REPEATED_WORD = rf"(?<![^{SPACE}])([^{SPACE}]++)(?={_S}++\1(?![^{SPACE}]))"


def _spaced(patterns: tuple[str, ...]) -> str:
    """One alternation, its white space that of all scripts."""
    return "|".join(f"(?:{p})" for p in patterns).replace(r"\s", _S)


class Body:
    """The texts that the features read: a body, empty if it is blank or null, and its lower case."""

    def __init__(self, text: Column, lower: Column) -> None:
        self.text, self.lower = text, lower

    @classmethod
    def of(cls, body: Column) -> Body:
        filled = F.coalesce(body, F.lit(""))
        text = F.when(matches(filled, f"[^{SPACE}]"), filled).otherwise(F.lit(""))
        return cls(text, F.lower(text))


def urgency(b: Body) -> dict[str, Column]:
    count, marks = count_all(b.lower, URGENCY), count_char(b.text, "!")
    return {
        "urgency_keyword_count": count,
        "has_urgency": count > 0,
        "has_time_pressure": matches(b.lower, _spaced(TIME_PRESSURE)),
        "exclamation_count": marks,
        "excessive_exclamation": marks >= 3,
    }


def authority(b: Body) -> dict[str, Column]:
    count = count_all(b.lower, AUTHORITY)
    return {
        "authority_keyword_count": count,
        "has_authority_language": count > 0,
        "has_impersonation_pattern": matches(b.lower, _spaced(IMPERSONATION)),
        "claims_trusted_domain": contains_any(b.lower, TRUSTED_DOMAINS),
    }


def threat(b: Body) -> dict[str, Column]:
    count = count_all(b.lower, THREAT)
    return {
        "threat_keyword_count": count,
        "has_threat": count > 0,
        "has_consequence_language": matches(b.lower, _spaced(CONSEQUENCE)),
    }


def request(b: Body) -> dict[str, Column]:
    count = count_all(b.lower, REQUEST)
    return {
        "request_keyword_count": count,
        "has_request": count > 0,
        "requests_password": contains_any(b.lower, PASSWORD),
        "requests_financial": contains_any(b.lower, FINANCIAL),
        "requests_personal": contains_any(b.lower, PERSONAL),
        "mentions_form": contains_any(b.lower, FORM),
    }


def linguistic(b: Body) -> dict[str, Column]:
    n_words = count_matches(b.text, f"[^{SPACE}]+")
    n_chars = F.length(F.regexp_replace(b.text, f"(?U)[{SPACE}]+", ""))
    n_sentences = count_matches(b.text, f"{_W}[^.!?]*")
    # A pronoun counts between blanks, or after a blank and before a comma or full stop, or first in the text.
    inside = count_all(b.lower, [f" {p}{end}" for p in SECOND_PERSON for end in " ,."])
    first = sum((F.startswith(b.lower, F.lit(p + " ")).cast("long") for p in SECOND_PERSON), F.lit(0))
    second = F.when(F.contains(b.lower, F.lit(" you")), inside).otherwise(F.lit(0)) + first
    return {
        "word_count": n_words,
        "avg_word_length": ratio(n_chars, n_words, 2),
        "sentence_count": n_sentences,
        "avg_sentence_length": ratio(n_words, n_sentences, 2),
        "capitalization_ratio": ratio(F.length(F.regexp_replace(b.text, r"\P{IsUppercase}+", "")), F.length(F.regexp_replace(b.text, r"\P{L}+", "")), 3),
        "repeated_word_count": count_matches(b.lower, REPEATED_WORD),
        "has_excessive_spacing": matches(b.text, f"{_S}{{4}}"),
        "has_irregular_sentences": matches(b.text, f"{SHORT_SENTENCE}|{LONG_SENTENCE}"),
        "imperative_verb_count": count_all(b.lower, IMPERATIVES),
        "second_person_pronoun_ratio": ratio(second, n_words, 3),
        "first_person_plural_ratio": ratio(count_all(b.lower, FIRST_PLURAL), n_words, 3),
    }


def structural(b: Body) -> dict[str, Column]:
    tags = count_matches(b.text, "<[^>]+>")
    breaks = count_matches(strip(b.text), f"\\n{_S}*\\n")
    return {
        "body_length": F.length(b.text).cast("long"),
        "line_count": count_matches(b.text, f"[^{SPACE}][^\\n]*"),
        "paragraph_count": F.when(b.text == "", F.lit(0)).otherwise(breaks + 1).cast("long"),
        "has_html_tags": tags > 0,
        "html_tag_count": tags,
        "special_char_ratio": ratio(F.length(F.regexp_replace(b.text, r"[\x00-\x7F]+", "")), F.length(b.text), 3),
    }


def personalization(b: Body) -> dict[str, Column]:
    head = F.substring(b.lower, 1, GREETING_CHARS)
    return {
        "has_generic_greeting": contains_any(head, GREETINGS),
        "has_name_in_greeting": matches(head, "|".join(NAMED_GREETING)),
        "uses_first_person": contains_any(b.lower, FIRST_PERSON),
    }


def money(b: Body) -> dict[str, Column]:
    count = count_matches(b.text, AMOUNT.replace(r"\s", _S))
    return {
        "money_mention_count": count,
        "mentions_money": count > 0,
        "mentions_large_sum": matches(b.text, LARGE_SUM.replace(r"\s", _S), "iuU"),
        "money_keyword_count": count_all(b.lower, MONEY),
        "has_prize_language": contains_any(b.lower, PRIZE),
    }


GROUPS = {
    "urgency": urgency,
    "authority": authority,
    "threat": threat,
    "request": request,
    "linguistic": linguistic,
    "structural": structural,
    "personalization": personalization,
    "money": money,
}


def _columns(texts: Body, groups: tuple[str, ...]) -> dict[str, Column]:
    return {name: column for g in groups for name, column in GROUPS[g](texts).items()}


def body_columns(body: Column, groups: tuple[str, ...] = tuple(GROUPS)) -> dict[str, Column]:
    """Feature columns by name, usable in any select, on tables and streams alike."""
    return _columns(Body.of(body), groups)


def with_body_features(df: DataFrame, body: str = "body", groups: tuple[str, ...] = tuple(GROUPS)) -> DataFrame:
    """``df`` with the feature columns added.

    The cleaned text and its lower case are columns of a projection of their own, which the optimizer
    keeps apart as they are used many times, so each is computed once per row.
    """
    texts = Body.of(F.col(body))
    rows = df.withColumn("_text", texts.text).withColumn("_lower", F.lower("_text"))
    return rows.withColumns(_columns(Body(F.col("_text"), F.col("_lower")), groups)).drop("_text", "_lower")


def body_features(df: DataFrame, body: str = "body", key: str = "email_id", groups: tuple[str, ...] = tuple(GROUPS)) -> DataFrame:
    """(key, features): a row per mail; blank or null bodies have zeros and false throughout."""
    return with_body_features(df.select(key, F.col(body).alias("_body")), "_body", groups).drop("_body")
