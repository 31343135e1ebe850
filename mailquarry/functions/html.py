"""HTML to text, raw mails to parts, and the choice of a body, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailquarry.functions.text import strip

#: Elements whose content is no text.
SILENT = ("script", "style", "noscript")
# Entities that stand for one character; the ampersand's own comes last.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ", "&copy;": "©", "&reg;": "®", "&trade;": "™",
    "&middot;": "·", "&bull;": "•", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—", "&lsquo;": "‘", "&rsquo;": "’",
    "&ldquo;": "“", "&rdquo;": "”", "&euro;": "€", "&pound;": "£", "&yen;": "¥", "&laquo;": "«", "&raquo;": "»", "&amp;": "&",
}


def html_to_text(html: Column) -> Column:
    """The text nodes, one line break between them where tags stood; scripts, styles and comments give nothing.

    Null is empty. Entities outside the table stay as they are.
    """
    text = F.regexp_replace(F.coalesce(html, F.lit("")), "(?is)<!--.*?-->|<![^>]*>", "<!>")
    text = F.regexp_replace(text, rf"(?is)<({'|'.join(SILENT)})\b[^>]*>.*?</\1\s*>", "<!>")
    text = F.regexp_replace(text, "(?:<[!/a-zA-Z][^>]*>)+", "\n")
    text = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), text)
    return strip(text)


def raw_headers(raw: Column) -> Column:
    """What stands before the first blank line: of CRLF line ends anywhere, else of LF; all of it if there is none."""
    crlf, lf = F.instr(raw, "\r\n\r\n"), F.instr(raw, "\n\n")
    return F.when(crlf > 0, F.substring(raw, F.lit(1), crlf - 1)).when(lf > 0, F.substring(raw, F.lit(1), lf - 1)).otherwise(raw)


def select_body(plain: Column, html: Column) -> Column:
    """The plain part if it has any character, else the text of the html part, else nothing; stripped."""
    chosen = F.when(F.coalesce(plain, F.lit("")) != "", plain).otherwise(html_to_text(html))
    return strip(chosen)
