"""Names, callables and SQL of the e-mail feature queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.functions import headers, urls
from mailquarry.functions.body import GROUPS, body_features
from mailquarry.plans import file_queries, fixtures, mail_sql, other_queries
from mailquarry.plans.body_sql import body_sql

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under a name, with the DuckDB SQL that gives the same rows."""

    def add(query: Query) -> Query:
        _queries[name] = query
        if sql:
            _sql[name] = sql
        return query

    return add


def _body(groups: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: body_features(fixtures.emails(spark, sf_dir), groups=groups)


for _group in GROUPS:
    register(f"body_{_group}", body_sql((_group,)))(_body((_group,)))
register("body_all", body_sql(tuple(GROUPS)))(_body(tuple(GROUPS)))


@register("body_blank", body_sql(tuple(GROUPS), "NOT coalesce(regexp_matches(body, '[^ \\n\\t]'), false)"))
def body_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and missing bodies only."""
    mails = fixtures.emails(spark, sf_dir)
    return body_features(mails.where(~F.coalesce(F.rlike("body", F.lit(r"[^ \n\t]")), F.lit(False))))


for _group in headers.GROUPS:
    register(f"hdr_{_group}", mail_sql.headers_sql((_group,)))(lambda spark, sf_dir, g=_group: headers.header_features(fixtures.emails(spark, sf_dir), groups=(g,)))
register("hdr_all", mail_sql.headers_sql(tuple(headers.GROUPS)))(lambda spark, sf_dir: headers.header_features(fixtures.emails(spark, sf_dir)))


@register("header_list", mail_sql.HEADER_LIST)
def header_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header names of every mail."""
    return fixtures.emails(spark, sf_dir).select("email_id", headers.header_list(headers.header_table(F.col("raw_headers"))).alias("header_list"))


for _kind, _find in (("http", urls.http_urls), ("bare", urls.bare_urls), ("www", urls.www_urls)):

    def _urls(spark: SparkSession, sf_dir: str, find: Callable = _find) -> DataFrame:
        found = fixtures.emails(spark, sf_dir).select("email_id", F.posexplode(find(F.col("body"))).alias("pos", "url"))
        return found.withColumn("pos", F.col("pos").cast("long"))

    register(f"urls_{_kind}", mail_sql.url_kind_sql(_kind))(_urls)
register("urls_per_mail", mail_sql.URLS_PER_MAIL)(lambda spark, sf_dir: urls.url_table(fixtures.emails(spark, sf_dir)))
register("url_wordlist", mail_sql.URL_WORDLIST)(lambda spark, sf_dir: urls.url_wordlist(fixtures.emails(spark, sf_dir)))


other_queries.register_all(register)
file_queries.register_all(register)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of every mail."""
    return _queries["pipeline_wide"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
