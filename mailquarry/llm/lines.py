"""Line deduplication by a log-template tree, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailquarry.llm._runtime import spare, stage

#: Leading tokens on a path of the tree, below the token count.
LEADING = 3
#: Documents in which a template must occur to be dropped.
MIN_DOCS = 5
#: Share of a line's tokens that its template must keep, in percent; below it the line is its own template.
MIN_KEPT = 70
#: Lines of more tokens are long: where they are dropped by themselves, two documents are enough.
LONG_TOKENS = 20
FIELD = "<*>"


def tokens(line: Column) -> Column:
    """A line's tokens: what single spaces part, without empty ones."""
    return F.array_remove(F.split(line, " "), "")


def generalised(token: Column) -> Column:
    """A token that holds a digit is a variable field."""
    return F.when(F.translate(token, "0123456789", "") == token, token).otherwise(F.lit(FIELD))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, leading: int, min_kept: int, long_tokens: int | None) -> DataFrame:
    """A row per line with tokens: doc_id, twin (a hash of the text, which parts rows of one id), pos, tokens, leaf, line_key; with long_tokens long_key, null for other lines.

    A long line's key is its line_key, or a hash of its tokens as they stand if fewer than ``min_kept`` % of them are without digits.
    """
    # Cut before they are exploded, so that no row of a line carries its text.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("twin"), F.split(F.col(text_col), "\n").alias("lines"))
    rows = rows.select("doc_id", "twin", F.posexplode("lines").alias("pos", "line"))
    rows = rows.withColumn("tokens", tokens(F.col("line")))
    plain = F.translate("line", "0123456789", "") == F.col("line")
    fields = F.when(plain, F.col("tokens")).otherwise(F.transform("tokens", generalised))
    rows = rows.withColumn("given", F.col("tokens")).withColumn("tokens", fields).where(F.size("tokens") > 0)
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, leading)).alias("leaf")
    columns = ["doc_id", "twin", "pos", "tokens", leaf, F.xxhash64("tokens").alias("line_key")]
    if long_tokens is not None:
        telling = plain | (F.size(F.array_remove("tokens", FIELD)) * 100 >= F.size("tokens") * min_kept)
        own = F.when(telling, F.xxhash64("tokens")).otherwise(F.xxhash64("given"))
        columns.append(F.when(F.size("tokens") > long_tokens, own).alias("long_key"))
    return rows.select(*columns)


def _long_lines(places: DataFrame) -> DataFrame:
    """Occurrences of long lines that two documents or more have, but the first of each: doc_id, twin, pos."""
    at = places.where(F.col("long_key").isNotNull()).select("long_key", "doc_id", "twin", "pos")
    per_doc = at.groupBy("long_key", "doc_id", "twin").agg(F.min("pos").alias("pos"))
    common = per_doc.groupBy("long_key").agg(F.count("*").alias("docs"), F.min(F.struct("doc_id", "twin", "pos")).alias("first")).where("docs > 1")
    found = at.join(stage(common.drop("docs"), "long_lines"), "long_key")
    return found.where(~F.struct("doc_id", "twin", "pos").eqNullSafe(F.col("first"))).select("doc_id", "twin", "pos")


def recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, leading: int = LEADING, min_kept: int = MIN_KEPT, long_tokens: int | None = None) -> DataFrame:
    """Occurrences to drop: doc_id, twin, pos. See ``dedup``."""
    lines = _occurrences(docs, id_col, text_col, leading, min_kept, long_tokens)
    every = stage(lines.drop("tokens"), "lines")
    places = every.drop("long_key")
    docs_of = lambda keys: places.groupBy(*keys, "doc_id", "twin").agg(F.lit(1).alias("one")).groupBy(*keys).agg(F.sum("one").alias("docs"))
    # Right sides of joins with hot keys are staged, which leaves Spark free to split the left sides.
    leaves = stage(docs_of(["leaf"]).where(F.col("docs") >= min_docs).select("leaf"), "leaves")
    places = stage(places.join(leaves, "leaf"), "leaf_lines")
    per_line = docs_of(["leaf", "line_key"])

    # The distinct lines of those leaves, with their tokens; each comes from the first document that has it.
    one = places.groupBy("leaf", "line_key").agg(F.min(F.struct("doc_id", "twin", "pos")).alias("at")).select("leaf", "line_key", "at.*")
    wanted = one.groupBy("doc_id", "twin").agg(F.collect_list(F.struct("pos", "leaf", "line_key")).alias("picks"))
    # Lines are cut below the join: each pick reads its own by position, and only that goes on.
    texts = docs.select(F.col(id_col).alias("id"), F.split(F.col(text_col), "\n").alias("all"), F.xxhash64(text_col).alias("twin"))
    held = texts.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (texts["twin"] == wanted["twin"]))
    held = held.select(F.explode(F.transform("picks", lambda p: F.struct(p["leaf"].alias("leaf"), p["line_key"].alias("line_key"), F.get("all", p["pos"]).alias("line")))).alias("pick"))
    distinct = held.select("pick.leaf", "pick.line_key", F.transform(tokens(F.col("pick.line")), generalised).alias("tokens"))
    distinct = stage(distinct.dropDuplicates(["leaf", "line_key"]).join(per_line, ["leaf", "line_key"]), "distinct_lines")

    # A token stays where enough documents of its leaf have it in its place; what varies becomes a field.
    spots = distinct.select("leaf", "line_key", "docs", F.posexplode("tokens").alias("spot", "token"))
    votes = spots.groupBy("leaf", "spot", "token").agg(F.sum("docs").alias("votes"))
    voted = spots.where(F.col("spot") >= leading).join(votes, ["leaf", "spot", "token"])
    kept = F.when(F.col("votes") >= min_docs, F.col("token")).otherwise(F.lit(FIELD))
    rest = voted.groupBy("leaf", "line_key").agg(F.array_sort(F.collect_list(F.struct("spot", kept.alias("token"), (F.col("votes") >= min_docs).alias("stays")))).alias("rest"))
    lines_of = distinct.join(rest, ["leaf", "line_key"], "left")
    n_kept = F.least(F.size("tokens"), F.lit(leading)) + F.coalesce(F.size(F.filter("rest", lambda x: x["stays"])), F.lit(0))
    parsed = F.concat(F.slice("tokens", 1, leading), F.coalesce(F.transform("rest", lambda x: x["token"]), F.array().cast("array<string>")))
    template = F.when(n_kept * 100 >= F.size("tokens") * min_kept, parsed).otherwise(F.col("tokens"))
    templates = stage(lines_of.select("leaf", "line_key", F.xxhash64("leaf", template).alias("template")), "templates")

    at = stage(places.join(templates, ["leaf", "line_key"]).select("template", "doc_id", "twin", "pos"), "template_lines")
    per_doc = at.groupBy("template", "doc_id", "twin").agg(F.min("pos").alias("pos"))
    common = per_doc.groupBy("template").agg(F.count("*").alias("docs"), F.min(F.struct("doc_id", "twin", "pos")).alias("first")).where(F.col("docs") >= min_docs)
    found = at.join(stage(common, "templates_to_drop"), "template")
    found = found.where(~F.struct("doc_id", "twin", "pos").eqNullSafe(F.col("first"))).select("doc_id", "twin", "pos")
    return found if long_tokens is None else found.unionByName(_long_lines(every))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, leading: int = LEADING, min_kept: int = MIN_KEPT, long_tokens: int | None = None) -> DataFrame:
    """``docs`` without lines of templates that recur across documents; adds n_lines and n_dropped.

    The tree has a fixed depth: a line goes by its number of tokens, then by its leading tokens, to a leaf.
    Tokens with digits are variable fields from the start. In a leaf, a token that fewer than ``min_docs`` documents have
    in its place becomes a field too; a line that would keep less than ``min_kept`` % of its tokens stays
    as it is. Lines of the same leaf and tokens share a template. A template found in ``min_docs``
    documents or more is dropped everywhere but where it occurs first (smallest id, then first line), so
    nothing is lost altogether: of exact copies one keeps its lines.

    With ``long_tokens``, a line of more tokens is also dropped where it recurs as it stands, but for tokens with digits, in two
    documents or more, everywhere but where it occurs first. If such tokens are over 100 - ``min_kept`` % of the line, they count too.

    Scale: lines are told by hashes; only the distinct lines of leaves with enough documents are looked at token by token. Texts
    are shuffled twice, by document: to fetch those lines, and to leave out what goes. Counts are combined before each shuffle,
    and hot templates only meet tables with one row per template.

    A very long text is never beside the rows of its lines, and work on it grows with its lines alone.

    Null text: stays null, with 0 lines. Empty or blank lines are never dropped. Repeated rows are one document here, all treated alike.
    Null ids are kept. Columns named n_lines or n_dropped are replaced, others of any name kept. An empty table gives no rows.
    """
    drops = recurring(docs, id_col, text_col, min_docs, leading, min_kept, long_tokens)
    of_id, of_twin, at, lines, twin = spare(docs, "drop_id", "drop_twin", "drop_pos", "doc_lines", "doc_twin")
    drops = stage(drops.groupBy(F.col("doc_id").alias(of_id), F.col("twin").alias(of_twin)).agg(F.collect_set("pos").alias(at)), "drops")
    # The lines go through the join in place of the text, which they give again; what stays is a difference of sets of positions.
    cut = docs.withColumns({lines: F.split(F.col(text_col), "\n"), twin: F.xxhash64(text_col)}).drop(text_col)
    joined = cut.join(drops, F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(twin) == F.col(of_twin)), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(at))
    left = F.when(F.col(at).isNull(), F.array_join(lines, "\n")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n"))
    n_lines = F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_dropped = F.coalesce(F.size(at), F.lit(0)).cast("long")
    values = {"n_lines": n_lines, "n_dropped": n_dropped, text_col: left}
    new = [c for c in ("n_lines", "n_dropped") if c not in docs.columns]
    return joined.withColumns(values).select(*[F.col(f"`{c}`") for c in docs.columns], *new)


#: What is left of each document, with long lines dropped too, in DuckDB.
SQL = r"""
WITH base AS (SELECT doc_id, text, dense_rank() OVER (ORDER BY doc_id, text) AS row_id FROM documents),
split AS (
  SELECT row_id, doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM (SELECT DISTINCT * FROM base WHERE text IS NOT NULL)),
lines AS (
  SELECT * FROM (
    SELECT row_id, doc_id, pos, given, list_transform(given, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS tokens
    FROM (SELECT row_id, doc_id, pos, list_filter(string_split(line, ' '), lambda x: x <> '') AS given FROM split)) WHERE len(tokens) > 0),
long_lines AS (
  SELECT row_id, doc_id, pos, CASE WHEN given = tokens OR len(list_filter(tokens, lambda x: x <> '<*>')) * 100 >= len(tokens) * 70 THEN tokens ELSE given END AS long_key
  FROM lines WHERE len(tokens) > 20),
long_common AS (
  SELECT long_key, min({'d': doc_id, 'r': row_id, 'p': pos}) AS first FROM long_lines GROUP BY long_key HAVING count(DISTINCT row_id) >= 2),
leaved AS (SELECT *, len(tokens) AS n, tokens[1:3] AS lead FROM lines),
leaves AS (SELECT n, lead FROM leaved GROUP BY n, lead HAVING count(DISTINCT row_id) >= 5),
held AS (SELECT leaved.* FROM leaved JOIN leaves USING (n, lead)),
distinct_lines AS (SELECT tokens, n, lead, count(DISTINCT row_id) AS docs FROM held GROUP BY tokens, n, lead),
spots AS (SELECT tokens, n, lead, docs, unnest(range(n)) AS spot, unnest(tokens) AS token FROM distinct_lines),
votes AS (SELECT n, lead, spot, token, sum(docs) AS votes FROM spots GROUP BY n, lead, spot, token),
voted AS (
  SELECT tokens, list(CASE WHEN spot < 3 OR votes >= 5 THEN token ELSE '<*>' END ORDER BY spot) AS parsed,
         sum(CASE WHEN spot < 3 OR votes >= 5 THEN 1 ELSE 0 END) AS kept
  FROM spots JOIN votes USING (n, lead, spot, token) GROUP BY tokens),
templates AS (SELECT tokens, CASE WHEN kept * 100 >= len(tokens) * 70 THEN parsed ELSE tokens END AS template FROM voted),
placed AS (SELECT row_id, doc_id, pos, template FROM held JOIN templates USING (tokens)),
common AS (
  SELECT template, min({'d': doc_id, 'r': row_id, 'p': pos}) AS first FROM placed GROUP BY template HAVING count(DISTINCT row_id) >= 5),
drops AS (
  SELECT row_id, pos FROM placed JOIN common USING (template) WHERE {'d': doc_id, 'r': row_id, 'p': pos} <> first
  UNION SELECT row_id, pos FROM long_lines JOIN long_common USING (long_key) WHERE {'d': doc_id, 'r': row_id, 'p': pos} <> first),
kept AS (
  SELECT s.row_id, string_agg(line, chr(10) ORDER BY s.pos) AS text FROM split s ANTI JOIN drops d ON s.row_id = d.row_id AND s.pos = d.pos GROUP BY s.row_id),
dropped AS (SELECT row_id, count(*) AS n_dropped FROM drops GROUP BY row_id)
SELECT r.doc_id, CAST(coalesce(len(string_split(r.text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN r.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS kept_md5
FROM base r LEFT JOIN kept k USING (row_id) LEFT JOIN dropped USING (row_id)
"""
