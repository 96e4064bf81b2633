"""The operators as queries over the tables at hand, and SQL that says the same to another engine.

Each SQL text is written by itself, not derived from the expression it checks; the two share only the rendered input
and the lists of names that are part of the format."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import tokenize
from ..functions import lines, markup, metadata, nesting
from ..functions.batches import by_slices
from ..operators import abbreviations, dictionary, lattice, splitting
from ..operators import pages as ops
from ..operators.script import Converter
from ..options import Options
from ..sources import dump, listing
from ..sources.scratch import written
from ..wikitext import clean
from ..wikitext.clean import DISCARDED, IGNORED, PROTOCOLS, SELF_CLOSING, SWITCHES
from ..wikitext.spans import drop_nested
from . import extract as extraction
from . import snapshots
from .rendered import pages, pages_sql, parts

OPTIONS = Options(as_of=datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc))
BASE = "https://wiki.example/wiki"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(text: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(by)}, '{flags}')"


def swap(text: str, *pairs: tuple[str, str]) -> str:
    for a, b in pairs:
        text = f"replace({text}, {lit(a)}, {lit(b)})"
    return text


def column_query(name: str, change, *more: str):
    """id and one changed column of the rendered pages."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pages(spark, sf_dir, "id", name, *more).select("id", change(F.col(name)).alias("out"))

    return run


def kernel_query(name: str, change, *more: str):
    """The same by the text kernel, which is what an extraction runs; its SQL is that of the native expression."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        function = F.pandas_udf(lambda texts: texts.map(change), "string")
        return pages(spark, sf_dir, "id", name, *more).select("id", function(name).alias("out"))

    return run


#: Entities of the given pages and rendered texts; & last, so that nothing is decoded twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def column_sql(name: str, out: str, *more: str) -> str:
    return f"SELECT id, {out} AS out FROM {pages_sql('id', name, *more)} t"


def joined(found) -> F.Column:
    return F.array_join(found, "|")


# --- pages of the web ---


def html_text(html):
    text = markup.without_elements(markup.without_tags(markup.without_comments(html)))
    for tag in ("script", "style", "nav", "title"):
        text = F.regexp_replace(text, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ")
    text = markup.unescape(markup.strip_tags(text))
    return F.trim(F.regexp_replace(text, r"[ \t\n\r]+", " "))


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", html_text(F.col("html")).alias("text"))


def _html_sql() -> str:
    tags = "|".join([*IGNORED, "a"])
    text = sub("html", "<!--.*?-->", "", "gs")
    text = sub(text, rf"<\s*(?:{'|'.join(SELF_CLOSING)})\b[^>]*/\s*>|<(?:{tags})\b.*?>|</\s*(?:{tags})>", "", "gis")
    for tag in DISCARDED:
        text = sub(text, rf"<\s*{tag}\b[^>/]*>.*?<\s*/\s*{tag}>", "", "gis")
    for tag in ("script", "style", "nav", "title"):
        text = sub(text, rf"<{tag}\b[^>]*>.*?</{tag}>", " ", "gis")
    text = swap(sub(text, "<[^>]*>", ""), *ENTITIES)
    return f"trim({sub(text, '[ \t\n\r]+', ' ')})"


def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit(r"&#?(\w+);"), F.lit(1))
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.explode(found).alias("entity")).groupBy("entity").agg(F.count("*").alias("n"))


# --- the pass over lines ---


def line_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir, "id", "sections").select("id", F.array_join(lines.compact(F.col("sections")), "\n").alias("out"))


LINES_SQL = f"""
WITH l AS (SELECT id, unnest(string_split(sections, chr(10))) AS line, generate_subscripts(string_split(sections, chr(10)), 1) AS n FROM {pages_sql("id", "sections")} t),
k AS (SELECT *, CASE WHEN regexp_matches(line, '^==.*==') THEN 'H' WHEN starts_with(line, '++') THEN 'T' WHEN line[1] = ':' THEN 'D'
        WHEN line[1] IN ('*', '#', ';') THEN 'L' ELSE 'P' END AS kind,
      line[1] IN ('{{', '|') OR line[-1] = '}}' OR (line[1] = '(' AND line[-1] = ')') OR regexp_full_match(line, '[.-]+') AS resid FROM l WHERE line <> ''),
s AS (SELECT *, kind = 'P' AND coalesce(lag(CASE WHEN kind IN ('H', 'L', 'P') THEN kind END IGNORE NULLS) OVER w, '') = 'L' AS in_list FROM k WINDOW w AS (PARTITION BY id ORDER BY n)),
p AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'H' OR (kind = 'P' AND NOT in_list AND NOT resid) THEN kind END IGNORE NULLS)
        OVER (PARTITION BY id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') = 'H' AS pending FROM s),
o AS (SELECT id, n, CASE WHEN kind = 'T' THEN regexp_replace(substr(line, 3, length(line) - 4), '([^!?])$', '\\1.') ELSE line END AS line FROM p
      WHERE kind = 'T' OR (kind = 'P' AND (in_list OR (NOT resid AND (pending OR line[1] <> ' ')))))
SELECT id, string_agg(line, chr(10) ORDER BY n) AS out FROM o GROUP BY id
"""


# --- templates ---


def template_define(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions of template pages, of equal titles the last."""
    raw = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "p_partkey AS position", "p_name AS title", "'10' AS ns", *[f"{e} AS text" for e in [_expression("template")]]
    )
    return ops.define_templates(raw)[0]


def _expression(name: str) -> str:
    from .rendered import PAGE

    return PAGE[name]


def _define_sql() -> str:
    text = swap(_expression("template"), *ENTITIES)
    text = sub(sub(text, "<!--.*?-->", "", "gs"), "<noinclude>.*?</noinclude>", "", "gs")
    text = swap(sub(text, r"<noinclude\s*>.*$", "", "gs"), ("<noinclude/>", ""))
    only = "array_to_string(regexp_extract_all(b, '<onlyinclude>(.*?)</onlyinclude>', 1), '')"
    body = f"CASE WHEN {only} <> '' THEN {only} ELSE regexp_replace(b, '</?includeonly>', '', 'g') END"
    inner = f"SELECT p_name AS title, p_partkey AS position, {text} AS b FROM part"
    return f"SELECT title, {body} AS body FROM ({inner}) t QUALIFY row_number() OVER (PARTITION BY title ORDER BY position DESC) = 1"


def template_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("concat('Template:Infobox ', p_brand) AS title").distinct().where("title not like '%1'")
    return ops.template_usage(pages(spark, sf_dir, "text"), names)


USAGE_SQL = f"""
WITH c AS (SELECT trim(unnest(regexp_extract_all(text, '\\{{\\{{([^{{}}|:#]+)', 1))) AS name FROM {pages_sql("text")} t),
u AS (SELECT concat('Template:', upper(name[1]), substr(name, 2)) AS title, count(*) AS calls FROM c GROUP BY 1),
d AS (SELECT DISTINCT concat('Template:Infobox ', p_brand) AS title FROM part WHERE p_brand NOT LIKE '%1')
SELECT u.title, calls, d.title IS NOT NULL AS defined FROM u LEFT JOIN d USING (title)
"""


#: Template pages that call others: half the number, the next one, themselves; every ninth redirects.
CALLING = """case when p_partkey % 9 = 0 then concat('#REDIRECT [[Template:T', cast(p_partkey div 3 as string), ']]')
  else concat('{{t', cast(p_partkey div 2 as string), '|a}} ', case when p_partkey % 5 = 0 then concat('{{ subst:T', cast(p_partkey + 1 as string), ' }}') else '' end,
  case when p_partkey % 35 = 1 then concat('{{T', cast(p_partkey - 1 as string), '|{{#if:x|{{T', cast(p_partkey as string), '}}}}}}') else '{{{1|}}}' end) end"""


def template_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each template reaches through others and through redirects, and whether that is itself."""
    raw = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey AS position", "concat('Template:T', cast(p_partkey as string)) AS title", "'10' AS ns", f"{CALLING} AS text")
    return dictionary.closure(dictionary.static_calls(dictionary.entries(*ops.define_templates(raw)), "Template"))


CLOSURE_SQL = """WITH RECURSIVE part_ AS (SELECT p_partkey AS p FROM part),
e(a, b) AS (SELECT p, p // 3 FROM part_ WHERE p % 9 = 0 UNION SELECT p, p // 2 FROM part_ WHERE p % 9 <> 0 UNION SELECT p, p + 1 FROM part_ WHERE p % 9 <> 0 AND p % 5 = 0
  UNION SELECT p, p - d FROM part_, (VALUES (0), (1)) t(d) WHERE p % 9 <> 0 AND p % 35 = 1),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT concat('Template:T', CAST(a AS VARCHAR)) AS title, concat('Template:T', CAST(b AS VARCHAR)) AS callee, a IN (SELECT a FROM r WHERE a = b) AS cyclic FROM r"""

#: One template for each brand, whose body calls a name that is made by expansion, one for each kind, and short names that redirect.
BRAND_TEMPLATES = """SELECT DISTINCT 'Template:Brand ' || p_brand AS title, concat('[{{{1}}} of {{Kind {{lc:{{{2}}}}} }}', p_brand, ']') AS body, cast(NULL AS string) AS dst FROM part
 UNION ALL SELECT DISTINCT 'Template:Kind ' || lower(p_type), concat(p_type, '{{{1|}}} '), NULL FROM part UNION ALL SELECT DISTINCT 'Template:' || p_brand, NULL, 'Template:Brand ' || p_brand FROM part"""


def template_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expansion with a dictionary that is joined: by the calls that the texts show, then by those that expansion asks for."""
    table = parts(spark, sf_dir)
    table.createOrReplaceTempView("__parts")
    held = spark.sql(BRAND_TEMPLATES.replace("FROM part", "FROM __parts"))
    call = "concat('{{', case when p_size % 2 = 0 then 'Brand ' else '' end, p_brand, '|', p_name, '|', p_type, '}}{{Nothing ', p_brand, '}} end')"
    rendered = table.selectExpr("p_partkey AS id", "p_name AS title", f"{call} AS text")
    done = extraction.by_rounds(rendered, extraction.Large(extraction.Site(), held), OPTIONS)
    return done.select("id", F.col("outcome.text").alias("out"))


ROUNDS_SQL = "SELECT p_partkey AS id, concat('[', p_name, ' of ', p_type, ' ', p_brand, '] end', chr(10)) AS out FROM part"


#: The same templates later: every kind whose name has an even number of letters has another body.
LATER_TEMPLATES = BRAND_TEMPLATES.replace("concat(p_type, '{{{1|}}} ')", "concat(p_type, case when length(p_type) % 2 = 0 then '! ' else '{{{1|}}} ' end)")


def changed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of pages whose templates' names are made by expansion: in the second every tenth page and some
    templates are others, and only the pages that these concern run."""
    table = parts(spark, sf_dir)
    table.createOrReplaceTempView("__parts")

    def snapshot(text: str, templates: str, before=None):
        defined = spark.sql(templates.replace("FROM part", "FROM __parts")).selectExpr("0 AS position", "title", "'10' AS ns", "coalesce(body, concat('#REDIRECT [[', dst, ']]')) AS text")
        called = table.selectExpr("cast(p_partkey as string) AS id", "p_name AS title", "'0' AS ns", f"concat('{{{{', p_brand, '|', {text}, '|', p_type, '}}}} end') AS text")
        return snapshots.take(called, OPTIONS, None, defined, before)

    rows, entries = snapshot("p_name", BRAND_TEMPLATES)
    out, _ = snapshot("case when p_partkey % 10 = 0 then concat('new ', p_name) else p_name end", LATER_TEMPLATES, (written(rows, "rows"), entries))
    return out.select("id", "text", "fresh")


CHANGED_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS id, concat('[', CASE WHEN p_partkey % 10 = 0 THEN 'new ' ELSE '' END, p_name, ' of ', p_type, CASE WHEN length(p_type) % 2 = 0 THEN '!' ELSE '' END, ' ', p_brand, '] end', chr(10)) AS text,
 p_partkey % 10 = 0 OR length(p_type) % 2 = 0 AS fresh FROM part"""

#: Bytes of a file, and of a block of offsets, of the query below.
SPLIT_MOST, SPLIT_BLOCK = 64 << 10, 1 << 20


def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file, of at most 64 KiB, in which one writer of all texts in the order of their ids would put each as a line."""
    lines = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("key"), F.monotonically_increasing_id().alias("n"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"))
    held = written(lines, "lines")
    numbers = splitting.file_numbers(held, SPLIT_MOST, SPLIT_BLOCK)
    return numbers.join(held, "n").select(F.col("key").alias("doc_id"), "file", F.concat_ws("/", splitting.folder_name("file"), splitting.base_name("file")).alias("name"))


SPLIT_SQL = f"""WITH RECURSIVE s AS (SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size FROM documents),
p AS (SELECT doc_id, CAST(sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e, size FROM s),
o AS (SELECT doc_id, e - size AS g, max(e) OVER (ORDER BY e RANGE BETWEEN CURRENT ROW AND greatest({SPLIT_MOST} - size, 0) FOLLOWING) AS nxt FROM p),
t AS MATERIALIZED (SELECT g, nxt FROM o),
f(g, n) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT) UNION ALL SELECT t.nxt, n + 1 FROM f JOIN t ON f.g = t.g)
SELECT doc_id, n AS file, concat(chr(CAST(65 + n // 2600 % 26 AS INTEGER)), chr(CAST(65 + n // 100 % 26 AS INTEGER)), '/wiki_', lpad(CAST(n % 100 AS VARCHAR), 2, '0')) AS name
FROM o ASOF JOIN f ON o.g >= f.g"""


# --- the grammar that needs a stack ---


def kernel(make) -> object:
    """A query of the text function over rendered wikitext."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = parts(spark, sf_dir).selectExpr("p_partkey AS id", "p_name AS title", f"{make} AS text")
        bodies = {"Template:Box": "[{{{1|none}}}/{{{size|{{{2|}}}}}}]", "Template:Twice": "{{Box|{{{1}}}}}{{box|size={{{1}}}}}", "Template:Convert": "{{#invoke:convert|convert}}"}
        site = extraction.Site(bodies, {"Template:Alias": "Template:Box"})
        done = table.select("id", extraction.text_function(site, OPTIONS)("title", "text").alias("r"))
        return done.select("id", F.col("r.text").alias("out"))

    return run


NESTED_LINK = "concat('See [[File:', p_brand, '.png|thumb|a [[', p_type, '|', lower(p_type), ' one]] here]]; [[', p_name, ' (x)|the ', p_name, ']]s [[:w:', p_brand, ']].')"


def internal_links_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links inside links, one to a line that ends, natively."""
    rendered = parts(spark, sf_dir).selectExpr("p_partkey AS id", f"{NESTED_LINK} AS text")
    return rendered.select("id", F.concat(nesting.internal_links(F.col("text")), F.lit("\n")).alias("out"))


NESTED_LINK_SQL = "SELECT p_partkey AS id, concat('See ; the_', replace(p_name, ' ', '_'), 's :w:', p_brand, '.', chr(10)) AS out FROM part"
EXPAND = "concat('A {{Twice|', p_name, '}} {{Box}} {{box|a|', p_type, '}} {{Unknown|{{Box}}}} {{PAGENAME}} {{CURRENTYEAR}}.')"
EXPAND_SQL = "SELECT p_partkey AS id, concat('A [', p_name, '/][none/', p_name, '] [none/] [a/', p_type, '] ', p_name, ' 2024.', chr(10)) AS out FROM part"
FUNCTIONS = (
    "concat('{{uc:', p_name, '}} {{ucfirst:', p_name, '}} {{#if: ', case when p_size % 2 = 0 then 'x' else '' end, ' | even | odd }} {{#ifeq: ', p_type, ' | ECONOMY | yes | no }} ',"
    " '{{#switch: ', p_type, ' | ECONOMY | SMALL = low | STANDARD = mid | #default = other }} {{#expr: ', cast(p_size as string), ' * 2 + 1}} {{int: ', cast(p_size as string), ' }} {{#time: Y}}end')"
)
FUNCTIONS_SQL = """SELECT p_partkey AS id, concat(upper(p_name), ' ', upper(p_name[1]), substr(p_name, 2), ' ', CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END, ' ',
 CASE WHEN p_type = 'ECONOMY' THEN 'yes' ELSE 'no' END, ' ', CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'low' WHEN p_type = 'STANDARD' THEN 'mid' ELSE 'other' END,
 ' ', CAST(p_size * 2 + 1 AS VARCHAR), ' ', CAST(p_size AS VARCHAR), ' end', chr(10)) AS out FROM part"""
SECTIONS = "concat('== ', p_name, ' ==', chr(10), '* {{lc:', p_type, '}}', chr(10), p_brand, ' has 1,234,567 parts.', chr(10), '&lt;math&gt;', p_name, '&lt;/math&gt; &lt;ref&gt;gone&lt;/ref&gt;(c)')"
SECTIONS_SQL = "SELECT p_partkey AS id, concat(p_brand, ' has 1234567 parts.', chr(10), 'formula_1 (c)', chr(10)) AS out FROM part"


MODULES = "concat('{{Alias|', p_name, '}} {{convert|', cast(p_size as string), '|km}} {{#iferror: {{#expr: 1 + }} | bad | good }} {{#iferror: {{#expr: 2 * 3 }} | bad }} {{#invoke:nothing|here}}{{lcfirst:', p_name, '}} a{{!}}b {{lc:', p_type, '}}.')"
MODULES_SQL = """SELECT p_partkey AS id, concat('[', p_name, '/] ', CAST(p_size AS VARCHAR), ' km bad 6 ', lower(p_name[1]), substr(p_name, 2), ' a|b ', lower(p_type), '.', chr(10)) AS out FROM part"""


def words_sql(text: str) -> str:
    """Tokens of the rules, for an engine without looks ahead or behind: a mark stands for the full stop of an abbreviation."""
    spaced = sub(sub(text, r"([\p{L}\p{N}_])('(?:s|m|d|re|ve|ll))\b", r"\1 \2", "gi"), r"(n't)\b", r" \1", "gi")
    marked = sub(spaced, r"([\p{L}\p{N}_])\.([^\s\p{L}\p{N}_])", "\\1\u241f\\2")
    word = "[\\p{L}\\p{N}_]+"
    found = f"regexp_extract_all({marked}, {lit(rf"(?i)\.\.\.|--|n't\b|'(?:s|m|d|re|ve|ll)\b|\d+(?:[.,]\d+)*|{word}(?:[-'.]{word})*{chr(0x241F)}?|[^\p{{L}}\p{{N}}_\s]")})"
    return f"list_transform({found}, lambda w: replace(w, {lit(chr(0x241F))}, '.'))"


def rule_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens that an extraction gives for English and Indonesian, by the rules that are built in."""
    found = by_slices(lambda texts: texts.map(lambda t: [w for line in (t or "").strip().split("\n") for w in tokenize.rule_words(line)]), "array<string>")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", found("text").alias("w"))
    return docs.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", "|").cast("binary")).alias("tokens_md5"))


def abbreviation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihood ratios of all words of the documents that stand before a full stop."""
    return abbreviations.scores(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("score", F.round("score", 6) + 0.0)


def abbreviation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, stops apart but for the abbreviations that the documents themselves show."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = abbreviation_scores(spark, sf_dir).where(F.col("score") >= ABBREVIATION)
    done = abbreviations.tokenised(docs.select("doc_id", "text"), known, "doc_id")
    return done.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", "|").cast("binary")).alias("tokens_md5"))


#: Least score of an abbreviation. The documents are invented words with few of them; this low, some stand out.
ABBREVIATION = 0.05

SCORES_SQL = r"""SELECT word, n, n_stop, round(2 * (n_stop * ln(0.99) + (n - n_stop) * ln(1 - 0.99) - n_stop * ln(s) - (n - n_stop) * ln(1 - s)) * exp(-l) * (length(word) - l + 1) * pow(l, n_stop - n), 6) + 0.0 AS score
 FROM (SELECT *, sum(n_stop) OVER () / sum(n) OVER () AS s, length(replace(word, '.', '')) AS l FROM (
  SELECT lower(regexp_replace(w, '\.$', '')) AS word, count(*) AS n, count(*) FILTER (ends_with(w, '.')) AS n_stop
  FROM (SELECT unnest(regexp_extract_all(text, '\p{L}+(?:\.\p{L}+)*\.?')) AS w FROM documents) t GROUP BY 1) u) v WHERE n_stop > 0"""

STOPS_SQL = f"""WITH a AS (SELECT list(word) AS known FROM (SELECT word FROM ({SCORES_SQL}) t WHERE score >= {ABBREVIATION}) t),
w AS (SELECT doc_id, regexp_extract_all(text, '\\p{{L}}+(?:\\.\\p{{L}}+)*\\.?') AS w FROM documents),
k AS (SELECT doc_id, flatten(list_transform(w, lambda x: CASE WHEN ends_with(x, '.') AND NOT coalesce(list_contains(known, lower(x[1:length(x) - 1])), false) THEN [x[1:length(x) - 1], '.'] ELSE [x] END)) AS w FROM w, a)
SELECT doc_id, len(w) AS n_tokens, md5(array_to_string(w, '|')) AS tokens_md5 FROM k"""


#: Phrases to convert, one inside another, made of the brands and kinds of the parts.
PHRASES = """SELECT DISTINCT p_brand AS src, concat('<', p_brand, '>') AS dst FROM part UNION SELECT DISTINCT p_type, lower(p_type) FROM part
 UNION SELECT DISTINCT concat(p_brand, ' ', p_type), concat(p_type, ' of ', p_brand) FROM part"""


def script_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and texts converted by a table of phrases, the longest one first."""
    table = parts(spark, sf_dir)
    table.createOrReplaceTempView("__parts")
    by = Converter.read(spark.sql(PHRASES.replace("FROM part", "FROM __parts")))
    rendered = table.selectExpr("p_partkey AS id", "concat(p_brand, ' ', p_type, ' or ', p_type, ' ', p_brand, p_type, p_name) AS text")
    return rendered.select("id", by.column("text").alias("out"))


SCRIPT_SQL = "SELECT p_partkey AS id, concat(p_type, ' of ', p_brand, ' or ', lower(p_type), ' <', p_brand, '>', lower(p_type), p_name) AS out FROM part"


#: How the lexicon of lattice_words is learned.
LATTICE = {"longest": 6, "least": 5, "most": 20_000, "rounds": 3}


def lattice_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, found again after their spaces are gone: runs of letters, cut by a lexicon that is
    learned from them. Iteration is not expressible in SQL."""
    joined = F.lower(F.coalesce("text", F.lit("")))
    for blank in " \t":
        joined = F.replace(joined, F.lit(blank), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", joined.alias("text"))
    lexicon = lattice.learn(docs, pattern=r"\p{L}+", **LATTICE)
    done = docs.select("doc_id", lattice.segmented(lexicon, pattern=r"[^\W\d_]+").alias("w"))
    return done.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", "|").cast("binary")).alias("tokens_md5"))


def _extract_sql() -> str:
    """Records of the rendered pages, line by line in closed form."""
    under = lambda x: f"replace({x}, ' ', '_')"
    text = f"""concat(p_name, ' is a ', {under("lower(p_type)")}, '_parts of ', {under("p_brand")}, ', see and w:', {under("p_name")}, '.', chr(10),
        'Sold ', CAST(p_size % 90 + 1 AS VARCHAR), lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0'), ' and 12', lpad(CAST(p_size AS VARCHAR), 3, '0'), ' times; called "', p_brand, '" or "', p_name, '"...', chr(10),
        'Price about ', CAST(p_size AS VARCHAR), ' coins, or . ', chr(10), 'formula_1 and formula_2 & bold <', chr(10))"""
    category = "lower(title[1:9]) = 'category:'"
    return f"""SELECT CASE WHEN {category} THEN substr(title, 10) ELSE title END AS title, id, concat('{BASE}?curid=', id) AS url, out AS text,
        array_to_string(list_sort([concat(p_brand), p_type]), '|') AS related, {category} AS "isCategory", CASE WHEN {category} THEN p_name ELSE '' END AS "mainArticle",
        NOT {category} AS "isArticle", concat(p_brand, '|', p_type) AS categories, array_to_string({words_sql("out")}, '|') AS segment_text
        FROM (SELECT *, {text} AS out FROM (SELECT part.*, t.* FROM part JOIN {pages_sql("id", "title", "ns")} t ON CAST(p_partkey AS VARCHAR) = t.id WHERE t.ns NOT IN ('10', '828')) u) v"""


# --- acquisition ---

LISTING = (
    "concat('<a href=\"enwiki-latest-pages-articles', case when o_orderkey % 10 = 0 then '1' else cast(o_orderkey % 30 + 1 as string) end, '.xml-p', cast(o_orderkey as string),"
    " '.bz2\">x</a>   0', cast(o_orderkey % 9 + 1 as string), '-Jan-2024 10:', lpad(cast(o_orderkey % 60 as string), 2, '0'), '   ', cast(o_orderkey * 137 as string), chr(10))"
)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(f"{LISTING} AS html", f"'{BASE}/' AS base", "concat('l', cast(o_orderkey % 4 as string)) AS lang")
    return listing.parse_listing(html)


LISTING_SQL = f"""SELECT concat('{BASE}/', f) AS url, lang, strptime(d, '%d-%b-%Y %H:%M') AS date, size, concat(lang, '/', f) AS path, f AS filename FROM (
 SELECT concat('l', CAST(o_orderkey % 4 AS VARCHAR)) AS lang, o_orderkey * 137 AS size,
  concat('0', CAST(o_orderkey % 9 + 1 AS VARCHAR), '-Jan-2024 10:', lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')) AS d,
  concat('enwiki-latest-pages-articles', CASE WHEN o_orderkey % 10 = 0 THEN '1' ELSE CAST(o_orderkey % 30 + 1 AS VARCHAR) END, '.xml-p', CAST(o_orderkey AS VARCHAR), '.bz2') AS f FROM orders) t"""


def dump_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm"))


def small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.worth_fetching(_listing(spark, sf_dir)).select("filename", "size")


def part_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.part_numbers(_listing(spark, sf_dir)).select("lang", "filename", "number")


PARTS_SQL = f"""WITH r AS ({LISTING_SQL}), n AS (SELECT *, regexp_extract(filename, 'articles(\\d+).xml', 1) AS k FROM r),
m AS (SELECT *, row_number() OVER (PARTITION BY lang, k ORDER BY size DESC, filename) - 1 AS j FROM n)
SELECT lang, filename, concat(k, CASE WHEN j > 0 THEN concat('-', CAST(j AS VARCHAR)) ELSE '' END) AS number FROM m"""


def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote = _listing(spark, sf_dir)
    there = remote.where("size % 3 <> 0").withColumn("size", F.when(F.col("size") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return listing.to_fetch(remote, there).select("path", "size")


# --- filters of pages ---


def _raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "concat('file', cast(user_id % 5 as string)) AS path", "event_id AS position", "cast(event_id div 3 as string) AS id", "event_type AS title",
        "case when event_id % 9 = 1 then '10' when event_id % 9 = 2 then '828' else '0' end AS ns", "event_id % 4 = 0 AS redirect",
    )


RAW_SQL = """SELECT concat('file', CAST(user_id % 5 AS VARCHAR)) AS path, event_id AS position, CAST(event_id // 3 AS VARCHAR) AS id,
 CASE WHEN event_id % 9 = 1 THEN '10' WHEN event_id % 9 = 2 THEN '828' ELSE '0' END AS ns, event_id % 4 = 0 AS redirect FROM events"""


def redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.without_redirects(_raw_pages(spark, sf_dir)).select("position", "id")


def ns_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.articles(_raw_pages(spark, sf_dir)).select("position", "ns")


def dedupe_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.without_repeats(ops.without_redirects(_raw_pages(spark, sf_dir))).select("path", "position", "id")


def dump_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered pages as dump chunks, read back by the chunk parser."""
    xml = F.concat(F.lit("<mediawiki> <page>\n<title>"), "title", F.lit("</title>\n<ns>"), "ns", F.lit("</ns>\n<id>"), "id", F.lit("</id>\n<revision><id>9</id><text bytes=\"1\">"), "text", F.lit("</text></revision>"))
    return dump.parse_chunks(pages(spark, sf_dir, "id", "title", "ns", "text").select(xml.alias("value"))).select("id", "title", "ns", "text")


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, x = F.col("title"), F.col("text")
    return pages(spark, sf_dir, "id", "title", "text").select(
        "id", metadata.page_url(BASE, F.col("id")).alias("url"), metadata.bare_title(t).alias("title"), metadata.is_category(t).alias("is_category"), (~metadata.is_category(t)).alias("is_article")
    )


def main_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir, "id", "title", "text").select("id", metadata.main_article(F.col("title"), F.col("text")).alias("out"))


def documents_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", lines.words(F.col("text")).alias("w")).select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", "|").cast("binary")).alias("tokens_md5"))


def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records of the rendered pages: metadata, text and tokens."""
    raw = pages(spark, sf_dir, "id", "title", "ns", "text")
    site = {"urlbase": BASE, "namespaces": ["Template"], "template": "Template", "module": "Module"}
    done = extraction.extract(ops.articles(raw), OPTIONS, site)
    return done.withColumns({c: F.array_join(c, "|") for c in ("related", "categories", "segment_text")})


PAGE_SQL = pages_sql("id", "title", "text")
PROTOCOL_RE = "|".join(PROTOCOLS)
WORD_RE = r"[\p{L}\p{N}_]+(?:[.'’-][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s]"
INNER = "substr(m, 3, length(m) - 4)"

QUERIES = {
    "html_to_text": html_to_text,
    "entity_counts": entity_counts,
    "line_compact": line_compact,
    "categories": column_query("text", lambda t: joined(metadata.categories(t))),
    "related_links": column_query("text", lambda t: joined(metadata.related(t))),
    "page_metadata": page_metadata,
    "main_article": main_article,
    "external_links": column_query("text", markup.external_links),
    "internal_links_flat": column_query("text", markup.internal_links),
    "bold_italic": column_query("text", markup.quotes),
    "magic_switches": column_query("text", markup.switches),
    "late_switches": column_query("marks", lambda t: markup.switches(t, late=True)),
    "table_drop_flat": column_query("text", markup.tables),
    "template_drop_flat": column_query("text", markup.templates),
    "placeholders": column_query("text", lambda t: markup.placeholders(markup.unescape(t), "math", "formula")),
    "punct_cleanup": column_query("marks", markup.punctuation),
    "clean_comma": column_query("marks", markup.middle_dots),
    "clean_number": column_query("text", markup.numbers),
    "clean_ref": column_query("marks", markup.left_links),
    "strip_tags": column_query("text", lambda t: markup.strip_tags(markup.unescape(t))),
    "normalize_title": column_query("title", lambda t: metadata.normal_title(t, ["Category", "Template"])),
    "glue_latin": column_query("latin", lines.glue_latin),
    "tokenize_words": documents_words,
    "template_define": template_define,
    "template_usage_join": template_usage,
    "template_closure": template_closure,
    "template_rounds": template_rounds,
    "changed_pages": changed_pages,
    "split_files": split_files,
    "internal_links_nested": internal_links_nested,
    "internal_links_nested_kernel": kernel(NESTED_LINK),
    "template_expand": kernel(EXPAND),
    "parser_functions": kernel(FUNCTIONS),
    "text_pipeline": kernel(SECTIONS),
    "redirect_filter": redirect_filter,
    "ns_filter": ns_filter,
    "dedupe_consecutive": dedupe_consecutive,
    "dump_parse": dump_parse,
    "dump_listing": dump_listing,
    "small_files": small_files,
    "part_numbers": part_numbers,
    "manifest_diff": manifest_diff,
    "extract_pages": extract_pages,
    "unescape": column_query("entities", markup.unescape),
    "unescape_kernel": kernel_query("entities", clean.unescape),
    "unescape_outside_highlight": kernel_query("wrapped", clean.unescape_outside_highlight),
    "clean_template": kernel_query("lefts", clean.left_templates),
    "nested_regions": column_query("nested", lambda t: markup.punctuation(nesting.elements(markup.without_tags(nesting.tables(nesting.templates(t)))))),
    "nested_regions_kernel": kernel_query("nested", lambda t: clean.clean(t, OPTIONS, None)),
    "list_lines": kernel_query("lists", lambda t: "\n".join(clean.compact(t, Options(lists=True, sections=True)))),
    "html_lines": kernel_query("lists", lambda t: "\n".join(clean.compact(t, Options(html=True, sections=True)))),
    "modules_and_redirects": kernel(MODULES),
    "rule_tokens": rule_tokens,
    "lattice_words": lattice_words,
    "script_phrases": script_phrases,
    "abbreviation_scores": abbreviation_scores,
    "abbreviation_tokens": abbreviation_tokens,
    "external_links_kernel": kernel_query("text", lambda t: clean.external_links(t, OPTIONS)),
    "internal_links_kernel": kernel_query("text", lambda t: clean.internal_links(t, OPTIONS)),
    "bold_italic_kernel": kernel_query("text", lambda t: clean.quotes(t, False)),
    "magic_switches_kernel": kernel_query("text", lambda t: clean.SWITCH.sub("", t)),
    "late_switches_kernel": kernel_query("marks", lambda t: clean.LATE_SWITCH.sub("", t)),
    "table_drop_kernel": kernel_query("text", lambda t: drop_nested(t, r"{\|", r"\|}")),
    "template_drop_kernel": kernel_query("text", lambda t: drop_nested(t, "{{", "}}")),
    "placeholders_kernel": kernel_query("text", lambda t: clean.placeholders(clean.unescape(t))),
    "punct_cleanup_kernel": kernel_query("marks", clean.tidy),
    "clean_comma_kernel": kernel_query("marks", clean.middle_dots),
    "clean_number_kernel": kernel_query("text", clean.numbers),
    "clean_ref_kernel": kernel_query("marks", clean.left_links),
    "strip_tags_kernel": kernel_query("text", lambda t: clean.strip_tags(clean.unescape(t))),
    "line_compact_kernel": kernel_query("sections", lambda t: "\n".join(clean.compact(t, OPTIONS))),
    "glue_latin_kernel": kernel_query("latin", tokenize.glue),
}

ORACLES = {
    "html_to_text": f"SELECT page_id, {_html_sql()} AS text FROM pages",
    "entity_counts": "SELECT entity, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '&#?(\\w+);', 1)) AS entity FROM pages) t GROUP BY entity",
    "line_compact": LINES_SQL.replace("{{", "{").replace("}}", "}"),
    "categories": column_sql("text", "array_to_string(regexp_extract_all(text, '\\[\\[Category:([^\\]|]*)', 1), '|')"),
    "related_links": column_sql(
        "text",
        "array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '\\[\\[([^:\\]]*)\\]\\]', 1), lambda x: regexp_replace(regexp_replace(x, ' \\(.*', ''), '\\|.*', '')))), '|')",
    ),
    "page_metadata": f"""SELECT id, concat('{BASE}?curid=', id) AS url, CASE WHEN lower(title[1:9]) = 'category:' THEN substr(title, 10) ELSE title END AS title,
        lower(title[1:9]) = 'category:' AS is_category, lower(title[1:9]) <> 'category:' AS is_article FROM {PAGE_SQL} t""",
    "main_article": f"SELECT id, CASE WHEN lower(title[1:9]) = 'category:' THEN regexp_extract(text, '(?is)\\{{\\{{cat main\\|(.*?)\\}}\\}}', 1) ELSE '' END AS out FROM {PAGE_SQL} t",
    "external_links": column_sql("text", sub("text", rf"\[(?i:{PROTOCOL_RE})[^\]\[<>\"\x00-\x20\x7f]+\s*([^\]\[\x00-\x08\x0a-\x1f]*?)\]", r"\1")),
    "internal_links_flat": f"""SELECT id, CASE WHEN len(ms) = 0 THEN text ELSE list_reduce(list_prepend(text, ms), lambda t, m: replace(t, m,
        CASE WHEN regexp_matches({INNER}, '^:?[^:|]+:') AND NOT regexp_matches({INNER}, '^:?(w|wiktionary|wikt):') THEN ''
        WHEN contains({INNER}, '|') THEN replace(trim(string_split({INNER}, '|')[-1]), ' ', '_') ELSE replace({INNER}, ' ', '_') END)) END AS out
        FROM (SELECT id, text, regexp_extract_all(text, '\\[\\[[^\\[\\]]*\\]\\]') AS ms FROM {pages_sql("id", "text")} t) u""",
    "bold_italic": column_sql(
        "text",
        swap(sub(sub(sub(sub(sub("text", "'''''(.*?)'''''", r"\1"), "'''(.*?)'''", r"\1"), "''\"([^\"]*?)\"''", r'"\1"'), "''(.*?)''", r'"\1"'), '""([^"]*?)""', r'"\1"'), ("'''", ""), ("''", '"')),
    ),
    "magic_switches": column_sql("text", sub("text", "|".join(SWITCHES), "")),
    "late_switches": column_sql("marks", sub("marks", "|".join([s for s in SWITCHES if s != "__END__"] + ["__NOEDITSECTION__"]), "")),
    "table_drop_flat": column_sql("text", sub("text", r"\{\|.*?\|\}", "", "gs")),
    "template_drop_flat": column_sql("text", sub("text", r"\{\{[^{}]*\}\}", "")),
    "placeholders": f"""SELECT id, replace(replace(u, concat('<math>x^', regexp_extract(u, 'x\\^(\\d+)', 1), '</math>'), 'formula_1'), '<math>y</math>', 'formula_2') AS out
        FROM (SELECT id, {swap("text", *ENTITIES)} AS u FROM {pages_sql("id", "text")} t) v""",
    "punct_cleanup": column_sql(
        "marks",
        swap(sub(sub(sub(swap("marks", ("<<", "«"), (">>", "»"), ("\t", " ")), " {2,}", " "), r"\.{4,}", "..."), r"\n[^\p{L}\p{N}_]+?\n", "\n"), (",,", ","), (",.", ".")),
    ),
    "clean_comma": column_sql("marks", swap("marks", ("．", "·"), ("‧", "·"), ("˙", "·"))),
    "clean_number": column_sql("text", sub(sub("text", r"(Sold \d{1,2}),(\d{3} )", r"\1\2"), r"( and 12),(\d{3} )", r"\1\2")),
    "clean_ref": column_sql("marks", sub(sub("marks", r"\[\[[^\]:]*:[^\]]*?\]\]", ""), r"\[\[([^\]|]*)[^\]]*\]\]", r"\1")),
    "strip_tags": column_sql("text", sub(swap("text", *ENTITIES), "<[^>]*>", "")),
    "normalize_title": f"""SELECT id, CASE WHEN contains(s, ':') THEN concat(upper(s[1]), substr(string_split(s, ':')[1], 2), ':', upper(r[1]), substr(r, 2)) ELSE concat(upper(s[1]), substr(s, 2)) END AS out
        FROM (SELECT id, s, ltrim(string_split(s, ':')[2]) AS r FROM (SELECT id, {sub(sub("title", "^[ _]+|[ _]+$", ""), "[\\s_]+", " ")} AS s FROM {pages_sql("id", "title")} t) u) v""",
    "glue_latin": column_sql(
        "latin",
        sub(sub(sub(sub("latin", "([A-Za-z][A-Za-z0-9.]?)[ 　]([A-Za-z0-9.])", r"\1_\2"), "([A-Za-z][A-Za-z0-9.]?)[ 　]([A-Za-z0-9.])", r"\1_\2"), "([A-Za-z][0-9.]+)[ 　]([A-Za-z0-9.])", r"\1_\2"), r"[ \t\n\r]", ""),
    ),
    "tokenize_words": f"SELECT doc_id, len(w) AS n_tokens, md5(array_to_string(w, '|')) AS tokens_md5 FROM (SELECT doc_id, regexp_extract_all(text, {lit(WORD_RE)}) AS w FROM documents) t",
    "template_define": _define_sql(),
    "template_usage_join": USAGE_SQL,
    "template_closure": CLOSURE_SQL,
    "script_phrases": SCRIPT_SQL,
    "abbreviation_scores": SCORES_SQL,
    "abbreviation_tokens": STOPS_SQL,
    "template_rounds": ROUNDS_SQL,
    "changed_pages": CHANGED_SQL,
    "split_files": SPLIT_SQL,
    "internal_links_nested": NESTED_LINK_SQL,
    "template_expand": EXPAND_SQL,
    "parser_functions": FUNCTIONS_SQL,
    "text_pipeline": SECTIONS_SQL,
    "redirect_filter": f"SELECT position, id FROM ({RAW_SQL}) t WHERE NOT redirect",
    "ns_filter": f"SELECT position, ns FROM ({RAW_SQL}) t WHERE ns NOT IN ('10', '828')",
    "dedupe_consecutive": f"SELECT path, position, id FROM ({RAW_SQL}) t WHERE NOT redirect QUALIFY id IS DISTINCT FROM lag(id) OVER (PARTITION BY path ORDER BY position)",
    "dump_parse": f"SELECT id, title, ns, text FROM {pages_sql('id', 'title', 'ns', 'text')} t",
    "dump_listing": f"SELECT url, lang, strftime(date, '%Y-%m-%d %H:%M') AS date, size, path, filename FROM ({LISTING_SQL}) t",
    "small_files": f"SELECT filename, size FROM ({LISTING_SQL}) t WHERE size > 100000",
    "part_numbers": PARTS_SQL,
    "manifest_diff": f"SELECT path, size FROM ({LISTING_SQL}) t WHERE size % 3 = 0 OR size % 7 = 0",
    "extract_pages": _extract_sql(),
    "unescape": f"""SELECT id, concat(chr(CAST(id AS INTEGER) % 900 + 33), chr(CAST(id AS INTEGER) % 700 + 8704), 'éΩ♥', chr(160), p_name, '&lt;&unknown;&#xzz;&#55296;&#1114112;&#99999999999999999999; & &; €', chr(128512)) AS out
        FROM (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name FROM part) t""",
    "unescape_outside_highlight": """SELECT CAST(p_partkey AS VARCHAR) AS id, concat('<b> ', p_name, ' a &amp;lt; ', p_brand, ' "', p_type, '"') AS out FROM part""",
    "clean_template": """SELECT CAST(p_partkey AS VARCHAR) AS id, concat(p_name, chr(10), p_name, ' b', chr(10), chr(10), p_brand, chr(10), p_type, chr(10), p_brand, chr(10), chr(10), 'end {x}') AS out FROM part""",
    "nested_regions": """SELECT CAST(p_partkey AS VARCHAR) AS id, concat('ab', chr(10), 'c ', p_brand, ' ', p_type) AS out FROM part""",
    "list_lines": """SELECT CAST(p_partkey AS VARCHAR) AS id, concat(p_name, '.', chr(10), '- ', p_type, chr(10), '- ', p_brand, chr(10), '1. c', chr(10), 'after ', p_name, chr(10), 'Deep!', chr(10), 'last ', p_type) AS out FROM part""",
    "html_lines": """SELECT CAST(p_partkey AS VARCHAR) AS id, concat('<h2>', p_name, '</h2>', chr(10), '<ul>', chr(10), '<li>', p_type, '</li>', chr(10), '<ul>', chr(10), '<li>', p_brand, '</li>', chr(10),
        '</ul>', chr(10), '</ul>', chr(10), '<ol>', chr(10), '<li>c</li>', chr(10), 'after ', p_name, chr(10), '</ol>', chr(10), '<h3>Deep!</h3>', chr(10), p_name, '.', chr(10), 'Deep!', chr(10), 'last ', p_type) AS out FROM part""",
    "modules_and_redirects": MODULES_SQL,
    "rule_tokens": f"SELECT doc_id, len(w) AS n_tokens, md5(array_to_string(w, '|')) AS tokens_md5 FROM (SELECT doc_id, {words_sql('text')} AS w FROM documents) t",
}
#: Native expression and kernel are held against the same SQL.
ORACLES |= {
    f"{name}_kernel": ORACLES[{"internal_links": "internal_links_flat", "table_drop": "table_drop_flat", "template_drop": "template_drop_flat"}.get(name, name)]
    for name in (q[: -len("_kernel")] for q in QUERIES if q.endswith("_kernel"))
}
