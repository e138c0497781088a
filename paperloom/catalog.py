"""Registered queries: every operator family over the driver tables, beside the DuckDB SQL that gives the same rows.

The engine's relations are bound to those tables: documents are question blocks
(paper = source), conversations are marked-up lines, line items are page
elements or asset links, embeddings' signs are perceptual hashes, events are
steps of runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions import cues, text
from paperloom.functions.bits import hamming
from paperloom.functions.geometry import gap, overlap_share, scaled_box
from paperloom.operators import dedup, reports, rules, segment, store
from paperloom.plans.ingest import from_markdown
from paperloom.plans.layout import layout
from paperloom.scratch import scratch_path, stored
from paperloom.sources import exports
from paperloom.streaming.new_papers import identified

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "duplicate_groups"
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _int(c: Column) -> Column:
    return c.cast("long")


#: Fingerprints of documents, shared by several oracles.
_FP = "substr(sha256(regexp_replace(text, '[\\s\\p{Z}\\x0B]+', '', 'g')), 1, 16)"


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as identities of question blocks."""
    d = _t(spark, sf_dir, "documents")
    length = F.when(F.col("n_chars") < 1000, "short").otherwise("long")
    path = F.concat_ws("/", "lang", length)
    return d.select(
        F.col("source").alias("paper_id"), F.format_string("b%012d", "doc_id").alias("block_id"), F.concat_ws("#", "source", path, (F.col("doc_id") % 25).cast("string")).alias("source_position_key"),
        text.text_fingerprint(F.col("text")).alias("text_fingerprint"), text.formula_fingerprint(F.col("text")).alias("latex_fingerprint"), F.lit("").alias("asset_signature"),
    )


# Duplicates


@query(f"""
    SELECT fp AS fingerprint, count(*) AS n, count(DISTINCT source) AS papers, max(n_chars) AS longest
    FROM (SELECT {_FP} AS fp, source, n_chars FROM documents WHERE length(regexp_replace(text, '[\\s\\p{{Z}}\\x0B]+', '', 'g')) > 0)
    GROUP BY fp HAVING count(DISTINCT source) >= 2
""")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints shared by several papers."""
    d = _t(spark, sf_dir, "documents").select("source", "n_chars", text.text_fingerprint(F.col("text")).alias("fingerprint"))
    per = d.where(F.length("fingerprint") > 0).groupBy("fingerprint", "source").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest"))
    found = per.groupBy("fingerprint").agg(F.sum("n").alias("n"), F.count("*").alias("papers"), F.max("longest").alias("longest"))
    return found.where("papers >= 2")


@query(f"""
    SELECT 'b' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS block_id, source AS paper_id,
           source || '#' || lang || '/' || CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END || '#' || CAST(doc_id % 25 AS VARCHAR) AS source_position_key,
           CASE WHEN length(regexp_replace(text, '[\\s\\p{{Z}}\\x0B]+', '', 'g')) > 0 THEN {_FP} ELSE '' END AS text_fingerprint,
           CASE WHEN len(f) > 0 THEN substr(sha256(array_to_string(list_sort(f), ' | ')), 1, 16) ELSE '' END AS latex_fingerprint
    FROM (SELECT *, regexp_extract_all(text, '\\$([^\\n]+?)\\$', 1) AS f FROM documents)
""")
def block_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position keys, text and formula fingerprints."""
    return identities(spark, sf_dir).drop("asset_signature")


_ITEMS = f"""
    WITH i AS (
        SELECT doc_id, source AS paper_id, {_FP} AS fingerprint, lang || '/' || CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END AS section_path,
               regexp_extract_all(text, '\\$([^\\n]+?)\\$', 1) AS f, 'b' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS block_id
        FROM documents WHERE length(regexp_replace(text, '[\\s\\p{{Z}}\\x0B]+', '', 'g')) > 0
    ), s AS (SELECT fingerprint FROM i GROUP BY 1 HAVING count(DISTINCT paper_id) >= 2), m AS (
        SELECT i.*, CASE WHEN len(f) > 0 THEN array_to_string(list_sort(f), ' | ') ELSE '' END AS latex, string_split(section_path, '/') AS parts FROM i JOIN s USING (fingerprint)
    ), p AS (
        SELECT a.fingerprint, a.block_id AS a, b.block_id AS b,
               0.25 + CASE WHEN a.latex <> '' AND a.latex = b.latex THEN 0.35 ELSE 0.0 END
               + 0.15 * len(list_intersect(a.parts, b.parts)) / len(list_distinct(list_concat(a.parts, b.parts))) AS score
        FROM m a JOIN m b ON a.fingerprint = b.fingerprint AND a.block_id <> b.block_id
    ), g AS (SELECT fingerprint, a AS block_id, round(sum(score) / count(*), 9) AS avg_score FROM p GROUP BY 1, 2)
"""


@query(_ITEMS + """
    SELECT fingerprint, block_id, avg_score FROM (
        SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY avg_score DESC, block_id) AS r FROM g) WHERE r <= 20
""")
def trimmed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group items with the highest mean similarity, without pairing them."""
    items = stored(dedup.with_paths(dedup.candidate_items(identities(spark, sf_dir))), "items")
    return dedup.trimmed(items).select("fingerprint", "block_id", F.round("avg_score", 9).alias("avg_score"))


@query(_ITEMS + """
    SELECT fingerprint, arg_min(block_id, r) AS block_id FROM (
        SELECT fingerprint, block_id, row_number() OVER (PARTITION BY fingerprint ORDER BY avg_score DESC, k, block_id) AS r
        FROM g JOIN (SELECT 'b' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS block_id, source || '#' || lang || '/' || CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END || '#' || CAST(doc_id % 25 AS VARCHAR) AS k FROM documents) USING (block_id)
    ) GROUP BY 1
""")
def representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most typical item of each group."""
    items = stored(dedup.with_paths(dedup.candidate_items(identities(spark, sf_dir))), "items")
    return dedup.representatives(items, "fingerprint").select("fingerprint", "block_id")


@query(_ITEMS + """
    , t AS (SELECT fingerprint, block_id FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY avg_score DESC, block_id) AS r FROM g) WHERE r <= 20)
    SELECT 'dcg_' || substr(sha256(t.fingerprint), 1, 16) AS id, t.fingerprint, 'text' AS fingerprint_type, CAST(count(DISTINCT t.block_id) AS INTEGER) AS candidate_count,
           round(coalesce(max(score), 0.0), 9) AS max_similarity, 'pending' AS status
    FROM t LEFT JOIN (SELECT p.* FROM p JOIN t x ON p.fingerprint = x.fingerprint AND p.a = x.block_id JOIN t y ON p.fingerprint = y.fingerprint AND p.b = y.block_id) q ON q.fingerprint = t.fingerprint
    GROUP BY t.fingerprint
""")
def candidate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate groups as they are stored."""
    return dedup.candidate_groups(identities(spark, sf_dir)).drop("items").withColumn("max_similarity", F.round("max_similarity", 9))


@query("""
    SELECT source AS paper_id, CAST(sum(n - 1) AS BIGINT) AS collisions FROM (
        SELECT source, fp, count(*) AS n FROM (SELECT source, """ + _FP + """ AS fp FROM documents WHERE length(regexp_replace(text, '[\\s\\p{Z}\\x0B]+', '', 'g')) > 0) GROUP BY 1, 2) GROUP BY 1
""")
def fingerprint_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated fingerprints inside papers."""
    return reports.collisions(identities(spark, sf_dir)).select("paper_id", _int(F.col("collisions")).alias("collisions"))


@query("""
    WITH c AS (SELECT d.doc_id, d.source, sha256(coalesce(d.lang, '') || '|' || CAST(d.n_chars AS VARCHAR)) AS h, d.lang FROM documents d)
    SELECT substr(h, 1, 16) AS content_hash, min(lang) AS asset_type, min(doc_id) AS representative, count(*) AS size, count(DISTINCT source) AS papers
    FROM c GROUP BY 1 HAVING count(DISTINCT source) >= 2 AND min(lang) = max(lang)
""")
def asset_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal assets of one type in several papers."""
    d = _t(spark, sf_dir, "documents")
    a = d.select(F.col("doc_id").alias("id"), F.col("source").alias("paper_id"), F.col("lang").alias("asset_type"), text.short_hash(F.concat_ws("|", F.coalesce("lang", F.lit("")), F.col("n_chars").cast("string"))).alias("content_hash"))
    return dedup.asset_groups(a).select("content_hash", "asset_type", "representative", "size", "papers")


def hashed_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as assets whose hash has a bit for each component's sign."""
    e = _t(spark, sf_dir, "embeddings")
    bits = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    digits = F.lpad(F.lower(F.conv(bits, 2, 16)), 16, "0")
    return e.where(F.size("embedding") == 64).select(F.col("vec_id").alias("id"), (F.col("vec_id") % 20).cast("string").alias("paper_id"), F.col("label").alias("asset_type"), digits.alias("perceptual_hash"))


@query("""
    WITH h AS (SELECT vec_id, label, vec_id % 20 AS p, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings WHERE len(embedding) = 64)
    SELECT x.label AS asset_type, x.vec_id AS a, y.vec_id AS b, CAST(list_sum(list_transform(list_zip(x.b, y.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
    FROM h x JOIN h y ON x.label = y.label AND x.vec_id < y.vec_id AND x.p <> y.p
    WHERE list_sum(list_transform(list_zip(x.b, y.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) <= 20
""")
def hamming_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets of one type in different papers with close hashes."""
    return dedup.hamming_edges(hashed_assets(spark, sf_dir), 20).select("asset_type", "a", "b", _intc("distance"))


def _intc(c: str) -> Column:
    return F.col(c).cast("int").alias(c)


@query()
def visual_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy visual clusters."""
    a = hashed_assets(spark, sf_dir).withColumns({"id": F.format_string("a%09d", "id"), "asset_type": F.col("asset_type").cast("string")})
    return dedup.visual_groups(a, 20)


# Text functions


@query("""
    SELECT doc_id, length(regexp_replace(text, '[\\s\\p{Z}\\x0B]+', '', 'g')) AS squashed, length(regexp_replace(regexp_replace(text, '^[\\s\\p{Z}\\x0B]+|[\\s\\p{Z}\\x0B]+\\z', '', 'g'), '[\\s\\p{Z}\\x0B]+', ' ', 'g')) AS collapsed,
           (length(bare) - length(replace(bare, '$', ''))) % 2 = 1 AS unbalanced, len(regexp_extract_all(text, '\\$([^\\n]+?)\\$', 1)) AS formulas
    FROM (SELECT *, regexp_replace(text, '\\\\.', '', 'gs') AS bare FROM documents) WHERE text IS NOT NULL
""")
def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """white space, formulas and delimiters."""
    d = _t(spark, sf_dir, "documents").where("text is not null")
    x = F.col("text")
    return d.select("doc_id", F.length(text.squash(x)).cast("long").alias("squashed"), F.length(text.collapse(x)).cast("long").alias("collapsed"), text.unbalanced_dollars(x).alias("unbalanced"), F.size(text.formulas(x)).cast("long").alias("formulas"))


@query("""
    SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), '') AS title,
           CASE WHEN lower(url) LIKE '%.pdf' THEN 'application/pdf' WHEN lower(url) LIKE '%.png' THEN 'image/png' WHEN lower(url) LIKE '%.json' THEN 'application/json' ELSE 'application/octet-stream' END AS mime,
           substr(sha256(url), 1, 16) AS url_hash
    FROM pages
""")
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """titles, content types and hashes of pages."""
    p = _t(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), text.content_type(F.col("url")).alias("mime"), text.short_hash(F.col("url")).alias("url_hash"))


@query("""
    WITH e AS (SELECT event_id, event_type || ': ' || coalesce(props, '') AS t FROM events)
    SELECT event_id, CASE WHEN lower(t) LIKE '%mineru%' AND regexp_matches(lower(t), 'connection|timeout|timed out|refused|reset|broken pipe|unreachable') THEN 'mineru_transient'
           WHEN lower(t) LIKE '%mineru%' THEN 'mineru_non_transient' WHEN lower(t) LIKE '%deepseek%' THEN 'deepseek' WHEN lower(t) LIKE '%database%' OR lower(t) LIKE '%psycopg%' OR lower(t) LIKE '%postgres%' THEN 'database'
           WHEN lower(t) LIKE '%layout%' THEN 'layout' WHEN lower(t) LIKE '%crop%' THEN 'asset_crop' WHEN lower(t) LIKE '%store%' OR lower(t) LIKE '%storage%' THEN 'asset_store' ELSE 'unknown' END AS class,
           trim(split_part(t, ':', 1)) AS code
    FROM e
""")
def failure_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and codes of error texts."""
    e = _t(spark, sf_dir, "events").select("event_id", F.concat_ws(": ", "event_type", F.coalesce("props", F.lit(""))).alias("t"))
    return e.select("event_id", rules.text_class(F.col("t"), "failure").alias("class"), rules.warning_code(F.col("t")).alias("code"))


# Segmentation


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "conversations")


@query("""
    WITH s AS (SELECT conv_id, turn, role, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS UNBOUNDED PRECEDING) AS piece FROM conversations)
    SELECT conv_id, CAST(piece AS BIGINT) AS piece, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM s WHERE piece > 0 GROUP BY 1, 2
""")
def turn_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments that start at each question, by a running count."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role").rowsBetween(Window.unboundedPreceding, 0)
    s = turns(spark, sf_dir).withColumn("piece", F.sum((F.col("role") == "user").cast("long")).over(w)).where("piece > 0")
    return s.groupBy("conv_id", "piece").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"))


@query("""
    SELECT conv_id, turn, role, last_value(CASE WHEN role = 'system' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS context,
           max(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS UNBOUNDED PRECEDING) = 1 AS answered
    FROM conversations
""")
def turn_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last section before each row, and the latch after the first answer."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role")
    context = F.last(F.when(F.col("role") == "system", F.col("turn")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    latch = F.max((F.col("role") == "assistant").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    return turns(spark, sf_dir).select("conv_id", "turn", "role", context.alias("context"), latch.alias("answered"))


@query("""
    WITH s AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS UNBOUNDED PRECEDING) AS piece FROM conversations)
    SELECT conv_id, CAST(piece AS BIGINT) AS piece, arg_min(length(text), turn) FILTER (WHERE role = 'user') AS asked, arg_max(length(text), turn) FILTER (WHERE role = 'assistant') AS answered
    FROM s WHERE piece > 0 GROUP BY 1, 2
""")
def answer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last answer to each question."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role").rowsBetween(Window.unboundedPreceding, 0)
    s = turns(spark, sf_dir).withColumn("piece", F.sum((F.col("role") == "user").cast("long")).over(w)).where("piece > 0")
    size = F.length("text").cast("long")
    return s.groupBy("conv_id", "piece").agg(F.min_by(F.when(F.col("role") == "user", size), F.when(F.col("role") == "user", F.col("turn"))).alias("asked"), F.max_by(F.when(F.col("role") == "assistant", size), F.when(F.col("role") == "assistant", F.col("turn"))).alias("answered"))


def _as_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as marked-up papers: a number for each user turn, its text as lines, answers after a heading."""
    c = turns(spark, sf_dir)
    one = F.concat((F.col("turn") + 1).cast("string"), F.lit(". "), F.regexp_replace("text", r"[\r\n]+", " "))
    rows = c.select("conv_id", F.struct((F.col("role") == "assistant").alias("late"), "turn", "role", one.alias("line")).alias("r"))
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("r")).alias("r"))
    part = lambda late: F.transform(F.filter("r", lambda x: x["late"] == late), lambda x: x["line"])
    return listed.select(F.col("conv_id").cast("string").alias("paper_id"), F.array_join(F.concat(part(False), F.array(F.lit("参考答案")), part(True)), "\n").alias("markdown"))


@query("""
    SELECT CAST(conv_id AS VARCHAR) AS paper_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS INTEGER) AS block_index, CAST(turn + 1 AS VARCHAR) AS question_number,
           CAST(conv_id AS VARCHAR) || '_qb_' || lpad(CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS VARCHAR), 4, '0') AS id
    FROM conversations WHERE role <> 'assistant'
""")
def markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question blocks of marked-up text."""
    return segment.question_blocks(_as_markdown(spark, sf_dir)).select("paper_id", "block_index", "question_number", "id")


@query()
def markdown_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured, repaired, validated and gated questions of marked-up text."""
    done = from_markdown(_as_markdown(spark, sf_dir))
    return done.select("paper_id", "block_index", "question_number", "question_type", "answer_latex", "gate", F.array_join("gate_codes", ",").alias("codes"), "overall_score", "needs_review")


# Rules


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as questions: short ones are fill-ins, others short answers."""
    d, l = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    none = F.array().cast("array<struct<label:string,content_latex:string>>")
    return d.join(l, "doc_id").select(
        F.col("doc_id").alias("question_id"), "source", "quality", "toxic", F.when(F.col("n_chars") < 1000, "fill_blank").otherwise("short_answer").alias("question_type"), F.col("text").alias("stem_latex"),
        F.lit("").alias("analysis_latex"), F.when(F.col("lang") == "en", "x").otherwise("").alias("answer_latex"), none.alias("choices"),
    )


_ISSUES = """
    WITH q AS (
        SELECT doc_id, source, quality, toxic, n_chars < 1000 AS short, lang = 'en' AS answered,
               (length(bare) - length(replace(bare, '$', ''))) % 2 = 1 AS odd
        FROM (SELECT *, regexp_replace(text, '\\\\.', '', 'gs') AS bare FROM documents) JOIN labels USING (doc_id) WHERE text IS NOT NULL
    ), n AS (SELECT *, CAST(odd AS INTEGER) + CAST(NOT coalesce(answered, false) AS INTEGER) + CAST(NOT short AS INTEGER) AS issues FROM q)
"""


@query(_ISSUES + """
    SELECT doc_id AS question_id, issues AS n_issues, round(greatest(0.0, 1.0 - 0.2 * issues), 2) AS overall_score, issues > 0 AS needs_review,
           CASE WHEN odd OR NOT short THEN 'warning' ELSE 'pass' END AS gate
    FROM n
""")
def validated_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings, scores and gates."""
    q = rules.validate(reviewed(spark, sf_dir).where("stem_latex is not null")).withColumn("g", rules.gate())
    return q.select("question_id", F.size("issues").alias("n_issues"), "overall_score", "needs_review", F.col("g.gate").alias("gate"))


@query(_ISSUES + """
    SELECT doc_id AS question_id, round(greatest(0.0, 1.0 - 0.2 * issues), 2) AS overall_score FROM n WHERE quality = 0 OR toxic = 1 ORDER BY overall_score, doc_id LIMIT 50
""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worst questions first; the limit is the queue's."""
    q = rules.validate(reviewed(spark, sf_dir).where("stem_latex is not null"))
    return q.where("quality = 0 or toxic = 1").orderBy("overall_score", "question_id").limit(50).select("question_id", "overall_score")


@query("""
    SELECT d.doc_id, b.item_id, length(trim(b.text)) >= 80 AND contains(d.text, left(trim(b.text), 80)) AS copied
    FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark)
""")
def copied_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: answers that only repeat 80 characters of their block; each document is paired with one item."""
    b = _t(spark, sf_dir, "benchmark").select("item_id", F.trim("text").alias("answer"))
    d = _t(spark, sf_dir, "documents").select("doc_id", "text").withColumn("item_id", F.pmod("doc_id", F.lit(b.count())))
    copied = (F.length("answer") >= 80) & F.contains("text", F.substring("answer", 1, 80))
    return d.join(b, "item_id").select("doc_id", "item_id", copied.alias("copied"))


@query("""
    SELECT source AS paper_id, CASE WHEN stddev_pop(n_chars) / 10000.0 > 0.22 THEN 'two_column' WHEN avg(CASE WHEN lang = 'de' THEN 1.0 ELSE 0.0 END) > 0.15 THEN 'figure_heavy' WHEN max(n_chars) >= 10000 THEN 'cross_page' ELSE 'single_column' END AS stratum,
           count(*) AS blocks
    FROM documents GROUP BY 1
""")
def paper_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each paper by spread, share and size."""
    d = _t(spark, sf_dir, "documents")
    name = F.when(F.stddev_pop("n_chars") / 10000.0 > 0.22, "two_column").when(F.avg((F.col("lang") == "de").cast("double")) > 0.15, "figure_heavy").when(F.max("n_chars") >= 10000, "cross_page").otherwise("single_column")
    return d.groupBy(F.col("source").alias("paper_id")).agg(name.alias("stratum"), F.count("*").alias("blocks"))


# Layout on line items


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as page elements."""
    l = _t(spark, sf_dir, "lineitem")
    x1, y1 = F.col("l_discount") * 5, (F.col("l_quantity") - 1) / 60
    return l.select((F.col("l_orderkey") % 500).alias("paper_id"), "l_orderkey", F.col("l_linenumber").alias("page"), "l_partkey", x1.alias("x1"), y1.alias("y1"), (x1 + F.lit(0.2)).alias("x2"), (y1 + 0.01 + F.col("l_tax")).alias("y2"))


_BOX = "SELECT l_orderkey % 500 AS paper_id, l_orderkey, l_linenumber AS page, l_partkey, l_discount * 5 AS x1, (l_quantity - 1) / 60 AS y1, l_discount * 5 + 0.2 AS x2, (l_quantity - 1) / 60 + 0.01 + l_tax AS y2 FROM lineitem"


@query(f"""
    WITH e AS ({_BOX}), o AS (
        SELECT *, lag(y1) OVER (PARTITION BY paper_id, page ORDER BY y1, x1, l_orderkey, l_partkey) AS before, row_number() OVER (PARTITION BY paper_id ORDER BY page, y1, x1, l_orderkey, l_partkey) - 1 AS reading_order FROM e WHERE NOT (y2 < 0.04 OR y1 > 0.96))
    SELECT paper_id, page, count(*) AS elements, CAST(sum(CASE WHEN y1 - before >= 0.18 THEN 1 ELSE 0 END) AS BIGINT) AS splits, max(reading_order) AS last_order, round(min(x1), 6) AS x1, round(max(y2), 6) AS y2
    FROM o GROUP BY 1, 2
""")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise, gaps, reading order and boxes."""
    e = _elements(spark, sf_dir).where(~((F.col("y2") < 0.04) | (F.col("y1") > 0.96)))
    order = ("y1", "x1", "l_orderkey", "l_partkey")
    w, p = Window.partitionBy("paper_id", "page").orderBy(*order), Window.partitionBy("paper_id").orderBy("page", *order)
    e = e.withColumns({"before": F.lag("y1").over(w), "ro": _int(F.row_number().over(p) - 1)})
    return e.groupBy("paper_id", "page").agg(F.count("*").alias("elements"), F.sum(F.when(F.col("y1") - F.col("before") >= 0.18, 1).otherwise(0)).alias("splits"), F.max("ro").alias("last_order"), F.round(F.min("x1"), 6).alias("x1"), F.round(F.max("y2"), 6).alias("y2"))


@query(f"""
    WITH e AS ({_BOX}), a AS (SELECT * FROM e WHERE l_partkey % 50 = 0), b AS (SELECT paper_id, page, min(x1) AS bx1, min(y1) AS by1, max(x2) AS bx2, max(y2) AS by2 FROM e WHERE l_partkey % 50 <> 0 GROUP BY 1, 2),
    s AS (
        SELECT a.l_orderkey, a.l_partkey, a.page AS asset_page, b.page AS page,
               0.35 * CASE WHEN a.page = b.page THEN 1 ELSE 0 END + 0.25 * greatest(least(a.y2, b.by2) - greatest(a.y1, b.by1), 0) / (a.y2 - a.y1) + 0.20 * greatest(least(a.x2, b.bx2) - greatest(a.x1, b.bx1), 0) / (a.x2 - a.x1)
               + 0.15 * exp(-CASE WHEN a.y2 <= b.by1 THEN b.by1 - a.y2 WHEN b.by2 <= a.y1 THEN a.y1 - b.by2 ELSE 0 END / 0.08) AS score
        FROM a JOIN b USING (paper_id))
    SELECT l_orderkey, l_partkey, asset_page, page, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, asset_page ORDER BY round(score, 9) DESC, page) AS r FROM s) WHERE r = 1
""")
def asset_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best block of each asset."""
    e = _elements(spark, sf_dir)
    a = e.where("l_partkey % 50 = 0").withColumnRenamed("page", "asset_page")
    b = e.where("l_partkey % 50 <> 0").groupBy("paper_id", "page").agg(F.min("x1").alias("bx1"), F.min("y1").alias("by1"), F.max("x2").alias("bx2"), F.max("y2").alias("by2"))
    c = F.col
    near = F.exp(-gap(c("y1"), c("y2"), c("by1"), c("by2")) / 0.08)
    score = 0.35 * (c("asset_page") == c("page")).cast("int") + 0.25 * overlap_share(c("y1"), c("y2"), c("by1"), c("by2")) + 0.20 * overlap_share(c("x1"), c("x2"), c("bx1"), c("bx2")) + 0.15 * near
    s = a.join(b, "paper_id").withColumn("score", score)
    w = Window.partitionBy("l_orderkey", "l_partkey", "asset_page").orderBy(F.desc(F.round("score", 9)), "page")
    return s.withColumn("r", F.row_number().over(w)).where("r = 1").select("l_orderkey", "l_partkey", "asset_page", "page", F.round("score", 6).alias("score"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, round(least(1.0, greatest(0.0, l_quantity * 10 / 1000)), 9) AS x1, round(least(1.0, greatest(0.0, l_extendedprice / 1000)), 9) AS x2 FROM lineitem
    WHERE least(1.0, l_extendedprice / 1000) > least(1.0, l_quantity * 10 / 1000)
""")
def scaled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes in thousandths as shares; empty ones are dropped."""
    l = _t(spark, sf_dir, "lineitem").withColumn("b", scaled_box(F.array(F.col("l_quantity") * 10, F.lit(0.0), "l_extendedprice", F.lit(900.0))))
    return l.where("b is not null").select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("b")[0], 9).alias("x1"), F.round(F.col("b")[2], 9).alias("x2"))


@query()
def layout_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout program over line items as elements of numbered texts and pictures."""
    e = _elements(spark, sf_dir)
    order = Window.partitionBy("paper_id").orderBy("l_orderkey", "page", "l_partkey")
    n = F.row_number().over(order)
    kind = F.when(F.col("l_partkey") % 29 == 0, "image").when(F.col("l_partkey") % 13 == 0, "formula").otherwise("text")
    words = F.when(F.col("l_partkey") % 101 == 0, "一、选择题").when(F.col("l_partkey") % 4 == 0, F.concat((F.col("l_partkey") % 40 + 1).cast("string"), F.lit(". 计算 x"))).otherwise("如图 x")
    raw = e.select(
        F.col("paper_id").cast("string").alias("paper_id"), n.alias("ord"), F.format_string("e%06d", n).alias("id"), "page", kind.alias("type"), F.array("x1", "y1", "x2", "y2").alias("bbox"), words.alias("text"), F.lit(1.0).alias("confidence"),
    )
    b = layout(raw).blocks
    return b.select("paper_id", "block_index", "question_block_id", "question_number", "column_index", F.size("element_ids").alias("elements"), F.size("assets").alias("assets"), F.size("warnings").alias("warnings"))


# Links and integrity


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def unlinked_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets that no link names."""
    return _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(F.col("o_orderkey").alias("id"))


@query("""
    SELECT o.o_custkey AS paper_id, count(*) AS links, CAST(sum(CASE WHEN l.l_discount < 0.03 THEN 1 ELSE 0 END) AS BIGINT) AS weak_links FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1
""")
def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and weak links of each paper."""
    l = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return l.groupBy(F.col("o_custkey").alias("paper_id")).agg(F.count("*").alias("links"), F.count_if(F.col("l_discount") < 0.03).alias("weak_links"))


@query("""
    SELECT l.l_suppkey AS paper_id, count(*) AS broken_links FROM lineitem l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderkey IS NULL GROUP BY 1
""")
def broken_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose block is not there."""
    o = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return _t(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").groupBy(F.col("l_suppkey").alias("paper_id")).agg(F.count("*").alias("broken_links"))


# Limits and lookups


@query("SELECT o_orderkey AS id, o_totalprice AS candidate_count FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey LIMIT 50")
def newest_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of a status, the largest first; the limit is the list's."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("candidate_count"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"))
    return store.newest(o, "O", 50, F.desc("candidate_count")).select("id", "candidate_count")


@query("SELECT o_custkey AS id, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS items FROM orders GROUP BY 1")
def nested_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their parts in order."""
    o = _t(spark, sf_dir, "orders")
    got = store.nested(o.select(F.col("o_custkey").alias("id")).distinct(), o, "o_custkey", "items", ("o_orderdate", "o_orderkey"))
    return got.select("id", F.array_join(F.transform("items", lambda r: r["o_orderkey"].cast("string")), ",").alias("items"))


# Sets and comparisons


_OLD_NEW = "WITH o AS (SELECT DISTINCT source AS p, doc_id % 40 AS q FROM documents), n AS (SELECT DISTINCT source AS p, n_chars % 60 AS q FROM documents)"


@query(_OLD_NEW + """
    SELECT coalesce(o.p, n.p) AS paper_id, count(o.q) AS old_count, count(n.q) AS new_count, count(*) FILTER (WHERE o.q IS NOT NULL AND n.q IS NOT NULL) AS "both",
           coalesce(string_agg(CAST(o.q AS VARCHAR), ',' ORDER BY o.q) FILTER (WHERE n.q IS NULL), '') AS only_old, coalesce(string_agg(CAST(n.q AS VARCHAR), ',' ORDER BY n.q) FILTER (WHERE o.q IS NULL), '') AS only_new
    FROM o FULL JOIN n ON o.p = n.p AND o.q = n.q GROUP BY 1
""")
def compared_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers found by both of two methods, or by one, in natural order."""
    d = _t(spark, sf_dir, "documents")
    side = lambda number: d.select(F.col("source").alias("paper_id"), number.cast("string").alias("question_number"))
    c = reports.compared(side(F.col("doc_id") % 40), side(F.col("n_chars") % 60))
    return c.select("paper_id", "old_count", "new_count", "both", F.array_join("only_old", ",").alias("only_old"), F.array_join("only_new", ",").alias("only_new"))


@query("""
    WITH p AS (SELECT doc_id, string_split(lang || '/' || source || '/' || lang, '/') AS a, string_split('en/src0/' || CAST(doc_id % 3 AS VARCHAR), '/') AS b FROM documents)
    SELECT doc_id, round(len(list_intersect(list_distinct(a), list_distinct(b))) / len(list_distinct(list_concat(a, b))), 9) AS jaccard FROM p
""")
def path_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared parts of paths."""
    d = _t(spark, sf_dir, "documents")
    a, b = F.concat_ws("/", "lang", "source", "lang"), F.concat_ws("/", F.lit("en/src0"), (F.col("doc_id") % 3).cast("string"))
    return d.select("doc_id", F.round(dedup.section_jaccard(a, b), 9).alias("jaccard"))


@query("SELECT source AS paper_id, doc_id, 'own' AS origin FROM documents WHERE source = 'src1' UNION ALL SELECT source, doc_id, 'stored' FROM documents WHERE source <> 'src1'")
def own_and_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current paper's rows and all others'."""
    d = _t(spark, sf_dir, "documents").select(F.col("source").alias("paper_id"), "doc_id")
    return d.where("paper_id = 'src1'").withColumn("origin", F.lit("own")).unionByName(d.where("paper_id <> 'src1'").withColumn("origin", F.lit("stored")))


# Upserts


def _slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    return o, o.withColumns({"id": F.col("id") * 2, "status": F.lit("X"), "price": F.col("price") + 1, "priority": F.lit("new")})


_SLICES = "WITH s AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS priority FROM orders), f AS (SELECT o_orderkey * 2 AS id, 'X' AS status, o_totalprice + 1 AS price, 'new' AS priority FROM orders)"


@query(_SLICES + """
    SELECT coalesce(s.id, f.id) AS id, coalesce(f.status, s.status) AS status, coalesce(f.price, s.price) AS price, coalesce(s.priority, f.priority) AS priority FROM s FULL JOIN f ON s.id = f.id
""")
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge by key, changing the listed columns alone."""
    s, f = _slices(spark, sf_dir)
    return store.upsert(s, f, ("id",), ("status", "price"))


@query(_SLICES + " SELECT * FROM s UNION ALL SELECT f.* FROM f WHERE id NOT IN (SELECT id FROM s)")
def inserted_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert what is not there."""
    s, f = _slices(spark, sf_dir)
    return store.insert_new(s, f, ("id",))


@query(_SLICES + " SELECT s.* FROM s WHERE id NOT IN (SELECT id FROM f)")
def deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete by key."""
    s, f = _slices(spark, sf_dir)
    return store.delete(s, f.select("id"), ("id",))


@query(_SLICES + " SELECT s.id, coalesce(f.status, s.status) AS status, s.price, s.priority FROM s LEFT JOIN f ON s.id = f.id")
def updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change known rows."""
    s, f = _slices(spark, sf_dir)
    return store.update(s, f.select("id", "status"), ("id",))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each key."""
    return store.latest(_t(spark, sf_dir, "orders"), ("o_custkey",), "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""
    WITH i AS (SELECT {_FP} AS fp, source, doc_id FROM documents WHERE length(regexp_replace(text, '[\\s\\p{{Z}}\\x0B]+', '', 'g')) > 0), g AS (SELECT fp, count(*) AS n FROM i GROUP BY 1 HAVING count(DISTINCT source) >= 2)
    SELECT 'cqn_' || substr(sha256('dcg_' || substr(sha256(fp), 1, 16)), 1, 16) AS id, substr(sha256(fp), 1, 16) AS canonical_fingerprint, 'dcg_' || substr(sha256(fp), 1, 16) AS created_from_group_id, 'active' AS status, n AS variants FROM g
""")
def canonical_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical questions of groups, and their variants."""
    items = stored(dedup.with_paths(dedup.candidate_items(identities(spark, sf_dir))), "items")
    items = items.withColumns({"group_id": F.concat(F.lit("dcg_"), text.short_hash(F.col("fingerprint"))), "question_id": F.lit(None).cast("string")})
    made = store.canonical_rows(items, "batch")
    n = made["variants"].groupBy(F.col("canonical_question_id").alias("id")).agg(F.count("*").alias("variants"))
    return made["canonical"].join(n, "id").select("id", "canonical_fingerprint", "created_from_group_id", "status", "variants")


@query(_ITEMS + """
    , t AS (SELECT fingerprint, block_id FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY avg_score DESC, block_id) AS r FROM g) WHERE r <= 20),
    c AS (SELECT fingerprint, count(*) AS n FROM t GROUP BY 1)
    SELECT id, candidate_count, papers FROM (
        SELECT 'dcg_' || substr(sha256(fingerprint), 1, 16) AS id, CAST(n AS INTEGER) AS candidate_count,
               (SELECT array_to_string(list_sort(list(DISTINCT m.paper_id))[1:3], ', ') FROM m JOIN t USING (fingerprint, block_id) WHERE m.fingerprint = c.fingerprint) AS papers FROM c)
    ORDER BY candidate_count DESC, id LIMIT 50
""")
def group_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest groups with their first papers; the limit is the report's."""
    return reports.group_summaries(dedup.candidate_groups(identities(spark, sf_dir))).select("id", "candidate_count", "papers")


# Stored tables


_TRIMMED = _ITEMS + """
    , t AS (SELECT fingerprint, block_id, k, avg_score FROM (
        SELECT g.*, k, row_number() OVER (PARTITION BY fingerprint ORDER BY avg_score DESC, g.block_id) AS r
        FROM g JOIN (SELECT 'b' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS block_id, source || '#' || lang || '/' || CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END || '#' || CAST(doc_id % 25 AS VARCHAR) AS k FROM documents) USING (block_id)) WHERE r <= 20),
    d AS (SELECT 'dcg_' || substr(sha256(fingerprint), 1, 16) AS group_id, fingerprint, count(*) AS n FROM t GROUP BY fingerprint),
    x AS (SELECT *, substr(group_id, 5, 1) < '8' AS same, substr(group_id, 5, 1) < '4' AS undone FROM d)
"""


def _stored_groups(spark: SparkSession, sf_dir: str) -> store.Store:
    """A store with the candidate groups of documents, saved twice, and decisions on all of them."""
    db = store.Store(spark, scratch_path(spark, "store"))
    db.init()
    groups = stored(dedup.candidate_groups(identities(spark, sf_dir)), "groups")
    db.save_groups(groups)
    db.save_groups(groups)
    verdict = F.when(F.substring("id", 5, 1) < "8", "same").otherwise("different")
    db.decide(groups.select(F.col("id").alias("group_id"), verdict.alias("decision"), F.lit("ann").alias("reviewer"), F.lit("").alias("reason")))
    return db


@query(_TRIMMED + "SELECT group_id AS id, CAST(n AS INTEGER) AS candidate_count, 'pending' AS status, n AS items, CASE WHEN same THEN 'same' ELSE 'different' END AS decision FROM x")
def saved_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, items and decisions as they are stored; saving again changes nothing."""
    db = _stored_groups(spark, sf_dir)
    n = db.read("duplicate_candidate_items").groupBy(F.col("group_id").alias("id")).agg(F.count("*").alias("items"))
    decided = db.read("duplicate_review_decisions").select(F.col("group_id").alias("id"), "decision")
    return db.read("duplicate_candidate_groups").join(n, "id").join(decided, "id").select("id", "candidate_count", "status", "items", "decision")


@query(_TRIMMED + """
    SELECT 'cqn_' || substr(sha256(group_id), 1, 16) AS id, substr(sha256(fingerprint), 1, 16) AS canonical_fingerprint, group_id AS created_from_group_id, 'active' AS status, 'resolved' AS group_status, n AS variants, CAST(1 AS BIGINT) AS events
    FROM x WHERE same
""")
def canonicalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical questions of the groups that a reviewer called the same; a second run changes nothing."""
    db = _stored_groups(spark, sf_dir)
    db.canonicalize("ann")
    db.canonicalize("ann")
    return _canonical_state(db)


def _canonical_state(db: store.Store) -> DataFrame:
    n = db.read("question_variants").where("is_active").groupBy(F.col("canonical_question_id").alias("id")).agg(F.count("*").alias("variants"))
    events = db.read("canonicalization_events").groupBy(F.col("canonical_question_id").alias("id")).agg(F.count("*").alias("events"))
    group = db.read("duplicate_candidate_groups").select(F.col("id").alias("created_from_group_id"), F.col("status").alias("group_status"))
    rows = db.read("canonical_questions").join(n, "id", "left").join(events, "id", "left").join(group, "created_from_group_id")
    return rows.select("id", "canonical_fingerprint", "created_from_group_id", "status", "group_status", F.coalesce("variants", F.lit(0)).cast("long").alias("variants"), F.coalesce("events", F.lit(0)).cast("long").alias("events"))


@query(_TRIMMED + """
    SELECT 'cqn_' || substr(sha256(group_id), 1, 16) AS id, substr(sha256(fingerprint), 1, 16) AS canonical_fingerprint, group_id AS created_from_group_id, CASE WHEN undone THEN 'reverted' ELSE 'active' END AS status,
           'resolved' AS group_status, CASE WHEN undone THEN 0 ELSE n END AS variants, CAST(CASE WHEN undone THEN 2 ELSE 1 END AS BIGINT) AS events
    FROM x WHERE same
""")
def rolled_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some canonical questions reverted; ids that do not exist are ignored."""
    db = _stored_groups(spark, sf_dir)
    db.canonicalize("ann")
    undone = db.read("canonical_questions").where(F.substring("created_from_group_id", 5, 1) < "4").select("id")
    db.rollback(undone.unionByName(spark.createDataFrame([("cqn_none",)], "id string")), "ann")
    return _canonical_state(db)


@query("""
    WITH c AS (SELECT doc_id, source, lang, substr(sha256(coalesce(lang, '') || '|' || CAST(n_chars AS VARCHAR)), 1, 16) AS h FROM documents)
    SELECT 'ca_' || substr(sha256(h), 1, 16) AS id, substr(sha256(h), 1, 16) AS asset_fingerprint, h AS content_hash, min(lang) AS asset_type, 'a' || lpad(CAST(min(doc_id) AS VARCHAR), 12, '0') AS representative_raw_asset_id, 'active' AS status, count(*) AS variants
    FROM c GROUP BY h HAVING count(DISTINCT source) >= 2 AND min(lang) = max(lang)
""")
def canonical_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical assets and their variants, generated twice and read from the store."""
    db = store.Store(spark, scratch_path(spark, "store"))
    db.init()
    d = _t(spark, sf_dir, "documents")
    content = text.short_hash(F.concat_ws("|", F.coalesce("lang", F.lit("")), F.col("n_chars").cast("string")))
    db.upsert("raw_assets", d.select(F.format_string("a%012d", "doc_id").alias("id"), F.col("source").alias("paper_id"), F.col("lang").alias("asset_type"), content.alias("content_hash")))
    db.generate_canonical_assets()
    db.generate_canonical_assets()
    n = db.read("asset_variants").where("is_active").groupBy(F.col("canonical_asset_id").alias("id")).agg(F.count("*").alias("variants"))
    return db.read("canonical_assets").join(n, "id").select("id", "asset_fingerprint", "content_hash", "asset_type", "representative_raw_asset_id", "status", "variants")


@query("""
    WITH a AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS paper_id, CASE WHEN o_orderstatus = 'F' THEN 'image' WHEN o_orderstatus = 'O' THEN 'table' ELSE 'figure' END AS kind FROM orders),
    l AS (SELECT a.paper_id, count(*) AS links, sum(CASE WHEN 1 - l_discount * 4 < 0.8 THEN 1 ELSE 0 END) AS weak_links, sum(CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20) THEN 1 ELSE 0 END) AS broken_links
          FROM lineitem JOIN a ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT a.paper_id, count(*) AS assets, coalesce(max(links), 0) AS links, CAST(coalesce(max(weak_links), 0) AS BIGINT) AS weak_links,
           CAST(sum(CASE WHEN kind IN ('image', 'table') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN 1 ELSE 0 END) AS BIGINT) AS unlinked, CAST(coalesce(max(broken_links), 0) AS BIGINT) AS broken_links
    FROM a LEFT JOIN l USING (paper_id) GROUP BY 1
""")
def asset_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, weak, missing and broken ones of each paper, by the report's own operator."""
    kind = F.when(F.col("o_orderstatus") == "F", "image").when(F.col("o_orderstatus") == "O", "table").otherwise("figure")
    assets = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("paper_id"), kind.alias("asset_type"))
    links = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("raw_asset_id"), F.col("l_suppkey").alias("question_id"), (1 - F.col("l_discount") * 4).alias("confidence"))
    blocks = _t(spark, sf_dir, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("id"))
    m = reports.asset_metrics(assets, links, blocks)
    return m.select("paper_id", "assets", *[_int(F.col(c)).alias(c) for c in ("links", "weak_links", "unlinked", "broken_links")])


@query("""
    SELECT CAST(conv_id AS VARCHAR) AS paper_id, CAST(turn + 1 AS VARCHAR) AS question_number, length(t) AS chars FROM (
        SELECT conv_id, turn, regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '^[\\s\\p{Z}\\x0B]+|[\\s\\p{Z}\\x0B]+\\z', '', 'g') AS t FROM conversations) WHERE length(t) > 0
""")
def answer_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows each number, by the segmentation's own operator."""
    found = segment.answer_entries(_as_markdown(spark, sf_dir))
    return found.select("paper_id", "question_number", _int(F.length("entry")).alias("chars"))


@query("""
    WITH r AS (SELECT user_id, list(event_type || CASE WHEN value < 1 THEN '' ELSE ': ' || CAST(event_id AS VARCHAR) END ORDER BY event_id) FILTER (WHERE value < 3) AS steps,
                      list(CAST(event_id AS VARCHAR) ORDER BY event_id) FILTER (WHERE value >= 30) AS errors FROM events GROUP BY 1)
    SELECT CAST(user_id AS VARCHAR) AS paper_id, CASE WHEN len(errors) > 0 THEN array_to_string(errors, '; ') WHEN len(steps) > 0 THEN array_to_string(steps, '; ') END AS summary FROM r
""")
def error_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors of a run, or else its failed steps, in one line."""
    e = _t(spark, sf_dir, "events").withColumn("paper_id", F.col("user_id").cast("string"))
    steps = e.select("paper_id", F.col("event_id").alias("ord"), F.col("event_type").alias("step"), F.when(F.col("value") < 3, "failed").otherwise("completed").alias("status"), F.when(F.col("value") >= 1, F.col("event_id").cast("string")).alias("error"))
    errors = e.where("value >= 30").select("paper_id", F.col("event_id").alias("ord"), F.col("event_id").cast("string").alias("error"))
    return reports.error_summaries(steps, errors)


@query("""
    WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '{"stem_latex": 1}' WHEN turn % 3 = 1 THEN text ELSE NULL END AS content FROM conversations)
    SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'missing required fields' WHEN turn % 3 = 1 THEN 'not a JSON object' ELSE 'unexpected shape' END AS problem,
           CASE WHEN turn % 3 = 0 THEN 'analysis_latex, answer_latex, choices, confidence, difficulty, knowledge_points, question_type, warnings' END AS missing
    FROM t
""")
def provider_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of chat responses, and what is wrong with them."""
    content = F.when(F.col("turn") % 3 == 0, '{"stem_latex": 1}').when(F.col("turn") % 3 == 1, F.col("text"))
    message = F.struct(F.struct(content.alias("content")).alias("message"))
    raw = F.to_json(F.struct(F.array(message).alias("choices")))
    parsed = rules.parsed_response(rules.chat_content(raw))
    return turns(spark, sf_dir).withColumn("p", parsed).select("conv_id", "turn", F.col("p.problem").alias("problem"), F.array_join("p.missing", ", ").alias("missing"))


@query("""
    WITH m AS (SELECT source, row_number() OVER (ORDER BY source) AS n FROM (SELECT DISTINCT source FROM documents)),
    s AS (SELECT source, max(doc_id) % 2 = 0 AS fine FROM documents GROUP BY 1)
    SELECT 'exam_' || lpad(CAST(n AS VARCHAR), 4, '0') AS paper_id, source AS pdf_path, CASE WHEN fine THEN 'completed' ELSE 'failed' END AS status, 1 AS attempts, CASE WHEN NOT fine THEN 'broke' END AS last_error, NOT fine AS again
    FROM m JOIN s USING (source)
""")
def manifest_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch's manifest saved, read, updated by paper, and what a resumed batch would run."""
    d = _t(spark, sf_dir, "documents").groupBy("source").agg((F.max("doc_id") % 2 == 0).alias("fine"))
    path = scratch_path(spark, "manifest")
    exports.save_manifest(exports.manifest(d.select(F.col("source").alias("path")), "exam"), path)
    entries = exports.load_manifest(spark, path)
    done = entries.join(d, F.col("pdf_path") == F.col("source"))
    changes = done.select("paper_id", F.when(F.col("fine"), "completed").otherwise("failed").alias("status"), (F.col("attempts") + 1).alias("attempts"), F.when(~F.col("fine"), "broke").alias("last_error"))
    updated_entries = store.update(entries, changes, ("paper_id",))
    again = exports.to_run(updated_entries).select("paper_id", F.lit(True).alias("again"))
    return updated_entries.join(again, "paper_id", "left").select("paper_id", "pdf_path", "status", F.col("attempts").cast("int").alias("attempts"), "last_error", F.coalesce("again", F.lit(False)).alias("again"))


# Reports


@query("""
    WITH s AS (SELECT event_type AS step, user_id AS paper_id, event_id, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS us FROM events)
    SELECT step, count(*) AS n, round(sum(us) / 1e6, 3) AS total_s, round(avg(us) / 1e6, 3) AS avg_s, round(max(us) / 1e6, 3) AS max_s, arg_max(CAST(paper_id AS VARCHAR), us * 10000000 - event_id) AS slowest_paper FROM s WHERE us IS NOT NULL GROUP BY 1
""")
def step_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time in each step and the slowest paper."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _t(spark, sf_dir, "events").select(F.col("event_type").alias("step"), F.col("user_id").cast("string").alias("paper_id"), F.col("event_id").alias("ord"), F.col("ts").alias("started_at"), F.lead("ts").over(w).alias("finished_at"))
    t = reports.step_timings(e)
    return t.select("step", "n", *[F.round(c, 3).alias(c) for c in ("total_s", "avg_s", "max_s")], "slowest_paper")


@query("SELECT event_type AS code, count(*) AS n FROM events GROUP BY 1")
def warning_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings by code."""
    e = _t(spark, sf_dir, "events").select(F.concat_ws(": ", "event_type", "props").alias("warning"))
    return reports.warning_histogram(e)


_RUNS = """
    WITH r AS (SELECT user_id, CASE WHEN sum(CASE WHEN value < 1 THEN 1 ELSE 0 END) > 3 THEN 'failed' WHEN sum(CASE WHEN value < 2 THEN 1 ELSE 0 END) > 3 THEN 'partial' ELSE 'completed' END AS status,
               count(*) AS questions, sum(CASE WHEN value >= 2 THEN 1 ELSE 0 END) AS passed, sum(CASE WHEN value >= 1 AND value < 2 THEN 1 ELSE 0 END) AS warned, sum(CASE WHEN value < 1 THEN 1 ELSE 0 END) AS failed_questions FROM events GROUP BY 1)
"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    low = lambda v: F.count_if(F.col("value") < v)
    status = F.when(low(1) > 3, "failed").when(low(2) > 3, "partial").otherwise("completed")
    return e.groupBy("user_id").agg(status.alias("status"), F.count("*").alias("questions"), F.count_if(F.col("value") >= 2).alias("passed"), F.count_if((F.col("value") >= 1) & (F.col("value") < 2)).alias("warned"), low(1).alias("failed_questions"), F.lit(2).alias("pages"))


@query(_RUNS + """
    SELECT count(*) AS papers, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'partial') AS partial, count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(questions) AS BIGINT) AS questions,
           round(sum(passed) / sum(questions), 4) AS pass_rate, round(sum(warned) / sum(questions), 4) AS warning_rate, round(3600.0 / count(*), 1) AS sec_per_paper, round(3600.0 / sum(questions), 1) AS sec_per_question,
           CASE WHEN sum(failed_questions) > 0 OR count(*) FILTER (WHERE status = 'failed') > 0 THEN 'BLOCKED' WHEN sum(warned) / sum(questions) > 0.3 THEN 'CONDITIONAL' ELSE 'PASS' END AS verdict
    FROM r
""")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, rates and the verdict of a batch."""
    s = reports.batch_summary(_runs(spark, sf_dir), 3600.0)
    verdict = reports.structure_verdict(F.col("passed"), F.col("warned"), F.col("failed_questions"), F.col("failed"))
    return s.select("papers", "completed", "partial", "failed", "questions", "pass_rate", "warning_rate", "sec_per_paper", "sec_per_question", verdict.alias("verdict"))


@query("""
    SELECT lang AS stratum, count(*) AS papers, CAST(sum(n_chars) AS BIGINT) AS blocks, CAST(sum(CASE WHEN n_chars < 500 THEN 1 ELSE 0 END) AS BIGINT) AS warnings, CAST(grouping(lang) AS INTEGER) AS overall FROM documents GROUP BY ROLLUP (lang)
""")
def strata_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by stratum and over all."""
    d = _t(spark, sf_dir, "documents").select(F.col("lang").alias("stratum"), F.col("n_chars").alias("blocks"), (F.col("n_chars") < 500).cast("int").alias("warnings"))
    return reports.strata_summary(d)


@query("SELECT l_returnflag AS type, count(*) AS n, CAST(sum(CASE WHEN l_linestatus IN ('O') THEN 1 ELSE 0 END) AS BIGINT) AS visual FROM lineitem GROUP BY 1")
def element_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type."""
    return _t(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("type")).agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus").isin("O")).alias("visual"))


@query("""
    SELECT source AS paper_id, n, CAST(row_number() OVER (ORDER BY source) AS INTEGER) AS number, 'exam_' || lpad(CAST(row_number() OVER (ORDER BY source) AS VARCHAR), 4, '0') AS entry FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1)
""")
def manifest_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered entries of a batch."""
    s = _t(spark, sf_dir, "documents").groupBy(F.col("source").alias("paper_id")).agg(F.count("*").alias("n"))
    s = s.withColumn("number", F.row_number().over(Window.orderBy("paper_id"))).withColumn("entry", F.format_string("exam_%04d", "number"))
    return s.select("paper_id", "n", text.split_numbered_id(F.col("entry"), "exam")["number"].alias("number"), "entry")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def hourly_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps by hour of event time; the same expression runs on streams."""
    e = _t(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return e.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


@query(f"SELECT CAST(doc_id AS BIGINT) AS block_id, source AS paper_id, CASE WHEN length(regexp_replace(text, '[\\s\\p{{Z}}\\x0B]+', '', 'g')) > 0 THEN {_FP} ELSE '' END AS text_fingerprint FROM documents")
def streamed_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities as the stream of new documents makes them."""
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("block_id"), F.col("source").alias("paper_id"), "text")
    return identified(d).select("block_id", "paper_id", "text_fingerprint")
