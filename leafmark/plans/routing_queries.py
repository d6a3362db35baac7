"""Registered queries over page kinds, read lines, language evidence, evaluation forms, heading numbers and paired effects.

Page measures, confidences and lines are made from the standard tables by the same SQL in both engines, so they grow with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import routing
from ..sources.tables import bound_batches, table
from .layout_queries import _BOXES, _CELLS, _duck, _rows
from .queries import ORACLE_SQL, QUERIES, _query  # noqa: F401

_PAGES = """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN doc_id % 40 ELSE length(text) END AS chars, doc_id % 6 AS images, doc_id % 100 / 100e0 AS coverage, doc_id % 7 = 0 AS whole, doc_id % 5 AS tables,
doc_id % 41 = 0 AS hidden_layer, doc_id % 43 = 0 AS hidden_only, doc_id * 37 % 100 / 100e0 AS score FROM @documents"""


@_query(f"""SELECT doc_id, page_type, page_type NOT IN ('NATIVE_TEXT', 'PRODUCT_SHOWCASE_COLLAGE') AS read_again, CASE page_type WHEN 'NATIVE_TEXT' THEN 'native' WHEN 'MIXED' THEN 'mixed' ELSE 'scan' END AS category FROM (
SELECT doc_id, CASE WHEN hidden_layer THEN 'SCANNED_WITH_OCR_LAYER' WHEN hidden_only THEN 'NATIVE_TEXT_LOW_QUALITY' WHEN chars < 30 THEN if(images > 0, 'SCANNED_IMAGE', 'IMAGE_ONLY')
WHEN images >= 4 AND chars < 400 AND tables = 0 THEN 'PRODUCT_SHOWCASE_COLLAGE' WHEN score >= 0.9 THEN if(NOT whole AND coverage > 0.4 AND images > 0, 'MIXED', 'NATIVE_TEXT')
WHEN score < 0.7 OR coverage > 0.5 OR whole THEN 'NATIVE_TEXT_LOW_QUALITY' ELSE 'MIXED' END AS page_type FROM ({_duck(_PAGES)}))""")
def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind of each page, whether it is read again, and its category."""
    kind = routing.page_type(*map(F.col, ("chars", "images", "coverage", "whole", "tables", "hidden_layer", "hidden_only", "score")))
    pages = _rows(spark, sf_dir, _PAGES).select("doc_id", kind.alias("page_type"))
    return pages.select("doc_id", "page_type", routing.is_read_again(F.col("page_type")).alias("read_again"), routing.page_category(F.col("page_type")).alias("category"))


@_query("""SELECT user_id, day, CASE WHEN complete AND NOT (arena OR cuda OR gpu OR other) THEN 'COMPLETED' WHEN arena THEN 'ARENA_OUT_OF_MEMORY' WHEN cuda THEN 'CUDA_OUT_OF_MEMORY' WHEN gpu THEN 'MISSING_GPU_INFERENCE'
WHEN other THEN 'ERROR' ELSE 'INTERRUPTED' END AS state FROM (SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'purchase') AS complete, bool_or(event_type = 'error' AND event_id % 5 = 0) AS arena,
bool_or(event_type = 'error' AND event_id % 5 = 1) AS cuda, bool_or(event_type = 'error' AND event_id % 5 = 2) AS gpu, bool_or(event_type = 'error' AND event_id % 5 > 2) AS other FROM events GROUP BY 1, 2)""")
def attempt_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each attempt by the signatures in its log (P19); a user's day stands for an attempt."""
    kinds = ["ARENA_OUT_OF_MEMORY", "CUDA_OUT_OF_MEMORY", "MISSING_GPU_INFERENCE"]
    failed, which = F.col("event_type") == "error", F.col("event_id") % 5
    flags = [F.bool_or(failed & (which == i)).alias(k) for i, k in enumerate(kinds)]
    days = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.bool_or(F.col("event_type") == "purchase").alias("complete"), *flags, F.bool_or(failed & (which > 2)).alias("ERROR"))
    return days.select("user_id", "day", routing.attempt_state(F.col("complete"), *((k, F.col(k)) for k in [*kinds, "ERROR"])).alias("state"))


LEXICON = ["the", "and", "of", "der", "und", "les"]
_READ = """SELECT doc_id, n, line, CASE WHEN (doc_id + n) % 11 <> 0 THEN (doc_id * 31 + n * 7 + length(line)) % 100 / 100e0 END AS confidence FROM ({}) AS x"""
_SPARK_LINES = "SELECT doc_id, n, line FROM (SELECT doc_id, posexplode(split(text, '\\n')) AS (n, line) FROM @documents) AS y"
_DUCK_LINES = "SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n, unnest(string_split(text, chr(10))) AS line FROM documents"
_LOW = "lower(regexp_replace(line, '^\\s+|\\s+$', '', 'g'))"
_N = "length(regexp_replace(low, '[^{}]', '', 'g'))"
_GATE = f"""WITH r AS ({_READ.format(_DUCK_LINES)}), a AS (SELECT *, {_LOW} AS low, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS bare FROM r),
m AS (SELECT *, {_N.format("0-9")} AS digits, {_N.format("\\p{L}")} AS letters, {_N.format(routing.VOWELS)} AS vowels,
len(list_intersect(list_transform(regexp_split_to_array(low, '\\s+'), lambda w: regexp_replace(w, '[^\\p{{L}}]', '', 'g')), {LEXICON})) > 0 AS known FROM a),
v AS (SELECT doc_id, n, CASE WHEN confidence < 0.6 THEN 'REJECTED_LOW_CONFIDENCE' WHEN NOT regexp_matches(bare, '[\\p{{L}}\\p{{N}}]') THEN 'REJECTED_HALLUCINATION'
WHEN regexp_full_match(bare, '[1lI|/\\\\_zE.,\\s-]+') AND len(list_filter(regexp_split_to_array(bare, '\\s+'), lambda x: length(x) > 2)) = 0 THEN 'REJECTED_HALLUCINATION'
WHEN confidence >= 0.8 THEN CASE WHEN letters >= 5 AND digits = 0 AND vowels = 0 THEN 'REJECTED_HALLUCINATION' END
WHEN digits >= 2 OR digits > 0 AND regexp_matches(bare, '{routing.UNITS}') OR known OR regexp_matches(low, '[{routing.VIETNAMESE}]') THEN NULL
WHEN letters >= 3 THEN CASE WHEN vowels / letters NOT BETWEEN 0.15 AND 0.85 THEN 'REJECTED_HALLUCINATION' END WHEN letters > 0 AND digits = 0 THEN 'REJECTED_HALLUCINATION' END AS reason FROM m)"""


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _rows(spark, sf_dir, _READ.format(_SPARK_LINES))
    return lines.withColumn("reason", routing.rejection(F.col("line"), F.col("confidence"), LEXICON))


@_query(f"{_GATE} SELECT doc_id, count(*) AS lines, count(*) FILTER (reason IS NULL) AS taken, count(*) FILTER (reason = 'REJECTED_LOW_CONFIDENCE') AS unsure, count(*) FILTER (reason = 'REJECTED_HALLUCINATION') AS noise FROM v GROUP BY 1")
def line_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines taken and rejected, by reason."""
    is_ = lambda r: F.count_if(F.col("reason") == f"REJECTED_{r}")
    return _gated(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(F.isnull("reason")).alias("taken"), is_("LOW_CONFIDENCE").alias("unsure"), is_("HALLUCINATION").alias("noise"))


@_query(f"{_GATE} SELECT doc_id, n, reason FROM v WHERE reason IS NOT NULL")
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side output of the gate: every rejected line with its reason."""
    return _gated(spark, sf_dir).where("reason is not null").select("doc_id", "n", "reason")


_TALKS = "SELECT conv_id, turn % 3 AS page, CASE turn % 4 WHEN 0 THEN text WHEN 1 THEN substr(text, 1, 2) WHEN 2 THEN substr(text, 1, 1 + conv_id % 4) ELSE 'I' END AS line FROM @conversations"


@_query(f"""SELECT conv_id, page, lines, lines = 0 OR lines <= 20 AND short / lines >= 0.4 AND words < 3 OR short / lines >= 0.35 AND words < 12 OR strokes / lines >= 0.25 OR chars / lines < 3.2 AND words / lines <= 0.15
OR chars / lines < 3.0 AND words <= 2 AS noise FROM (SELECT conv_id, page, count(*) FILTER (n > 0) AS lines, count(*) FILTER (n BETWEEN 1 AND 2) AS short, count(*) FILTER (t IN {tuple(routing.STROKES)}) AS strokes,
count(*) FILTER (n >= 4) AS words, sum(n) AS chars FROM (SELECT *, length(t) AS n FROM (SELECT conv_id, page, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS t FROM ({_duck(_TALKS)}))) GROUP BY 1, 2)""")
def noisy_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of loose glyphs."""
    pages = _rows(spark, sf_dir, _TALKS).withColumn("at", F.struct("conv_id", "page"))
    return routing.glyph_noise(pages, "at", "line").select("at.conv_id", "at.page", "lines", "noise")


_MIXED = "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN concat(text, ' cong ty') WHEN 1 THEN 'doanh thu, loi nhuan' WHEN 2 THEN concat('The cash flow of 2024. ', text) WHEN 3 THEN 'Báo cáo tài chính' WHEN 4 THEN '12 ab' ELSE text END AS text FROM @documents"
_HAS = lambda phrases: " OR ".join(f"contains(joined, ' {p} ')" for p in phrases)


@_query(f"""WITH a AS (SELECT doc_id, lower(nfc_normalize(coalesce(text, ''))) AS low FROM ({_duck(_MIXED)})), b AS (SELECT *, regexp_extract_all(low, '[a-z]+') AS tokens, {_N.format("\\p{L}")} AS letters, {_N.format(routing.VIETNAMESE)} AS marked FROM a),
c AS (SELECT *, ' ' || array_to_string(tokens, ' ') || ' ' AS joined, len(list_intersect(list_distinct(tokens), {routing.ENGLISH_WORDS})) AS hits FROM b),
d AS (SELECT *, {_HAS(routing.VIETNAMESE_PHRASES)} AS vi, {_HAS(routing.ENGLISH_PHRASES)} OR hits >= 2 AND hits >= 0.25 * len(tokens) AS en, {_N.format("a-z")} < letters AS far FROM c)
SELECT doc_id, CASE WHEN letters < 4 THEN 'unknown' WHEN marked >= 0.03 * letters THEN 'vi' WHEN far OR vi = en THEN 'unknown' WHEN vi THEN 'vi' ELSE 'en' END AS language,
CASE WHEN letters < 4 THEN 'insufficient_lexical_evidence' WHEN marked >= 0.03 * letters THEN 'vietnamese_character_ratio' WHEN far OR NOT vi AND NOT en THEN 'insufficient_lexical_evidence' WHEN vi AND en THEN 'mixed_lexical_evidence'
WHEN vi THEN 'unaccented_vietnamese_phrase' ELSE 'english_lexical_evidence' END AS reason FROM d""")
def language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vietnamese, English or unknown, with the reason."""
    return _rows(spark, sf_dir, _MIXED).select("doc_id", F.inline(F.array(routing.language_evidence(F.col("text")))))


@_query("""SELECT doc_id, sha256(v) AS visible, sha256(trim(regexp_replace(v, '[ \\t\\n]+', ' ', 'g'))) AS reading FROM (SELECT doc_id, replace(replace(nfc_normalize(coalesce(replace(text, '. ', '.' || chr(13) || chr(10)), '')), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS v FROM documents)""")
def text_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the visible and the reading form of every text."""
    text = F.replace("text", F.lit(". "), F.lit(".\r\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(routing.visible_text(text), 256).alias("visible"), F.sha2(routing.reading_text(text), 256).alias("reading"))


_NL = "chr(10)"
_MARKDOWN = "SELECT doc_id, source, concat('# Trang ', doc_id, ' of it', chr(10), '> **Header**: a  b', chr(10), '## Title', chr(10), '---', chr(10), '| a | b |', chr(10), '| --- | :-: |', chr(10), text) AS text FROM @documents"
_STEPS = "nfc_normalize(coalesce(text, ''))"
for _p in (r"^#+\s*Trang\s+\d+.*$", r"^>\s*\*{1,2}(?:Header|Footer)\*{1,2}:\s*", r"^#+\s*", r"^---\s*$", r"^\|\s*[-:\s|]+\|\s*$"):
    _STEPS = f"regexp_replace({_STEPS}, '(?m){_p}', '', 'g')"
_EVAL = "list_transform(list_filter(list_transform(regexp_split_to_array({}, '\\r\\n|[\\n\\r]'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), lambda x: CASE WHEN x LIKE '|%|' THEN trim(x[2:-2]) ELSE x END)"


@_query(f"SELECT doc_id, len(lines) AS lines, sha256(array_to_string(lines, {_NL})) AS digest FROM (SELECT doc_id, {_EVAL.format(_STEPS)} AS lines FROM ({_duck(_MARKDOWN)}))")
def evaluation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the marks of a rendered page, as they are compared (F16)."""
    lines = _rows(spark, sf_dir, _MARKDOWN).select("doc_id", routing.evaluation_lines(F.col("text")).alias("lines"))
    return lines.select("doc_id", F.size("lines").alias("lines"), F.sha2(F.array_join("lines", "\n"), 256).alias("digest"))


@_query(f"""WITH a AS (SELECT doc_id, list_filter(l, lambda x: length(x) > 15) AS r, array_to_string(list_sort(l), {_NL}) AS p FROM (SELECT doc_id, {_EVAL.format(_STEPS)} AS l FROM documents)),
b AS (SELECT doc_id, len(r) AS n, list_filter(list_transform(r, lambda x: instr(p, x[1:25])), lambda i: i > 0) AS pos FROM a)
SELECT doc_id, CASE WHEN n <= 1 THEN 1.0 ELSE round(len(list_filter(range(1, len(pos) + 1), lambda i: i = 1 OR pos[i] >= pos[i - 1])) / n, 4) END AS in_order FROM b""")
def reading_order_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of lines found in order in a text whose lines were sorted."""
    bound_batches(spark)
    docs = table(spark, sf_dir, "documents").withColumn("sorted", F.array_join(F.array_sort(routing.evaluation_lines(F.col("text"))), "\n"))
    return docs.select("doc_id", routing.reading_order_share(F.col("text"), F.col("sorted")).alias("in_order"))


FORMS = {"AND": "ANĐ", "DER": "ĐER", "DES": "ĐES", "DE": "ĐE"}


@_query(f"""SELECT doc_id, form, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(upper(text), '\\p{{L}}+')) AS form FROM documents) WHERE form IN {tuple(FORMS)} GROUP BY 1, 2""")
def restored_acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-token acronyms that would get their stroked letter, per text (F36); `routing.with_strokes` writes them."""
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(routing.whole_tokens(F.upper("text"), list(FORMS))).alias("form"))
    return found.groupBy("doc_id", "form").agg(F.count("*").alias("n"))


_FIRMS = "SELECT o_orderkey, CASE o_custkey % 5 WHEN 0 THEN ' Unknown ' WHEN 1 THEN '' WHEN 2 THEN concat(' Firm ', o_custkey) WHEN 3 THEN concat('Firm-', o_custkey, ' ') END AS name FROM @orders"


@_query(f"SELECT o_orderkey, CASE WHEN s = '' THEN 'unknown' WHEN NOT regexp_matches(s, '\\s') THEN s END AS id, NOT regexp_matches(s, '\\s') AS valid FROM (SELECT o_orderkey, lower(regexp_replace(coalesce(name, ''), '^\\s+|\\s+$', '', 'g')) AS s FROM ({_duck(_FIRMS)}))")
def company_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable company ids; names with blanks inside are reported."""
    return _rows(spark, sf_dir, _FIRMS).select("o_orderkey", F.inline(F.array(routing.company_id(F.col("name")))))


_ROWS = "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN concat('năm ', o_orderkey) WHEN 1 THEN concat(o_orderpriority, ' 1.234.567 (12) -') WHEN 2 THEN concat(o_orderpriority, '  ', o_orderkey, ' 45,5%') WHEN 3 THEN concat(o_orderkey, ' (1.234,5)') WHEN 4 THEN concat('12 ', o_orderpriority) ELSE '' END AS line FROM @orders"


@_query(f"""SELECT o_orderkey, CASE WHEN lower(said) IN {tuple(routing.PERIODS)} THEN trim(line) ELSE array_to_string(CASE WHEN said = '' THEN w[last + 1:] ELSE list_concat([said], w[last + 1:]) END, ' ; ') END AS parts FROM
(SELECT *, array_to_string(w[1:last], ' ') AS said FROM (SELECT *, coalesce(list_max(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN regexp_matches(w[i], '{routing.AMOUNT}') THEN 0 ELSE i END)), 0) AS last
FROM (SELECT *, list_filter(regexp_split_to_array(trim(line), '\\s+'), lambda x: x <> '') AS w FROM ({_duck(_ROWS)}))))""")
def trailing_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The description and the amounts that end a row of text."""
    return _rows(spark, sf_dir, _ROWS).select("o_orderkey", F.array_join(routing.trailing_amounts(F.col("line")), " ; ").alias("parts"))


_HEADS = "SELECT doc_id, concat(CASE doc_id % 9 WHEN 0 THEN 'Chương IV ' WHEN 1 THEN ' XIV. ' WHEN 2 THEN '2.3.1 ' WHEN 3 THEN 'B. ' WHEN 4 THEN '12) ' WHEN 5 THEN 'ĐIỀU 7. ' WHEN 6 THEN '1. 2024 ' WHEN 7 THEN 'Mục K ' ELSE '' END, substr(text, 1 + doc_id % 3)) AS text FROM @documents"
_VALUE = "CASE {0} WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 ELSE 0 END"
_ROMAN = f"CAST(list_sum(list_transform(range(1, length({{0}}) + 1), lambda i: CASE WHEN {_VALUE.format('{0}[i]')} < {_VALUE.format('{0}[i + 1]')} THEN -1 ELSE 1 END * {_VALUE.format('{0}[i]')})) AS INT)"


@_query(f"""WITH a AS (SELECT doc_id, regexp_replace(text, '^\\s+', '') AS t FROM ({_duck(_HEADS)})), b AS (SELECT doc_id, upper(regexp_extract(t, '(?i)^(?:{routing.PARTS})\\s+([IVXLC]+|\\d+|[A-Z])\\b', 1)) AS p,
regexp_extract(t, '^([IVXLC]+)\\s*[.)\\-–:]\\s+\\S', 1) AS r, regexp_extract(t, '^(\\d{{1,2}}(?:\\.\\d{{1,2}}){{0,3}})\\s*[.)\\-–:]?\\s+[^\\d\\s]', 1) AS d, regexp_extract(t, '^([A-ZĐ])\\s*[.)]\\s+\\S', 1) AS c FROM a)
SELECT doc_id, CASE WHEN p <> '' THEN 'keyword' WHEN r <> '' THEN 'roman' WHEN d <> '' THEN 'arabic' ELSE 'upper_alpha' END AS kind, CASE WHEN regexp_full_match(p, '[0-9]+') THEN p WHEN regexp_full_match(p, '[IVXLC]+') THEN {_ROMAN.format('p')}::VARCHAR WHEN p <> '' THEN '0'
WHEN r <> '' THEN {_ROMAN.format('r')}::VARCHAR WHEN d <> '' THEN d ELSE unicode(c)::VARCHAR END AS path FROM b WHERE p || r || d || c <> ''""")
def heading_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and path of the number that opens a heading."""
    found = _rows(spark, sf_dir, _HEADS).select("doc_id", routing.numbering(F.col("text")).alias("n")).where("n is not null")
    return found.select("doc_id", "n.kind", F.array_join(F.col("n.path").cast("array<string>"), ".").alias("path"))


_LISTED = f"SELECT table_id, row, CASE WHEN col = 1 AND (table_id + row) % 3 > 0 THEN concat(' ', row + 1, ' ') WHEN col = 2 AND table_id % 4 = 0 AND row = 2 THEN '1.234' WHEN col = 1 THEN '' ELSE text END AS text FROM ({_CELLS}) AS c"


@_query(f"""SELECT table_id, count(DISTINCT row) FILTER (t <> '') AS rows_filled, count(DISTINCT row) FILTER (regexp_full_match(t, '[0-9]{{1,3}}')) AS rows_numbered, NOT coalesce(bool_or(regexp_matches(t, '[0-9]{{1,3}}([.,][0-9]{{3}})+|[0-9]+,[0-9]+|%')), false)
AND rows_numbered >= 2 AND rows_numbered >= 0.4 * rows_filled AS is_index FROM (SELECT table_id, row, trim(text) AS t FROM ({_duck(_LISTED)})) GROUP BY 1""")
def index_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that list titles and page numbers (P11). A row is summed up first, so no set of rows is held."""
    cells = _rows(spark, sf_dir, _LISTED).select("table_id", "row", F.trim("text").alias("t"))
    per_row = cells.groupBy("table_id", "row").agg(F.bool_or(F.col("t") != "").alias("filled"), F.bool_or(F.col("t").rlike("^[0-9]{1,3}$")).alias("numbered"), F.bool_or(F.col("t").rlike("[0-9]{1,3}([.,][0-9]{3})+|[0-9]+,[0-9]+|%")).alias("amount"))
    counts = per_row.groupBy("table_id").agg(F.count_if("filled").alias("rows_filled"), F.count_if("numbered").alias("rows_numbered"), F.coalesce(F.bool_or("amount"), F.lit(False)).alias("amount"))
    return counts.select("table_id", "rows_filled", "rows_numbered", (~F.col("amount") & (F.col("rows_numbered") >= 2) & (F.col("rows_numbered") >= 0.4 * F.col("rows_filled"))).alias("is_index"))


_FONTS = "SELECT l_suppkey AS doc, l_orderkey AS page, 6 + (l_quantity + l_orderkey) % 9 AS size, l_partkey % 260 AS chars, l_returnflag = 'R' AS aside FROM @lineitem"


@_query(f"""WITH f AS ({_duck(_FONTS)}), e AS (SELECT doc, page, size, unnest(range(0, greatest(1, least(chars, 200)))) AS i FROM f WHERE NOT aside), d AS (SELECT doc, median(size) AS body FROM e GROUP BY 1), p AS (SELECT doc, page, median(size) AS own FROM e GROUP BY 1, 2),
c AS (SELECT doc, page, sum(chars) AS chars FROM f GROUP BY 1, 2) SELECT doc, page, CASE WHEN chars >= 300 AND own > body THEN own ELSE body END AS reference FROM c LEFT JOIN d USING (doc) LEFT JOIN p USING (doc, page)""")
def body_font_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body font size that each page's lines are measured against."""
    lines = _rows(spark, sf_dir, _FONTS).withColumn("weight", F.greatest(F.lit(1), F.least("chars", F.lit(200))))
    body = routing.weighted_median(lines.where("not aside"), ["doc"], "size", "weight").withColumnRenamed("median", "body")
    own = routing.weighted_median(lines.where("not aside"), ["doc", "page"], "size", "weight").withColumnRenamed("median", "own")
    pages = lines.groupBy("doc", "page").agg(F.sum("chars").alias("chars")).join(own, ["doc", "page"], "left").join(body, "doc", "left")
    return pages.select("doc", "page", F.when((F.col("chars") >= 300) & (F.col("own") > F.col("body")), F.col("own")).otherwise(F.col("body")).alias("reference"))


@_query(f"SELECT page, id, CASE WHEN x0 + x1 < 200 THEN 'L' ELSE 'R' END AS side, x0 - CASE WHEN x0 + x1 < 200 THEN 0 ELSE 100 END AS x0, x1 - CASE WHEN x0 + x1 < 200 THEN 0 ELSE 100 END AS x1 FROM ({_duck(_BOXES)})")
def spread_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a two-page spread on the page they belong to."""
    return _rows(spark, sf_dir, _BOXES).select("page", "id", F.inline(F.array(routing.half_of_spread(F.col("x0"), F.col("x1"), 100.0))))


_SPANS = f"SELECT page AS chain, id, kind AS page, x0, y0, x1, y1 FROM ({_BOXES}) AS b"


@_query(f"""WITH a AS (SELECT *, CASE WHEN page = lag(page) OVER w THEN 0 ELSE 1 END AS new FROM ({_duck(_SPANS)}) WINDOW w AS (PARTITION BY chain ORDER BY id)), b AS (SELECT *, sum(new) OVER (PARTITION BY chain ORDER BY id) AS span FROM a)
SELECT chain, span::BIGINT AS span, any_value(page) AS page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids FROM b GROUP BY 1, 2""")
def page_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive entries of one page as one span with the union of their boxes."""
    rows = routing.islands(_rows(spark, sf_dir, _SPANS), ["chain"], ["id"], "page")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda i: i.cast("string")), ",")
    return rows.groupBy("chain", F.col("island").alias("span")).agg(F.first("page").alias("page"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), ids.alias("ids"))


_RETRIED = "SELECT conv_id, turn, role, 1 + turn % 2 AS expected, text AS a, CASE conv_id % 3 WHEN 0 THEN replace(text, ' the ', ' a ') WHEN 1 THEN concat(text, ' the') ELSE text END AS b, conv_id % 10 > 0 AS labelled FROM @conversations"
_SAID = "len(list_filter(regexp_extract_all({}, '[\\p{{L}}\\p{{N}}_]+'), lambda w: w = 'the'))"
_EFFECTS = "count(*) FILTER (effect = 'fixed') AS fixed, count(*) FILTER (effect = 'harmed') AS harmed, count(*) FILTER (effect = 'preserved_correct') AS preserved_correct, count(*) FILTER (effect = 'still_wrong') AS still_wrong"


@_query(f"""WITH a AS (SELECT role, CASE WHEN labelled AND a IS NOT NULL THEN CASE WHEN {_SAID.format('a')} = expected THEN CASE WHEN {_SAID.format('b')} = expected THEN 'preserved_correct' ELSE 'harmed' END WHEN {_SAID.format('b')} = expected THEN 'fixed' ELSE 'still_wrong' END END AS effect FROM ({_duck(_RETRIED)})),
c AS (SELECT role, count(*) AS units, count(effect) AS paired, {_EFFECTS} FROM a GROUP BY 1)
SELECT *, CASE WHEN paired = units THEN 'MEASURED' WHEN paired > 0 THEN 'PARTIAL' ELSE 'NOT_EVALUATED' END AS status, fixed / nullif(fixed + still_wrong, 0) AS observed_fix_rate, harmed / nullif(harmed + preserved_correct, 0) AS observed_harm_rate,
CASE WHEN paired = units THEN fixed / nullif(fixed + still_wrong, 0) END AS fix_rate, CASE WHEN paired = units THEN harmed / nullif(harmed + preserved_correct, 0) END AS harm_rate FROM c""")
def retry_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a second reading gets the expected number of a phrase right, with rates where all units are labelled."""
    said = lambda c: F.regexp_count(c, F.lit(r"(?<![\p{L}\p{N}_])the(?![\p{L}\p{N}_])"))
    before, after = said(F.col("a")) == F.col("expected"), said(F.col("b")) == F.col("expected")
    effect = F.when(F.col("labelled") & F.isnotnull("a"), F.when(before & after, "preserved_correct").when(before, "harmed").when(after, "fixed").otherwise("still_wrong"))
    names = ["fixed", "harmed", "preserved_correct", "still_wrong"]
    rows = _rows(spark, sf_dir, _RETRIED).select("role", effect.alias("effect")).groupBy("role").agg(F.count("*").alias("units"), F.count("effect").alias("paired"), *(F.count_if(F.col("effect") == n).alias(n) for n in names))
    rate = lambda a, b: F.when(F.col(a) + F.col(b) > 0, F.col(a) / (F.col(a) + F.col(b)))
    fix, harm, whole = rate("fixed", "still_wrong"), rate("harmed", "preserved_correct"), F.col("paired") == F.col("units")
    status = F.when(whole, "MEASURED").when(F.col("paired") > 0, "PARTIAL").otherwise("NOT_EVALUATED")
    return rows.select("*", status.alias("status"), fix.alias("observed_fix_rate"), harm.alias("observed_harm_rate"), F.when(whole, fix).alias("fix_rate"), F.when(whole, harm).alias("harm_rate"))


_READ_ORDER = f"SELECT page, id AS r, row_number() OVER (PARTITION BY page ORDER BY y0, x0, id) AS p, id % 6 <> 0 AS matched FROM ({_BOXES}) AS b"


@_query(f"""WITH a AS ({_duck(_READ_ORDER)}), m AS (SELECT page, r, p, row_number() OVER (PARTITION BY page ORDER BY r) AS rr, row_number() OVER (PARTITION BY page ORDER BY p) AS pp FROM a WHERE matched),
s AS (SELECT page, count(*) AS total, count(*) FILTER (matched) AS n FROM a GROUP BY 1), q AS (SELECT x.page, avg((x.p < y.p)::INT) AS ok FROM m x JOIN m y ON x.page = y.page AND x.r < y.r GROUP BY 1), c AS (SELECT page, CASE WHEN count(*) < 2 THEN 1.0 ELSE corr(rr, pp) END AS rho FROM m GROUP BY 1)
SELECT page, round(coalesce(rho, 1.0), 4) + 0.0 AS spearman_rho, round(coalesce(ok, 1.0), 4) AS precedence_accuracy, n / total AS matched_coverage, round(round(coalesce(ok, 1.0), 4) * (n / total), 4) AS penalized_score FROM s LEFT JOIN q USING (page) LEFT JOIN c USING (page)""")
def precedence_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of pairs of matched blocks in the right order, rank correlation and coverage."""
    rows = _rows(spark, sf_dir, _READ_ORDER)
    w = Window.partitionBy("page", "matched")
    ranked = rows.withColumn("rr", F.row_number().over(w.orderBy("r"))).withColumn("pp", F.row_number().over(w.orderBy("p")))
    hit = lambda c: F.when(F.col("matched"), F.col(c))
    pages = ranked.groupBy("page").agg(F.count("*").alias("total"), F.count_if("matched").alias("n"), F.corr(hit("rr"), hit("pp")).alias("rho"), F.array_sort(F.collect_list(F.when(F.col("matched"), F.struct("rr", "pp")))).alias("m"))
    later = F.aggregate(F.transform("m", lambda x: F.size(F.filter("m", lambda y: (y["rr"] > x["rr"]) & (y["pp"] > x["pp"])))), F.lit(0), lambda a, v: a + v)
    pairs = F.col("n") * (F.col("n") - 1) / 2
    share = F.round(F.when(F.col("n") > 1, later / pairs).otherwise(1.0), 4)
    cover = F.col("n") / F.col("total")
    return pages.select("page", (F.round(F.when(F.col("n") > 1, F.col("rho")).otherwise(1.0), 4) + 0.0).alias("spearman_rho"), share.alias("precedence_accuracy"), cover.alias("matched_coverage"), F.round(share * cover, 4).alias("penalized_score"))
