"""Registered queries over lines of pages, headings, captions, cells and ranked boxes.

Lines are made from orders (a customer is a document, its orders are lines) and boxes and cells from lineitem, by the same SQL in both engines. Oracles are written
apart from the plans they check; what SQL cannot express is tested against plain versions in tests/test_structure.py.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import headings
from ..functions.routing import PARTS, numbering
from ..operators import structure
from . import routing_queries  # noqa: F401  registers its queries
from .layout_queries import _BOXES, _duck, _plain, _predicted, _rows
from .queries import ORACLE_SQL, QUERIES, _query  # noqa: F401

_SAID = """CASE o_orderkey % 21 WHEN 0 THEN '1. Tổng quan' WHEN 1 THEN '- mục đầu' WHEN 2 THEN concat('Ngày ', 1 + o_orderkey % 28, '/12/2024') WHEN 3 THEN 'Giám đốc' WHEN 4 THEN 'Nguyễn Văn An' WHEN 5 THEN ' 12 / 40 '
WHEN 6 THEN '1.234.567 triệu' WHEN 7 THEN 'Doanh thu 12.345.678.901' WHEN 8 THEN 'và các khoản khác,' WHEN 9 THEN concat('Tổng quan ..... ', o_orderkey % 90) WHEN 10 THEN 'Ghi chú:' WHEN 11 THEN 'Ông Trần Bình'
WHEN 12 THEN 'TÌNH HÌNH TÀI CHÍNH' WHEN 13 THEN 'FINANCIAL REVIEW' WHEN 14 THEN 'Chương II Kết quả' WHEN 15 THEN 'tiếp theo của câu trước.' WHEN 16 THEN 'Company overview' WHEN 17 THEN 'IV. Quản trị' WHEN 18 THEN 'a'
WHEN 19 THEN concat(o_orderpriority, ' của năm.') ELSE 'Câu này chưa hết và còn' END"""
_FLOW = f"""SELECT doc, n, page, CASE WHEN key % 13 = 0 THEN 'b' ELSE 'a' END AS place, CASE WHEN key % 17 = 0 THEN 'title' ELSE 'paragraph' END AS kind, x0, CASE WHEN key % 29 > 0 THEN y0 END AS y0, x0 + 200 AS x1, y0 + 11 AS y1,
CASE WHEN key % 11 = 0 THEN NULL WHEN key % 5 = 0 THEN 14e0 WHEN key % 7 = 0 THEN 9e0 ELSE 10e0 END AS size, key % 5 = 0 AS bold, key % 5 = 0 AS is_heading, key % 37 = 0 AS unresolved, text FROM (
SELECT *, CAST(floor((n - 1) / 8) + CASE WHEN key % 31 = 0 THEN 2 ELSE 0 END AS INT) AS page, 50e0 + CASE WHEN key % 6 = 0 THEN 15 ELSE 0 END AS x0, 40e0 + (n - 1) % 8 * 14 + key % 4 * 2 AS y0 FROM (
SELECT o_custkey AS doc, o_orderkey AS key, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS n, {_SAID} AS text FROM @orders) AS o) AS p"""

_W = "[^\\p{L}\\p{N}_]"
_T = "trim(text)"
_NUMBER = f"(regexp_matches(t, '(?i)^({PARTS})\\s+([IVXLC]+|\\d+|[A-Z])({_W}|$)') OR regexp_matches(t, '^[IVXLC]+\\s*[.)\\-–:]\\s+\\S') OR regexp_matches(t, '^\\d{{1,2}}(\\.\\d{{1,2}}){{0,3}}\\s*[.)\\-–:]?\\s+[^\\d\\s]') OR regexp_matches(t, '^[A-ZĐ]\\s*[.)]\\s+\\S'))"
_SIGNS = "[\\d\\s.,%()/:\\-–+]*"
_BULLET = "(regexp_matches(t, '^[-+*•–●▪]$') OR regexp_matches(t, '^[*•●▪]\\s') OR regexp_matches(t, '^[-+–]\\s+\\D'))"
_COUNT = "length(regexp_replace(t, '[^{}]', '', 'g'))"


@_query(f"""WITH f AS (SELECT *, {_T} AS t FROM ({_duck(_FLOW)})), g AS (SELECT *, {_NUMBER} AS numbered, len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) AS words, {_COUNT.format('0-9')} AS digits, {_COUNT.format('\\p{L}')} AS letters,
coalesce(lag(t) OVER w, '') AS a, coalesce(lag(t, 2) OVER w, '') AS b FROM f WINDOW w AS (PARTITION BY doc ORDER BY n))
SELECT doc, n, CASE WHEN y0 IS NULL THEN 'unplaced' WHEN unresolved THEN 'unresolved_table_source' WHEN {_BULLET} THEN 'bullet' WHEN regexp_matches(t, '(?i)^(trang\\s+)?\\d{{1,4}}(\\s*/\\s*\\d{{1,4}})?$') THEN 'page_number_like'
WHEN NOT numbered AND regexp_full_match(t, '(?i){_SIGNS}({headings.AMOUNT_UNITS})?{_SIGNS}') THEN 'amount_or_number' WHEN digits > 0.5 * greatest(letters, 1) THEN 'mostly_digits'
WHEN regexp_matches(t, '(?i)(^|{_W})\\d{{1,2}}[/.-]\\d{{1,2}}[/.-]\\d{{2,4}}({_W}|$)|ngày\\s+\\d+\\s+tháng\\s+\\d+') AND words <= 6 THEN 'date' WHEN letters < 3 AND NOT numbered THEN 'too_short' WHEN words > 25 OR t LIKE '%,' THEN 'sentence_like'
WHEN regexp_matches(t, '\\.{{3,}}\\s*\\d+$') THEN 'toc_line' WHEN t LIKE '%:' AND words <= 3 THEN 'label'
WHEN (regexp_matches(a, '(?i)^({headings.JOBS})({_W}|$)') OR regexp_matches(b, '(?i)^({headings.JOBS})({_W}|$)')) AND words BETWEEN 2 AND 5 AND NOT numbered AND digits = 0 AND len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: NOT regexp_matches(x, '^\\p{{Lu}}'))) = 0 THEN 'person_name'
WHEN regexp_matches(t, '(?i)^(ông|bà)\\s') AND words <= 6 THEN 'person_name' END AS reason FROM g""")
def heading_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a line cannot be a heading."""
    w = Window.partitionBy("doc").orderBy("n")
    lines = _rows(spark, sf_dir, _FLOW).withColumns({"a": F.lag("text").over(w), "b": F.lag("text", 2).over(w)})
    return lines.select("doc", "n", headings.heading_rejection(F.col("text"), [F.col("a"), F.col("b")], F.isnotnull("y0"), F.col("unresolved")).alias("reason"))


_ENDED, _LOWER = "regexp_matches(trim(q), '[.:;?!]$')", "regexp_matches(t, '^\\P{L}*\\p{Ll}')"


@_query(f"""WITH f AS (SELECT *, {_T} AS t FROM ({_duck(_FLOW)})), g AS (SELECT *, lag(t) OVER w AS q, lag(place) OVER w AS qp, lag(page) OVER w AS qg, lag(size) OVER w AS qs, lag(kind) OVER w AS qk, lag(x0) OVER w AS qx, lag(y0) OVER w AS qy0, lag(y1) OVER w AS qy1,
row_number() OVER w AS i FROM f WINDOW w AS (PARTITION BY doc ORDER BY n)), h AS (SELECT *, y0 - qy1 AS gap, {_ENDED} AS ended, {_LOWER} AS small FROM g),
k AS (SELECT doc, n, CASE WHEN i = 1 OR y0 IS NULL OR qy0 IS NULL OR qp <> place OR page NOT IN (qg, qg + 1) OR {_BULLET} OR {_NUMBER} OR coalesce(abs(qs - size) > 1.5, false) THEN 1
WHEN page <> qg OR gap < 0 AND NOT (y0 > qy0 AND kind = qk AND gap >= -0.25 * least(qy1 - qy0, y1 - y0)) THEN (ended OR NOT small)::INT WHEN gap > 0.6 * (qy1 - qy0) THEN 1 WHEN x0 - qx > 12 AND ended THEN 1 ELSE (ended AND NOT small)::INT END AS fresh FROM h)
SELECT doc, n, sum(fresh) OVER (PARTITION BY doc ORDER BY n)::BIGINT AS paragraph FROM k""")
def paragraph_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paragraph of each line, from its gap, indent, style and the sentence before it."""
    return structure.paragraphs(_rows(spark, sf_dir, _FLOW)).select("doc", "n", "paragraph")


_ENGLISH = "length(regexp_replace({0}, '[^\\p{{L}}]', '', 'g')) >= 4 AND length(regexp_replace({0}, '[^\\p{{L}}]', '', 'g')) = length(regexp_replace({0}, '[^A-Za-z]', '', 'g'))"


@_query(f"""WITH g AS (SELECT *, lead(n) OVER w AS m, lead(text) OVER w AS t, lead(is_heading) OVER w AS h, lead(kind) OVER w AS k, lead(bold) OVER w AS bo, lead(size) OVER w AS si, lead(page) OVER w AS pg, lead(x0) OVER w AS bx0, lead(x1) OVER w AS bx1, lead(y0) OVER w AS by0
FROM ({_duck(_FLOW)}) WINDOW w AS (PARTITION BY doc ORDER BY n))
SELECT doc, n, m AS translated_by, t AS text FROM g WHERE is_heading AND NOT h AND NOT ({_ENGLISH.format('text')}) AND {_ENGLISH.format('t')} AND len(regexp_split_to_array(trim(t), '\\s+')) <= 12 AND NOT regexp_matches(t, '[.:;?!]\\s*$')
AND (k IN ('title', 'section_header') OR bo OR upper(t) = t OR coalesce(si / 10 >= 1.1, false)) AND coalesce(si <= 0.95 * size, true) AND page = pg AND by0 - y1 BETWEEN -0.5 * (y1 - y0) AND 0.8 * (y1 - y0) AND (abs(x0 - bx0) <= 6 OR abs((x0 + x1) / 2 - (bx0 + bx1) / 2) <= 8)""")
def heading_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings with the English line below them."""
    return structure.translations(_rows(spark, sf_dir, _FLOW), F.lit(10.0))


@_plain
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of headings from their size, their number and the heading before."""
    said = numbering(F.col("text"))
    rank = F.element_at(F.create_map(*(F.lit(v) for pair in (("phần", 0), ("phụ lục", 0), ("chương", 1), ("mục", 2), ("điều", 3)) for v in pair)), F.lower(F.regexp_extract("text", rf"(?iu)^\s*({PARTS})\s", 1)))
    found = _rows(spark, sf_dir, _FLOW).where("is_heading OR kind = 'title'").withColumn("s", said)
    return structure.heading_levels(found.select("doc", "n", (F.col("size") / 8).alias("ratio"), "s.kind", "s.path", rank.alias("rank")))


_ENGINES = f"SELECT page, id, CASE WHEN id % 3 = 0 THEN 'native' ELSE 'heuristic' END AS engine, x0, y0, x1, y1 FROM ({_BOXES}) AS x WHERE id % 2 = 1"
_MODELS = f"SELECT page, id, x0, y0, x1, y1 FROM ({_BOXES}) AS x WHERE id % 2 = 0"
_SHARED = "greatest(least(t.x1, m.x1) - greatest(t.x0, m.x0), 0) * greatest(least(t.y1, m.y1) - greatest(t.y0, m.y0), 0)"


@_query(f"""SELECT page, id, engine, EXISTS (SELECT 1 FROM ({_duck(_MODELS)}) m WHERE m.page = t.page AND (({_SHARED}) / ((t.x1 - t.x0) * (t.y1 - t.y0)) >= 0.5 OR t.engine = 'heuristic' AND ({_SHARED}) / ((m.x1 - m.x0) * (m.y1 - m.y0)) >= 0.8)) AS superseded FROM ({_duck(_ENGINES)}) t""")
def table_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that give way to those found by a model."""
    return structure.table_preference(_rows(spark, sf_dir, _ENGINES), _rows(spark, sf_dir, _MODELS)).select("page", "id", "engine", "superseded")


_GRID = f"SELECT page, id * 10 + c AS cell, x0 + c * (x1 - x0) / 2 AS x0, y0, x0 + (c + 1) * (x1 - x0) / 2 AS x1, y1 FROM ({_MODELS}) AS m CROSS JOIN (VALUES (0), (1)) AS k(c)"
_WORDS = f"SELECT page, id, x0, y0, x0 + 24 AS x1, y0 + 9 AS y1 FROM ({_BOXES}) AS x"
_FRAMES = f"SELECT page, x0 - 4 AS x0, y0 - 4 AS y0, x1 + 4 AS x1, y1 + 4 AS y1 FROM ({_MODELS}) AS m"
_IN = "(w.x0 + w.x1) / 2 BETWEEN {0}.x0 AND {0}.x1 AND (w.y0 + w.y1) / 2 BETWEEN {0}.y0 AND {0}.y1"


@_query(f"""WITH w AS ({_duck(_WORDS)}), f AS ({_duck(_FRAMES)}), c AS ({_duck(_GRID)}), a AS (SELECT w.page, w.id, EXISTS (SELECT 1 FROM f WHERE f.page = w.page AND {_IN.format("f")}) AS framed,
(SELECT list(c.cell) FROM c WHERE c.page = w.page AND {_IN.format("c")}) AS cells, (SELECT bool_or(least((w.x0 + w.x1) / 2 - c.x0, c.x1 - (w.x0 + w.x1) / 2, (w.y0 + w.y1) / 2 - c.y0, c.y1 - (w.y0 + w.y1) / 2) < 2) FROM c WHERE c.page = w.page AND {_IN.format("c")}) AS near FROM w)
SELECT page, id, CASE WHEN NOT framed THEN 'outside_tables' WHEN cells IS NULL THEN 'in_table_no_cell' WHEN len(cells) = 1 THEN 'in_one_cell' ELSE 'in_several_cells' END AS place, CASE WHEN framed AND len(cells) = 1 THEN cells[1] END AS cell, framed AND coalesce(near, false) AS near_edge FROM a""")
def word_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell of each word by its centre, and words near a cell's edge."""
    return structure.cell_words(_rows(spark, sf_dir, _WORDS), _rows(spark, sf_dir, _GRID), _rows(spark, sf_dir, _FRAMES))


_COLUMNS = "SELECT DISTINCT l_orderkey AS table_id, c AS col, 60e0 * c + l_orderkey % 7 AS x0, 60e0 * c + l_orderkey % 7 + 38 AS x1 FROM @lineitem CROSS JOIN (VALUES (0), (1), (2), (3)) AS k(c)"
_HEADERS = f"SELECT page AS table_id, id, x0, x0 + CASE WHEN id % 3 = 0 THEN 8 ELSE 90 END AS x1 FROM ({_BOXES}) AS b"


@_query(f"""WITH b AS ({_duck(_HEADERS)}), c AS ({_duck(_COLUMNS)}), a AS (SELECT b.table_id, b.id, list(c.col ORDER BY c.col) FILTER (greatest(b.x0, c.x0) <= least(b.x1, c.x1) OR (b.x0 + b.x1) / 2 BETWEEN c.x0 AND c.x1) AS met, list(c.col ORDER BY abs(c.x0 - b.x0), c.col) AS near FROM b JOIN c USING (table_id) GROUP BY 1, 2)
SELECT table_id, id, coalesce(met[1], near[1]) AS col, coalesce(met[-1] - met[1], 0) + 1 AS col_span FROM a""")
def header_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column and span of header blocks over the columns of their table."""
    return structure.header_cells(_rows(spark, sf_dir, _HEADERS), _rows(spark, sf_dir, _COLUMNS))


_WRAPPED = """SELECT o_custkey AS table_id, r AS row, c AS col, CASE WHEN c = 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN concat('Long description of ', o_orderpriority) ELSE 'Sum ' END WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN ' n/a ' ELSE '' END
ELSE CAST(o_orderkey % 5 * 400 AS STRING) END AS text FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) + CASE WHEN o_custkey % 9 = 0 THEN 5 ELSE -1 END AS r FROM @orders) AS o CROSS JOIN (VALUES (0), (1), (2)) AS k(c)"""


@_query(f"""WITH c AS ({_duck(_WRAPPED).replace('AS STRING', 'AS VARCHAR')}), r AS (SELECT table_id, row, max(text) FILTER (col = 0) AS label, count(*) FILTER (col > 0 AND regexp_matches(text, '\\d{{3,}}')) AS numbers, string_agg(trim(text), ' ' ORDER BY col) FILTER (trim(text) <> '') AS said FROM c GROUP BY 1, 2),
j AS (SELECT a.table_id, a.row, a.said FROM r a JOIN r b ON a.table_id = b.table_id AND b.row = a.row + 1 WHERE length(a.label) >= 20 AND a.numbers = 0 AND b.numbers >= 2 AND length(b.label) <= 45),
k AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.table_id = c.table_id AND j.row = c.row))
SELECT k.table_id, (CASE WHEN k.table_id IN (SELECT table_id FROM j) THEN dense_rank() OVER (PARTITION BY k.table_id ORDER BY k.row) - 1 ELSE k.row END)::INT AS row, k.col, CASE WHEN j.said IS NOT NULL AND k.col = 0 THEN trim(j.said || ' ' || trim(text)) ELSE text END AS text FROM k LEFT JOIN j ON j.table_id = k.table_id AND j.row + 1 = k.row""")
def wrapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of numbers with the long label of the row above."""
    return structure.wrapped_rows(_rows(spark, sf_dir, _WRAPPED))


_COLUMNED = f"SELECT page, id, CASE WHEN page % 3 = 0 THEN x0 ELSE CASE WHEN id % 2 = 0 THEN 20 ELSE 300 END END + 0e0 AS x0, CASE WHEN page % 3 = 0 THEN x1 ELSE CASE WHEN id % 2 = 0 THEN 250 ELSE 560 END + page % 40 END + 0e0 AS x1 FROM ({_BOXES}) AS b"


@_query(f"""WITH b AS ({_duck(_COLUMNED)}), p AS (SELECT DISTINCT page FROM b), f AS (SELECT page, x FROM p, range(72, 601 - 72) t(x) WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.page = p.page AND x BETWEEN greatest(0, trunc(b.x0)) AND least(600, trunc(b.x1)))),
g AS (SELECT page, x, x - row_number() OVER (PARTITION BY page ORDER BY x) AS island FROM f) SELECT page, min(x)::INT AS "start", (max(x) + 1)::INT AS "end" FROM g GROUP BY page, island HAVING count(*) >= 8""")
def page_gutters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White columns between the blocks of a page."""
    return structure.gutters(_rows(spark, sf_dir, _COLUMNED), 600)


_TOTALS = "SELECT o_custkey AS doc, o_orderkey AS id, CAST(floor(k / 2) AS INT) AS page, CASE WHEN o_orderkey % 5 < 3 THEN 'assets' ELSE 'equity' END AS side FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + o_orderkey % 2 * 0 AS k FROM @orders) AS o"


@_plain
def balance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of equity with the nearest free totals of assets before them."""
    return structure.balance_pairs(_rows(spark, sf_dir, _TOTALS))


@_plain
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average precision of each kind of box at an overlap of 0.5, and over 0.5 to 0.95."""
    predicted = _predicted(spark, sf_dir).withColumn("score", (F.col("page") * 31 + F.col("id") * 7) % 1000 / 1000)
    return structure.average_precision(_rows(spark, sf_dir, _BOXES), predicted)


@_plain
def mean_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over the kinds that have reference boxes."""
    return average_precision(spark, sf_dir).agg(F.round(F.avg("ap_50"), 4).alias("map_50"), F.round(F.avg("ap_50_95"), 4).alias("map_50_95"), F.count("ap_50").alias("kinds"))
