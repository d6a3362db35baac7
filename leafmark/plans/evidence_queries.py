"""Registered queries over captions, contents entries, sections, reports and their reviews, made from the standard tables by the same SQL in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import headings
from ..operators import evidence
from ..sources.tables import read_again, table
from . import structure_queries  # noqa: F401  registers its queries
from .layout_queries import _BOXES, _duck, _plain, _rows
from .queries import ORACLE_SQL, QUERIES, _query  # noqa: F401
from .structure_queries import _FLOW, _MODELS, _WORDS

_BLOCKS = """SELECT doc_id, 1 + doc_id % 3 AS page, doc_id * 7 % 800 * 1e0 AS y0, CASE doc_id % 9 WHEN 0 THEN concat('Bảng 3: ', substr(text, 1, 20)) WHEN 1 THEN 'E = m (12)' WHEN 2 THEN concat('2.1 ', substr(text, 1, 40)) WHEN 3 THEN ' - một' WHEN 4 THEN '$$x$$'
WHEN 5 THEN 'ANNUAL REPORT' WHEN 6 THEN concat('Fig. 2- ', doc_id) WHEN 7 THEN concat('(3) ', text) ELSE text END AS text FROM @documents"""


@_query(f"""SELECT doc_id, CASE WHEN regexp_matches(t, '(?i)^(hình|bảng|ảnh|sơ đồ|biểu đồ|figure|table|fig\\.)\\s+\\d+[:.-]') THEN 'caption' WHEN regexp_matches(t, '(=|\\+|-|\\*|/|sum|int)\\s*\\(\\d+\\)$') OR t LIKE '$$%$$' THEN 'formula'
WHEN page = 1 AND y0 < 294.7 AND length(t) < 120 AND n <= 3 AND (upper(t) = t AND lower(t) <> t OR len(string_split(t, ' ')) < 15) THEN 'title' WHEN regexp_matches(t, '(?i)^(\\d+(\\.\\d+)*|[A-Z]\\.|[IVXLCDM]+\\.|chương|phần|mục)\\s+\\S') AND n <= 2 AND length(t) < 150 THEN 'section_header'
WHEN regexp_matches(coalesce(text, ''), '^\\s*([-*•–+]|\\(\\d+\\)|\\d+\\))\\s+') THEN 'list' ELSE 'text' END AS role FROM (SELECT *, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t, len(string_split(rtrim(coalesce(text, ''), chr(10)), chr(10))) AS n FROM ({_duck(_BLOCKS)}))""")
def block_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The role of a block by its text and place."""
    return _rows(spark, sf_dir, _BLOCKS).select("doc_id", evidence.block_role(F.col("text"), F.col("y0"), F.col("page"), F.lit(842.0)).alias("role"))


_TREE = "SELECT o_custkey AS doc, n, CAST(floor(n / 4) AS INT) AS page, CASE WHEN o_orderkey % 3 = 0 THEN CAST(1 + o_orderkey % 4 AS INT) END AS level FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS n FROM @orders) AS o"


@_query(f"""WITH l AS ({_duck(_TREE)}), h AS (SELECT * FROM l WHERE level IS NOT NULL), e AS (SELECT h.*, (SELECT max(p.n) FROM h p WHERE p.doc = h.doc AND p.n < h.n AND p.level < h.level) AS parent, (SELECT min(q.n) FROM h q WHERE q.doc = h.doc AND q.n > h.n AND q.level <= h.level) AS stop FROM h)
SELECT doc, n, level, parent, page AS page_start, (SELECT max(l.page) FROM l WHERE l.doc = e.doc AND l.n >= e.n AND (stop IS NULL OR l.n < stop)) AS page_end FROM e""")
def section_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with the one they belong to and the pages they cover."""
    return evidence.sections(_rows(spark, sf_dir, _TREE))


@_query(f"SELECT doc, page, n, kind, text, x0, y0 FROM ({_duck(_FLOW)})")
def extraction_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of pages written as nested JSON, one record a document, and read again."""
    items = _rows(spark, sf_dir, _FLOW).groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("n", "kind", "text", "x0", "y0"))).alias("items"))
    docs = items.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page", "items"))).alias("pages"))
    return read_again(docs, "extraction", "json").select("doc", F.inline("pages")).select("doc", "page", F.inline("items"))


_NL = "chr(10)"


@_query(f"""SELECT doc, sha256(string_agg('# Trang ' || page || {_NL} || {_NL} || said, {_NL} || {_NL} || '---' || {_NL} || {_NL} ORDER BY page)) AS digest FROM (SELECT doc, page, string_agg(CASE WHEN kind = 'title' THEN '## ' ELSE '' END || trim(text), {_NL} || {_NL} ORDER BY n) AS said FROM ({_duck(_FLOW)}) GROUP BY 1, 2) GROUP BY 1""")
def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of documents as Markdown with a mark before each page."""
    said = F.concat(F.when(F.col("kind") == "title", "## ").otherwise(""), F.trim("text"))
    joined = lambda order, text, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text.alias("t")))), lambda x: x["t"]), by)
    pages = _rows(spark, sf_dir, _FLOW).groupBy("doc", "page").agg(joined("n", said, "\n\n").alias("said"))
    whole = F.concat(F.lit("# Trang "), F.col("page").cast("string"), F.lit("\n\n"), F.col("said"))
    return pages.groupBy("doc").agg(F.sha2(joined("page", whole, "\n\n---\n\n"), 256).alias("digest"))


_LAYER = f"SELECT page, id, x0, y0, x1, y1, concat('word ', page * 7 % 90, ' ', id * 3) AS text FROM ({_WORDS}) AS w"
_READ = f"SELECT page, id, x0, y0, x1 + 30 AS x1, y1 + 30 AS y1, concat('word  ', page * 7 % 80, ' ', id * 3) AS text FROM ({_MODELS}) AS m"


@_query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY id) - 1 AS k, count(*) OVER (PARTITION BY page) AS n FROM ({_duck(_READ)})), s AS (SELECT * FROM l WHERE n <= 3 OR k IN (0, round_even((n - 1) / 2, 0), n - 1)), w AS ({_duck(_LAYER)}),
m AS (SELECT s.page, s.id, regexp_replace(s.text, '\\s+', ' ', 'g') AS ocr, coalesce((SELECT string_agg(w.text, ' ' ORDER BY w.id) FROM w WHERE w.page = s.page AND (w.x0 + w.x1) / 2 BETWEEN s.x0 AND s.x1 AND (w.y0 + w.y1) / 2 BETWEEN s.y0 AND s.y1), '') AS layer FROM s)
SELECT *, round(levenshtein(ocr, layer) / greatest(length(ocr), length(layer), 1), 4) AS disagreement FROM m""")
def line_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read lines against the words of the text layer inside them, three evenly spaced lines a page."""
    return evidence.line_agreement(_rows(spark, sf_dir, _READ), _rows(spark, sf_dir, _LAYER), sample=3)


_TEXTED = f"SELECT page, id, id % 2 AS section, x0 * 2 AS x0, y0 * 6 AS y0, x0 * 2 + 70 AS x1, y0 * 6 + 10 AS y1, CASE id % 4 WHEN 1 THEN concat('Bảng ', id, ': tổng') WHEN 3 THEN concat('Biểu đồ ', id, '. lãi') ELSE concat('Hình ', id, ': ảnh') END AS text FROM ({_BOXES}) AS x WHERE id % 2 = 1 OR id = 4"
_PLACED = f"SELECT page, id, 1 AS section, x0 * 2 AS x0, y0 * 6 AS y0, x0 * 2 + 120 AS x1, y0 * 6 + 60 AS y1 FROM ({_BOXES}) AS x WHERE id % 2 = 0 AND id <> 4"


@_query(f"""WITH b AS ({_duck(_TEXTED)}), f AS ({_duck(_PLACED)}), n AS (SELECT b.page, b.id AS caption, f.id AS frame, CASE WHEN b.y0 >= f.y1 THEN 'below' ELSE 'above' END AS position, round(CASE WHEN b.y0 >= f.y1 THEN b.y0 - f.y1 ELSE f.y0 - b.y1 END, 2) AS gap, greatest(b.x0, f.x0) AS l, least(b.x1, f.x1) AS r,
CASE WHEN b.y0 >= f.y1 THEN f.y1 ELSE b.y1 END AS t, CASE WHEN b.y0 >= f.y1 THEN b.y0 ELSE f.y0 END AS u FROM b JOIN f ON b.page = f.page AND b.section = f.section WHERE regexp_matches(b.text, '^(Bảng|Biểu)') AND least(b.x1, f.x1) - greatest(b.x0, f.x0) >= 0.5 * (b.x1 - b.x0)),
o AS (SELECT page, id, x0, y0, x1, y1 FROM b UNION ALL SELECT page, id, x0, y0, x1, y1 FROM f), k AS (SELECT * FROM n WHERE gap BETWEEN 0 AND 80 AND NOT EXISTS (SELECT 1 FROM o WHERE o.page = n.page AND o.id NOT IN (n.caption, n.frame) AND least(n.r, o.x1) > greatest(n.l, o.x0) AND least(n.u, o.y1) > greatest(n.t, o.y0))),
s AS (SELECT *, count(*) OVER (PARTITION BY page, caption) AS tables FROM k), u AS (SELECT *, count(*) OVER (PARTITION BY page, frame) AS captions FROM s WHERE tables = 1) SELECT page, frame, caption, position, gap FROM u WHERE captions = 1""")
def table_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and captions that have each other alone, with nothing between."""
    return evidence.table_captions(_rows(spark, sf_dir, _TEXTED), _rows(spark, sf_dir, _PLACED), gap=80.0)


@_plain
def figure_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest caption of each figure, never shared."""
    return evidence.figure_captions(_rows(spark, sf_dir, _TEXTED), _rows(spark, sf_dir, _PLACED), gap=80.0, overlap=0.3)


_CONTENTS = "SELECT o_custkey AS page, o_orderkey AS id, k, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey % 200 AS STRING) WHEN 1 THEN concat('Mục tiêu ', o_orderpriority) ELSE concat('1. Quản trị rủi ro ..... ', o_orderkey % 200) END AS text, CASE WHEN o_orderkey % 3 = 0 THEN 300e0 ELSE 50e0 END AS x0, floor(k / 2) * 14e0 AS y0, CASE WHEN o_orderkey % 3 = 0 THEN 320e0 ELSE 250e0 END AS x1, floor(k / 2) * 14e0 + 10 AS y1 FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM @orders) AS o"


@_plain
def contents_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of contents pages with their page numbers."""
    return evidence.contents_entries(_rows(spark, sf_dir, _CONTENTS))


@_plain
def contents_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings that the contents confirm, and the offset of printed pages."""
    lines = _rows(spark, sf_dir, _FLOW).select("doc", "n", "page", headings.title_key(F.col("text")).alias("title"))
    entries = lines.where("n % 2 = 0").select("doc", F.col("n").alias("k"), F.regexp_replace("title", "a", "").alias("title"), (F.col("page") + 2).alias("printed"))
    return evidence.contents_matches(lines, entries)


_SPANS = f"SELECT page AS doc, kind AS keyword, id * 10 AS start FROM ({_BOXES}) AS b"
_ATTRIBUTED = f"SELECT page AS doc, kind AS keyword, id * 10 AS start, CASE WHEN id % 5 > 0 THEN id % 3 END AS unit, CASE WHEN id % 5 > 0 THEN page * 100 + id - CASE WHEN id % 4 = 1 THEN 1 ELSE 0 END END AS ref FROM ({_BOXES}) AS b WHERE (page + id) % 7 > 0"
_UNITS = "SELECT o_orderkey AS doc, CAST(u AS BIGINT) AS unit, (o_orderkey + u) % 5 > 0 AS annotated FROM @orders CROSS JOIN (VALUES (0), (1), (2)) AS k(u)"
_REFERENCES = f"SELECT page AS doc, page * 100 + id AS ref, id % 3 AS unit, CASE WHEN id % 6 = 0 THEN 'A' ELSE kind END AS keyword FROM ({_BOXES}) AS b WHERE id % 4 <> 3"


@_query(f"""WITH s AS ({_duck(_SPANS)}), a AS ({_duck(_ATTRIBUTED)}), u AS ({_duck(_UNITS)}), r AS ({_duck(_REFERENCES)}),
j AS (SELECT s.*, a.doc IS NOT NULL AS named, a.unit, a.ref, u.annotated, r.unit = a.unit AND r.keyword = s.keyword AND u.annotated AS ok FROM s LEFT JOIN a USING (doc, keyword, start) LEFT JOIN u ON u.doc = s.doc AND u.unit = a.unit LEFT JOIN r ON r.doc = s.doc AND r.ref = a.ref),
o AS (SELECT *, CASE WHEN NOT named THEN 'unattributed' WHEN unit IS NULL THEN 'outside_scope' WHEN NOT coalesce(annotated, false) THEN 'unscored' WHEN ok AND NOT EXISTS (SELECT 1 FROM j i WHERE i.doc = j.doc AND i.ref = j.ref AND i.ok AND i.start < j.start) THEN 'correct' ELSE 'extra' END AS outcome FROM j)
SELECT doc, keyword, outcome, count(*) AS n FROM (SELECT doc, keyword, outcome FROM o UNION ALL SELECT r.doc, r.keyword, 'missing' FROM r JOIN u ON u.doc = r.doc AND u.unit = r.unit AND u.annotated WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.doc = r.doc AND o.ref = r.ref AND outcome = 'correct')) GROUP BY ALL""")
def keyword_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences against reviewed references."""
    return evidence.keyword_acceptance(*(_rows(spark, sf_dir, t) for t in (_SPANS, _ATTRIBUTED, _UNITS, _REFERENCES)))


_TERMS = ["the", "der", "ion"]
_VALUES = ", ".join(f"('{k}')" for k in _TERMS)
_TRUE = f"SELECT doc_id, keyword, CAST((length(lower(text)) - length(replace(lower(text), keyword, ''))) / 3 AS BIGINT) AS n FROM @documents CROSS JOIN (VALUES {_VALUES}) AS k(keyword)"
_SAID = f"SELECT doc_id, CASE WHEN doc_id % 17 = 0 AND keyword = 'ion' THEN 'iom' ELSE keyword END AS keyword, n + CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END - CASE WHEN doc_id % 19 = 0 THEN 1000 ELSE 0 END AS n, total + CASE WHEN doc_id % 23 = 0 THEN 1 ELSE 0 END AS total FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY doc_id) AS BIGINT) AS total FROM ({_TRUE}) AS t) AS s WHERE NOT (doc_id % 29 = 0 AND keyword = 'der')"


@_query(f"""WITH t AS ({_duck(_TRUE)}), s AS ({_duck(_SAID)}) SELECT s.doc_id, s.keyword, CASE WHEN t.n IS NULL THEN 'extra_keyword' WHEN s.n < 0 THEN 'negative_count' ELSE 'count_differs' END AS fault FROM s LEFT JOIN t USING (doc_id, keyword) WHERE t.n IS NULL OR s.n <> t.n
UNION ALL SELECT t.doc_id, t.keyword, 'missing_keyword' FROM t ANTI JOIN s USING (doc_id, keyword) UNION ALL SELECT doc_id, NULL, 'total_differs' FROM s GROUP BY doc_id HAVING sum(n) <> min(total)""")
def report_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong in keyword reports: keywords, counts, totals."""
    return evidence.report_faults(_rows(spark, sf_dir, _SAID), _rows(spark, sf_dir, _TRUE), _TERMS)


@_query("""SELECT path, CASE WHEN k % 7 = 0 THEN 'absent' WHEN k % 11 = 0 THEN 'unlisted' WHEN k % 13 = 0 THEN 'changed' END AS fault FROM (SELECT doc_id AS k, 'docs/' || doc_id || '.txt' AS path FROM documents) WHERE (k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0) AND k % 77 > 0""")
def completion_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of finished documents against the marks that list their digests."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), F.concat(F.lit("docs/"), "doc_id", F.lit(".txt")).alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    marks = docs.where("k % 11 <> 0").withColumn("sha256", F.when(F.col("k") % 13 == 0, "0").otherwise(F.col("sha256")))
    return evidence.completion_faults(marks, docs.where("k % 7 <> 0"))
