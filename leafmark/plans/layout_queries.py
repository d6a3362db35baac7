"""Registered queries over spans of texts, boxes of pages, cells of tables, error measures and written artifacts.

Pages of boxes are made from lineitem (an order is a page, its lines are blocks) and tables of cells from orders, by the same SQL in both engines, so they grow with
the input. Queries without SQL are tested against plain versions in tests/test_layout_queries.py.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignment, bounds, geometry, numbers, tables
from ..functions.text import accent_strip, is_connector_line, is_page_number, joined_lines, repeated_tail
from ..operators import layout, spans
from ..sources.tables import read_again, table
from .queries import ORACLE_SQL, QUERIES, _counts, _query, _sql


def _plain(f):
    """Registers a query that SQL cannot express."""
    QUERIES[f.__name__] = f
    return f


def _rows(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(re.sub(r"@(\w+)", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", text))


def _duck(text: str) -> str:
    return re.sub(r"@(\w+)", r"\1", text)


# Occurrences in texts

PHRASES = ["the", "of the", "on the", "ß", "tion", "der", "of", "The", ""]
_PHRASES = "(VALUES ('the', 'the'), ('of the', 'of the'), ('on the', 'on the'), ('ß', 'ss'), ('tion', 'tion'), ('der', 'der'), ('of', 'of')) p(keyword, key)"
_FOUND = "SELECT doc_id, keyword, key, t, k, i, sum(length(part)) OVER w + (i - 1) * length(key) AS match_start FROM (SELECT doc_id, keyword, key, t, k, unnest(string_split(k, key)) AS part, generate_subscripts(string_split(k, key), 1) AS i FROM ({}), " + _PHRASES + ") WINDOW w AS (PARTITION BY doc_id, keyword ORDER BY i ROWS UNBOUNDED PRECEDING)"
_TEXTS = "SELECT doc_id, text AS t, replace(lower(text), 'ß', 'ss') AS k FROM documents"

@_query(f"WITH f AS ({_FOUND.format(_TEXTS)}), l AS (SELECT doc_id, keyword, count(*) AS n FROM f GROUP BY 1, 2) SELECT f.doc_id, f.keyword, match_start::BIGINT AS match_start, (match_start + length(key))::BIGINT AS match_end FROM f JOIN l USING (doc_id, keyword) WHERE f.i < l.n")
def keyword_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every literal occurrence of every keyword with its folded offsets."""
    return spans.keyword_spans(table(spark, sf_dir, "documents"), PHRASES).select("doc_id", "keyword", "match_start", "match_end")


CITED = ["of the", "on the", "der", "tion"]


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.lit("# Trang "), (i + 1).cast("string"), F.lit("\n"), x))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))


@_plain
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences with page, context and source spelling, in the order of a report (J09, F02, W15, O15); lines of documents are pages."""
    return spans.in_citation_order(spans.citations(_marked(spark, sf_dir), CITED), CITED)


@_plain
def bounded_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-bounded occurrences, the leftmost and longest of overlapping ones."""
    return spans.keyword_spans(table(spark, sf_dir, "documents"), PHRASES, bounded=True)


@_plain
def suppressed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-bounded occurrences that another one keeps out."""
    return spans.suppressed_spans(table(spark, sf_dir, "documents"), PHRASES)


ALIASES = ["dé là", "õf the", "în thé", "wás of", "der"]


@_plain
def alias_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word runs equal to a keyword of several words but for accents."""
    return spans.alias_candidates(table(spark, sf_dir, "documents"), ALIASES)


@_plain
def rule_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias candidates with the first rule whose context stands beside them in the paragraph; the rest is pending."""
    rules = spark.sql("SELECT * FROM VALUES (1, 'õf the', 'of the', 'and', CAST(NULL AS STRING)), (2, 'õf the', 'of the', NULL, 'and'), (3, 'wás of', 'was of', NULL, NULL) AS r(rule_id, keyword, alias, required_before, required_after)")
    return spans.ruled(alias_candidates(spark, sf_dir), table(spark, sf_dir, "documents"), rules)


_CONFUSED = "(VALUES ('18o', '18o'), ('2o3', '2o3'), ('5o', '5o'), ('1o8', '1o8'), ('83o', '83o'), ('1o5', '1o5'), ('o9', 'o9')) d(keyword, folded)"


@_query(f"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+') AS ws, regexp_split_to_array(text, '[A-Za-z0-9]+') AS gs FROM documents),
w AS (SELECT doc_id, ws[i] AS w, gs[i] AS a, gs[i + 1] AS b, coalesce(ws[i - 1], '') AS p, coalesce(ws[i + 1], '') AS q FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM t))
SELECT keyword, w AS observed, count(*) AS n FROM w JOIN {_CONFUSED} ON replace(lower(w), '0', 'o') = folded WHERE lower(w) <> keyword
AND NOT (a IN ('.', ',', '-', '/') AND regexp_matches(p, '[0-9]$')) AND NOT (b IN ('.', ',', '-', '/') AND regexp_matches(q, '^[0-9]')) GROUP BY 1, 2""")
def confusable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens that a zero for an o makes equal to a keyword with a digit and a letter, not inside a number."""
    known = spark.sql(f"SELECT * FROM {_CONFUSED.replace('d(', 'AS d(')}")
    token = r"[A-Za-z0-9]+"
    cut = table(spark, sf_dir, "documents").select(F.regexp_extract_all("text", F.lit(f"({token})"), 1).alias("ws"), F.split("text", token, -1).alias("gs"))
    at = lambda a, i: F.coalesce(F.get(a, i), F.lit(""))
    listed = F.transform("ws", lambda w, i: F.struct(w.alias("observed"), (at("gs", i).isin(*".,-/") & at("ws", i - 1).rlike("[0-9]$") | at("gs", i + 1).isin(*".,-/") & at("ws", i + 1).rlike("^[0-9]")).alias("inside")))
    rows = cut.select(F.inline(F.filter(listed, lambda s: ~s["inside"])))
    hit = rows.join(F.broadcast(known), F.translate(F.lower("observed"), "0", "o") == F.col("folded")).where(F.lower("observed") != F.col("keyword"))
    return hit.groupBy("keyword", "observed").agg(F.count("*").alias("n"))


_LEXICON = "'the', 'of', 'and', 'in', 'to', 'der', 'de', 'la'"


@_query(f"SELECT doc_id, len(list_filter(ws, lambda w: w IN ({_LEXICON}))) / nullif(len(ws), 0) AS ratio FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM documents)")
def lexicon_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a document's words that a lexicon has."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1).alias("ws"))
    return words.select("doc_id", (F.size(F.filter("ws", lambda w: w.isin(*re.findall(r"\w+", _LEXICON)))) / F.nullif(F.size("ws"), F.lit(0))).alias("ratio"))


@_query("SELECT word, strip_accents(word) AS bare, count(*) AS n FROM (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1")
def stripped_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words without their accents, case kept; words are counted first, so each spelling is stripped once."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).select("word", accent_strip(F.col("word")).alias("bare"), "n")


_JOIN = r"list_reduce(list_concat([''], list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')), lambda a, x: CASE WHEN a = '' THEN x WHEN regexp_matches(a, '\p{L}-$') AND regexp_matches(x, '^\p{Ll}') THEN a[:-2] || x ELSE a || ' ' || x END)"


@_query(f"SELECT doc_id, sha256({_JOIN}) AS joined FROM documents")
def paragraphs_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a document as one paragraph, hyphens at line ends undone (F31), as a digest."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(joined_lines(F.split("text", "\n")), 256).alias("joined"))


@_plain
def repetition_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that end in a phrase said three times or more, with the phrase given once."""
    said = F.when(F.col("turn") % 3 == 0, F.concat("text", F.lit(" so we say so we say so we say"))).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", said.alias("said"))
    return rows.withColumn("guarded", repeated_tail(F.col("said"))).where("guarded <> said")


_CHANGED = "SELECT conv_id, turn, text AS a, replace(replace(text, 'e', CASE WHEN turn % 2 = 0 THEN 'é' ELSE 'e' END), '1', CASE WHEN turn % 3 = 0 THEN '7' ELSE '1' END) AS b FROM @conversations"


@_query(f"SELECT conv_id, turn, strip_accents(lower(a)) = strip_accents(lower(b)) AND a <> b AS only_diacritics, regexp_extract_all(a, '[0-9]+(?:[.,][0-9]+)*') = regexp_extract_all(b, '[0-9]+(?:[.,][0-9]+)*') AS numbers_kept FROM ({_duck(_CHANGED)})")
def change_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an edited turn differs in accents alone, and whether its numbers are the same."""
    numbers_of = lambda c: F.regexp_extract_all(c, F.lit(r"([0-9]+(?:[.,][0-9]+)*)"), 1)
    bare = lambda c: accent_strip(F.lower(c))
    rows = _rows(spark, sf_dir, _CHANGED)
    return rows.select("conv_id", "turn", ((bare(F.col("a")) == bare(F.col("b"))) & (F.col("a") != F.col("b"))).alias("only_diacritics"), (numbers_of("a") == numbers_of("b")).alias("numbers_kept"))


# Lines and amounts

_LINES = "SELECT DISTINCT line FROM (SELECT {} AS line FROM @documents UNION ALL SELECT concat('Trang ', CAST(doc_id AS STRING)) AS line FROM @documents UNION ALL SELECT concat(CAST(doc_id AS STRING), ' / 20') AS line FROM @documents UNION ALL SELECT * FROM (VALUES (''), ('civil'), ('ill'), ('mix'), ('xiv / 20'), ('MCMXCIV'), ('iiii'), ('- 3 -'), ('l | -'), ('--'), ('1l'), ('E z'), ('1lI'), ('trang iv')) AS v(line)) AS u"
_ROMANS = "M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})"


@_query(f"""SELECT line, regexp_matches(trim(line), '(?i)^(trang\\s+)?([0-9]{{1,4}}|{_ROMANS})(\\s*/\\s*[0-9]{{1,4}})?$') AND regexp_matches(trim(line), '(?i)^(trang\\s+)?[0-9ivxlcdm]') AS page_number,
trim(line, ' ' || chr(9) || chr(13)) = '' OR (regexp_matches(line, '^[1lI|/\\\\\\-_zE.,\\s]+$') AND len(list_filter(regexp_extract_all(line, '[^\\s]+'), lambda x: length(x) > 2)) = 0) AS connector
FROM ({_duck(_LINES.format("unnest(string_split(text, chr(10)))")).replace("AS STRING", "AS VARCHAR")})""")
def line_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page numbers and connector lines among the lines of documents."""
    lines = _rows(spark, sf_dir, _LINES.format("explode(split(text, '\\\\n'))"))
    return lines.select("line", is_page_number(F.col("line")).alias("page_number"), is_connector_line(F.col("line")).alias("connector"))


# An amount of a known value printed in one of several ways; the oracle knows the value, the query reads the print
_WAYS = """CASE way WHEN 0 THEN concat('(', {dot}, ')') WHEN 1 THEN {dot} WHEN 2 THEN concat('+', {dot}, ',5') WHEN 3 THEN concat('–', {dot}) WHEN 4 THEN concat('−', {n}) WHEN 5 THEN concat('(', {n})
WHEN 6 THEN concat({dot}, '%') WHEN 7 THEN '—' WHEN 8 THEN {blank} WHEN 9 THEN '12 34' WHEN 10 THEN {comma} ELSE concat(' (', {n}, ') ') END"""


def _printed(s: str) -> str:
    head = f"CAST(floor((1000 + o_custkey % 9000) / 1000) AS BIGINT)"
    group = lambda mark: f"concat(CAST({head} AS {s}), '{mark}', lpad(CAST(o_custkey % 1000 AS {s}), 3, '0'))"
    number = f"CAST({head} * 1000 + o_custkey % 1000 AS {s})"
    text = _WAYS.format(dot=group("."), comma=group(","), blank=group(" "), n=number)
    return f"SELECT id, way, CAST({number} AS BIGINT) AS n, cust, {text} AS text FROM (SELECT o_orderkey AS id, o_orderkey % 12 AS way, o_custkey, o_custkey AS cust FROM @orders) AS o"


@_query(f"SELECT id, text, (CASE way WHEN 0 THEN -n WHEN 1 THEN n WHEN 2 THEN n + 0.5 WHEN 3 THEN -n WHEN 4 THEN -n WHEN 7 THEN 0 WHEN 8 THEN n WHEN 10 THEN n * 0.001 WHEN 11 THEN -n END)::DECIMAL(38, 9) AS amount FROM ({_duck(_printed('VARCHAR'))})")
def parsed_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed amounts as exact decimals, null where they are none in the convention."""
    return _rows(spark, sf_dir, _printed("STRING")).select("id", "text", numbers.parse_amount(F.col("text"), F.lit("vn")).alias("amount"))


@_query(f"SELECT table_id, CASE WHEN vn AND en THEN 'ambiguous' WHEN vn THEN 'vn' WHEN en THEN 'en' ELSE 'plain' END AS convention FROM (SELECT cust AS table_id, bool_or(way IN (0, 1, 2, 3)) AS vn, bool_or(way = 10) AS en FROM ({_duck(_printed('VARCHAR'))}) GROUP BY 1)")
def amount_conventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The convention that the amounts of a table speak for."""
    return _rows(spark, sf_dir, _printed("STRING")).groupBy(F.col("cust").alias("table_id")).agg(numbers.convention(F.col("text")).alias("convention"))


# Boxes

_NUMBERED = "SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS block FROM @lineitem"
_BOXES = f"SELECT l_orderkey AS page, CAST(block AS BIGINT) AS id, x0, y0, x0 + 20 + 2 * l_quantity AS x1, y0 + 12 + 2 * block AS y1, l_returnflag AS kind FROM (SELECT *, CAST(l_partkey * 37 % 150 AS DOUBLE) AS x0, CAST(l_suppkey * 53 % 90 AS DOUBLE) AS y0 FROM ({_NUMBERED}) AS a) AS b"


@_query(f"""WITH b AS ({_duck(_BOXES)}), p AS (SELECT a.page, a.id AS a, b.id AS b, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS i,
(a.x1 - a.x0) * (a.y1 - a.y0) AS sa, (b.x1 - b.x0) * (b.y1 - b.y0) AS sb, (b.x0 + b.x1) / 2 BETWEEN a.x0 AND a.x1 AND (b.y0 + b.y1) / 2 BETWEEN a.y0 AND a.y1 AS holds FROM b a JOIN b ON a.page = b.page AND a.id < b.id)
SELECT page, a, b, i / (sa + sb - i) AS iou, i / least(sa, sb) AS overlap, holds FROM p WHERE i > 0""")
def box_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping boxes of a page: a join on the page with a residual, never across pages."""
    rows = _rows(spark, sf_dir, _BOXES).select("page", "id", F.struct("x0", "y0", "x1", "y1").alias("box"))
    a, b = rows.alias("a"), rows.alias("b")
    p, q = F.col("a.box"), F.col("b.box")
    meet = (F.least(p["x1"], q["x1"]) > F.greatest(p["x0"], q["x0"])) & (F.least(p["y1"], q["y1"]) > F.greatest(p["y0"], q["y0"]))
    pairs = a.join(b, (F.col("a.page") == F.col("b.page")) & (F.col("a.id") < F.col("b.id")) & meet)
    return pairs.select("a.page", F.col("a.id").alias("a"), F.col("b.id").alias("b"), geometry.iou(p, q).alias("iou"), geometry.overlap_ratio(p, q).alias("overlap"), geometry.holds_centre(p, q).alias("holds"))


_BLOCKS = f"SELECT page, id, x0, y0, x1, y1, CASE WHEN id % 5 = 0 THEN concat('r', page, '-', id - 1) END AS region_id FROM ({_BOXES}) AS x WHERE id % 2 = 1 OR id = 10"
_REGIONS = f"SELECT page, concat('r', page, '-', id) AS region, kind, x0, y0, x1 + 60, y1 + 40 FROM ({_BOXES}) AS x WHERE id % 2 = 0"
_REGIONS = _REGIONS.replace("x1 + 60, y1 + 40", "x1 + 60 AS x1, y1 + 40 AS y1")


@_query(f"""WITH b AS ({_duck(_BLOCKS)}), r AS ({_duck(_REGIONS)}), p AS (SELECT b.page, b.id, r.region, row_number() OVER (PARTITION BY b.page, b.id ORDER BY coalesce(b.region_id = r.region, false) DESC, (r.kind = 'N') DESC, (r.x1 - r.x0) * (r.y1 - r.y0), r.region) AS k
FROM b LEFT JOIN r ON b.page = r.page AND (((b.x0 + b.x1) / 2 BETWEEN r.x0 AND r.x1 AND (b.y0 + b.y1) / 2 BETWEEN r.y0 AND r.y1) OR b.region_id = r.region))
SELECT page, id, coalesce(region, 'inferred-' || page || '-' || id) AS region, region IS NULL AS inferred FROM p WHERE k = 1""")
def region_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region of each block: the one it names, else the smallest one of a preferred kind around its centre, else an inferred one."""
    return layout.region_links(_rows(spark, sf_dir, _BLOCKS), _rows(spark, sf_dir, _REGIONS), ["N"])


_COVER = "SELECT b.page, b.id FROM ({0}) AS b WHERE {1}EXISTS (SELECT 1 FROM ({2}) AS r WHERE r.page = b.page AND greatest(least(b.x1, r.x1) - greatest(b.x0, r.x0), 0e0) * greatest(least(b.y1, r.y1) - greatest(b.y0, r.y0), 0e0) >= 8e-1 * (b.x1 - b.x0) * (b.y1 - b.y0))"
_sql("covered_blocks", _COVER.format(_BLOCKS, "", _REGIONS))
_sql("uncovered_blocks", _COVER.format(_BLOCKS, "NOT ", _REGIONS))
_RANKS = f"SELECT page, id, row_number() OVER (PARTITION BY page ORDER BY y0, x0, id) AS p, row_number() OVER (PARTITION BY page ORDER BY id) AS r FROM ({_BOXES}) AS b"
_sql("order_agreement", f"WITH k AS ({_RANKS}), s AS (SELECT a.page, count(*) AS pairs, avg(CASE WHEN a.p < b.p THEN 1e0 ELSE 0e0 END) AS precedence FROM k a JOIN k b ON a.page = b.page AND a.r < b.r GROUP BY a.page), c AS (SELECT page, count(*) AS n, sum(CAST((p - r) * (p - r) AS DOUBLE)) AS d FROM k GROUP BY page) SELECT s.page, s.pairs, s.precedence, 1e0 - 6e0 * c.d / (c.n * (c.n * c.n - 1e0)) AS spearman FROM s JOIN c ON s.page = c.page")


@_plain
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursive cut of a page at its widest gaps, lines inside what is left."""
    return layout.reading_order(_rows(spark, sf_dir, _BOXES))


@_plain
def order_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in an order that keeps what the edges say, weak edges on cycles left out."""
    boxes = _rows(spark, sf_dir, _BOXES)
    edges = boxes.alias("a").join(boxes.alias("b"), (F.col("a.page") == F.col("b.page")) & (F.col("a.id") != F.col("b.id")) & ((F.col("a.y1") <= F.col("b.y0")) | (F.col("b.id") == F.col("a.id") - 2)))
    edges = edges.select("a.page", F.col("a.id").alias("before"), F.col("b.id").alias("after"), F.abs(F.col("a.x0") - F.col("b.x0")).alias("score"), (F.col("a.y1") <= F.col("b.y0")).alias("hard"))
    return layout.ordered_by_edges(boxes.select("page", "id", F.col("y0").alias("rank")), edges, "page")


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = {"x0": F.col("x0") + F.col("id") % 3 * 9, "x1": F.col("x1") + F.col("id") % 3 * 9}
    return _rows(spark, sf_dir, _BOXES).where("(page + id) % 6 <> 0").withColumns(moved).withColumn("id", F.col("id") * 10)


@_plain
def box_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and predicted boxes paired one to one: as many as can be, then of the greatest overlap."""
    return layout.matched_boxes(_rows(spark, sf_dir, _BOXES), _predicted(spark, sf_dir))


@_plain
def detection_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of the paired boxes over all pages."""
    return layout.detection_scores(box_matches(spark, sf_dir))


# Tables

_CELLS = "SELECT o_custkey AS table_id, r - 1 AS row, c AS col, 1 AS row_span, CASE WHEN c = 0 AND r % 7 = 0 THEN 2 ELSE 1 END AS col_span, CASE c WHEN 0 THEN o_orderstatus WHEN 1 THEN CAST(o_orderkey AS STRING) ELSE o_orderpriority END AS text FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS r FROM @orders) AS o CROSS JOIN (VALUES (0), (1), (2)) AS k(c)"


@_plain
def rendered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of cells as grids, in Markdown and HTML."""
    return tables.rendered(_rows(spark, sf_dir, _CELLS))


@_plain
def table_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree edit similarity of tables with and without their texts."""
    cells = _rows(spark, sf_dir, _CELLS)
    worse = cells.where("(table_id + row) % 4 <> 0 OR row = 0").withColumn("text", F.when((F.col("row") % 3 == 1) & (F.col("col") == 2), F.substring("text", 1, 4)).otherwise(F.col("text")))
    sides = [tables.rendered(c).select("table_id", F.col("html").alias(n)) for c, n in ((cells, "reference"), (worse, "prediction"))]
    return tables.table_similarity(sides[0].join(sides[1], "table_id", "left"), ["table_id"])


_PARTS = "SELECT l_orderkey AS chain, CAST(block AS INT) AS part, r AS row, c AS col, CASE WHEN r = 0 THEN CASE WHEN c = 0 OR block % 3 <> 0 THEN concat('head ', c) ELSE l_returnflag END ELSE concat(l_partkey, '-', r, '-', c) END AS text FROM (" + _NUMBERED + ") AS b CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1)) AS k(r, c)"


@_query(f"""WITH c AS ({_duck(_PARTS)}), p AS (SELECT chain, part, max(row) + 1 AS n, list(text ORDER BY col) FILTER (row = 0) AS head FROM c GROUP BY 1, 2),
g AS (SELECT *, CASE WHEN head = first(head) OVER (PARTITION BY chain ORDER BY part) AND row_number() OVER (PARTITION BY chain ORDER BY part) > 1 THEN 1 ELSE 0 END AS gone FROM p),
s AS (SELECT *, coalesce(sum(n - gone) OVER (PARTITION BY chain ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT c.chain, c.part, (row - gone + before)::INT AS row, col, text FROM c JOIN s USING (chain, part) WHERE row >= gone""")
def stitched_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a table on following pages as one, repeated heads left out."""
    return tables.stitched(_rows(spark, sf_dir, _PARTS)).select("chain", "part", "row", "col", "text")


# Error measures

def _accented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as references with accents, and predictions with some of these wrong, as pairs of one length class or another."""
    marked = F.replace(F.replace(F.replace("text", F.lit("a"), F.lit("ắ")), F.lit("o"), F.lit("ộ")), F.lit("d"), F.lit("đ"))
    wrong = F.when(F.col("turn") % 2 == 0, F.replace(F.replace(marked, F.lit("ộ"), F.lit("ô")), F.lit("th"), F.lit("h"))).otherwise(F.replace(F.replace(marked, F.lit("đ"), F.lit("d")), F.lit("ắ"), F.lit("e")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", marked.alias("reference"), wrong.alias("prediction"))


@_plain
def text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits by kind, word edits and the two diacritic error rates of each turn."""
    return alignment.text_metrics(_accented(spark, sf_dir), ["conv_id", "turn"])


@_plain
def diacritic_confusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 most frequent confusions of marks."""
    return alignment.confusions(_accented(spark, sf_dir))


@_plain
def slot_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of each kind in each document."""
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in alignment.slot_counts(F.col("text")).items()])


@_plain
def bound_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact binomial gates over the ship dates of each supplier, with a design effect for some."""
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if((F.col("l_partkey") % 997) == 0).alias("errors"), F.count("*").alias("trials"))
    return bounds.gated(counts.withColumn("effect", F.when(F.col("l_suppkey") % 2 == 0, 1.5).cast("double")), rate=0.01)


@_plain
def bootstrap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of event values with intervals by resampling."""
    return bounds.bootstrap_mean(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), ["event_type"], F.col("value"), draws=200)


# Windows

_SEEN = "SELECT DISTINCT source, doc_id AS page, line FROM (SELECT source, doc_id, {} AS line FROM @documents) AS x WHERE length(trim(line)) > 0"
_SUPPORT = "SELECT source, line, page, count(*) OVER w AS near, count(*) OVER v AS same_side FROM ({}) AS y WINDOW w AS (PARTITION BY source, line ORDER BY page RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING), v AS (PARTITION BY source, line, page % 2 ORDER BY page RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING)"
_sql("support_windows", _SUPPORT.format(_SEEN.format("explode(split(text, '\\\\n'))")), _SUPPORT.format(_SEEN.format("unnest(string_split(text, chr(10)))")))
_sql("page_spans", "SELECT user_id, event_type, min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS n FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM @events) AS e GROUP BY user_id, event_type, island")
_sql("contract_references", "SELECT 'line without order' AS code, count(*) AS n FROM @lineitem l LEFT ANTI JOIN @orders o ON l.l_orderkey = o.o_orderkey UNION ALL SELECT 'order without line' AS code, count(*) AS n FROM @orders o LEFT ANTI JOIN @lineitem l ON l.l_orderkey = o.o_orderkey UNION ALL SELECT 'order without customer' AS code, count(*) AS n FROM @orders o LEFT ANTI JOIN @customer c ON o.o_custkey = c.c_custkey", "SELECT 'line without order' AS code, count(*) AS n FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT 'order without line', count(*) FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey UNION ALL SELECT 'order without customer', count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey")
_sql("canonical_digests", "SELECT o_orderkey, sha2(to_json(named_struct('customer', o_custkey, 'key', o_orderkey, 'status', o_orderstatus)), 256) AS digest FROM @orders", "SELECT o_orderkey, sha256('{\"customer\":' || o_custkey || ',\"key\":' || o_orderkey || ',\"status\":\"' || o_orderstatus || '\"}') AS digest FROM orders")


# Artifacts, written and read again

@_query(ORACLE_SQL["keyword_matrix"])
def matrix_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword matrix as it is read from the file it was written to."""
    return read_again(QUERIES["keyword_matrix"](spark, sf_dir), "matrix", "csv")


@_query("SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1, 2")
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log written as lines of JSON in the order of time, read again and summed."""
    log = read_again(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type").orderBy("ts", "event_id"), "events", "json")
    return log.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


_WIDE = ", ".join(f"max(CASE WHEN keyword = '{k}' THEN n END) AS kw_{i}" for i, k in enumerate(["en", "der", "ung", "ion", "ß"]))


@_query(f"SELECT doc_id, {_WIDE} FROM ({ORACLE_SQL['keyword_totals'].split(' SELECT lang, keyword')[0]} SELECT * FROM c) GROUP BY doc_id")
def analytics_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document in the order of display columns."""
    columns = [F.max(F.when(F.col("keyword") == k, F.col("n"))).alias(f"kw_{i}") for i, k in enumerate(["en", "der", "ung", "ion", "ß"])]
    return _counts(spark, sf_dir).groupBy("doc_id").agg(*columns)
