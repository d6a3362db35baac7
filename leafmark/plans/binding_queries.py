"""Registered queries over cells bound to texts, matched blocks, broken headings and plain texts, made from the standard tables by the same SQL in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bindings
from . import evidence_queries  # noqa: F401  registers its queries
from .layout_queries import _duck, _plain, _rows
from .queries import ORACLE_SQL, QUERIES, _query  # noqa: F401
from .routing_queries import _MARKDOWN
from .structure_queries import _FLOW, _NUMBER

_BOUND = """SELECT o_custkey AS table_id, o_orderkey AS cell, concat(o_orderpriority, ' ', o_orderkey % 100) AS text, 0e0 AS x0, k * 20e0 AS y0, 100e0 AS x1, k * 20e0 + 18 AS y1 FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM @orders) AS o WHERE o_custkey % 2 = 0 OR k < 3"""
_PIECES = f"""SELECT table_id, cell * 2 + p AS id, CASE WHEN p = 0 THEN substr(text, 1, length(text) - 3) ELSE CASE WHEN cell % 41 = 0 THEN '0,5' ELSE substr(text, length(text) - 1) END END AS text, x0 + p * 40 + CASE WHEN cell % 53 = 0 THEN 40 ELSE 0 END AS x0, y0 + p AS y0, x0 + p * 40 + 30 + CASE WHEN cell % 53 = 0 THEN 40 ELSE 0 END AS x1, y0 + 10 AS y1
FROM ({_BOUND}) AS b CROSS JOIN (VALUES (0), (1)) AS k(p) WHERE cell % 61 > 0"""


@_query(f"""WITH c AS ({_duck(_BOUND)}), b AS ({_duck(_PIECES)}), m AS (SELECT b.table_id, b.id, b.y0, b.x0, b.text, count(c.cell) AS n, min(c.cell) AS cell FROM b LEFT JOIN c ON b.table_id = c.table_id AND c.x0 <= b.x0 AND b.x1 <= c.x1 AND c.y0 <= b.y0 AND b.y1 <= c.y1 GROUP BY ALL),
s AS (SELECT c.table_id, bool_and(c.text = coalesce((SELECT string_agg(trim(m.text), ' ' ORDER BY m.y0, m.x0, m.id) FROM m WHERE m.table_id = c.table_id AND m.cell = c.cell AND m.n = 1), '')) AS same, list_sort(flatten(list(regexp_extract_all(c.text, '[0-9]+(?:[.,][0-9]+)*')))) AS numbers FROM c GROUP BY 1),
l AS (SELECT table_id, count(*) FILTER (n <> 1) AS loose, list_sort(flatten(list(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*')))) AS numbers FROM m GROUP BY 1)
SELECT s.table_id, same AND coalesce(loose, 0) = 0 AND s.numbers = coalesce(l.numbers, []) AS bound, coalesce(loose, 0) AS loose FROM s LEFT JOIN l USING (table_id)""")
def bound_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose cells hold each of their blocks whole and once."""
    return bindings.bound_tables(_rows(spark, sf_dir, _BOUND), _rows(spark, sf_dir, _PIECES))


@_query(f"""WITH g AS (SELECT *, trim(text) AS t, lag(is_heading) OVER w AS h, lag(trim(text)) OVER w AS q, lag(page) OVER w AS qg, lag(bold) OVER w AS qb, lag(size) OVER w AS qs, lag(x0) OVER w AS qx0, lag(x1) OVER w AS qx1, lag(y0) OVER w AS qy0, lag(y1) OVER w AS qy1 FROM ({_duck(_FLOW)}) WINDOW w AS (PARTITION BY doc ORDER BY n)),
k AS (SELECT *, sum(CASE WHEN coalesce(h AND is_heading AND NOT {_NUMBER} AND bold = qb AND (size IS NULL AND qs IS NULL OR coalesce(abs(size - qs) <= greatest(0.5, 0.08 * greatest(size, qs)), false)) AND page = qg AND y0 - qy1 BETWEEN -0.5 * (qy1 - qy0) AND 0.8 * (qy1 - qy0)
AND (abs(x0 - qx0) <= 6 OR abs((x0 + x1) / 2 - (qx0 + qx1) / 2) <= 8) AND q NOT LIKE '%.', false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY n) AS head FROM g)
SELECT doc, min(n) AS n, count(*)::INT AS lines, string_agg(t, ' ' ORDER BY n) AS text FROM k WHERE is_heading GROUP BY doc, head""")
def merged_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings broken over lines as one."""
    return bindings.merged_headings(_rows(spark, sf_dir, _FLOW))


@_plain
def matched_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of a conversation matched with those of a shuffled and cut reading."""
    turns = _rows(spark, sf_dir, "SELECT conv_id AS page, CAST(turn AS BIGINT) AS id, text FROM @conversations")
    read = turns.select("page", (100 - F.col("id")).alias("id"), F.when(F.col("id") % 3 == 0, F.expr("substr(text, 3)")).otherwise(F.col("text")).alias("text"))
    return bindings.matched_texts(turns, read)


@_plain
def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered pages as plain text."""
    return _rows(spark, sf_dir, _MARKDOWN).select("doc_id", F.sha2(bindings.plain_text("text"), 256).alias("digest"))
