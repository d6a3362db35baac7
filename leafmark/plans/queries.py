"""Registered queries over the standard tables, with SQL that another engine answers the same way.

`@name` stands for a table. A query that is one SQL text in both engines is given once; else the two texts, or a function and a text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import accent_fold, shingles
from ..operators import keywords as kw
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

KEYWORDS = ["en", "der", "ung", "ion", "ß", "ENT", "en", "", "aa"]


def _sql(name: str, text: str, other: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(re.sub(r"@(\w+)", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", text))

    QUERIES[name] = run
    ORACLE_SQL[name] = re.sub(r"@(\w+)", r"\1", other or text)


def _query(oracle: str):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, oracle
        return f

    return add


_KEYED = "SELECT doc_id, lang, source, replace(lower(nfc_normalize(text)), 'ß', 'ss') AS k FROM documents"
_DICT = "(VALUES ('en', 'en'), ('der', 'der'), ('ung', 'ung'), ('ion', 'ion'), ('ß', 'ss'), ('ENT', 'ent'), ('aa', 'aa')) d(keyword, key)"
_COUNTED = f"c AS (SELECT doc_id, lang, source, keyword, (length(k) - length(replace(k, key, ''))) // length(key) AS n FROM ({_KEYED}), {_DICT})"


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(table(spark, sf_dir, "documents"), kw.dictionary(spark, KEYWORDS), ["doc_id", "lang", "source"])


@_query(f"WITH {_COUNTED} SELECT lang, keyword, sum(n)::BIGINT AS n, count(*) FILTER (n > 0) AS docs FROM c GROUP BY 1, 2")
def keyword_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of literal counts, zero rows included."""
    return _counts(spark, sf_dir).groupBy("lang", "keyword").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("docs"))


@_query(f"""WITH {_COUNTED}, t AS (SELECT source, keyword, n FROM c UNION ALL SELECT NULL, keyword, n FROM c)
SELECT source, {", ".join(f"sum(n) FILTER (keyword = '{k}')::BIGINT AS kw_{i}" for i, k in enumerate(["en", "der", "ung", "ion", "ß"]))} FROM t GROUP BY source""")
def keyword_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of sources by keywords with a row of totals."""
    return kw.keyword_matrix(_counts(spark, sf_dir), "source", {f"kw_{i}": k for i, k in enumerate(["en", "der", "ung", "ion", "ß"])})


@_query("SELECT 'kw-' || substr(sha256(key), 1, 16) AS keyword_id, keyword, ordinal FROM (VALUES ('en', 'en', 0), ('der', 'der', 1), ('ung', 'ung', 2), ('ion', 'ion', 3), ('ß', 'ss', 4), ('ENT', 'ent', 5), ('aa', 'aa', 8)) d(keyword, key, ordinal)")
def keyword_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frozen dictionary: first spellings, ids, order."""
    return kw.dictionary(spark, KEYWORDS).select("keyword_id", "keyword", "ordinal")


_EVENTS = "VALUES ('c1', 'd1', '2024-01-01', 'ACCEPTED'), ('c1', 'd2', '2024-01-02', 'REJECTED'), ('c2', 'd3', '2024-01-01', 'ACCEPTED'), ('c3', 'd4', '2024-01-03', 'ACCEPTED'), ('c3', 'd5', '2024-01-04', 'REVOKED'), ('c5', 'd6', '2024-01-04', 'ACCEPTED'), ('c5', 'd7', '2024-01-04', 'REJECTED')"
_CANDIDATES = "VALUES ('c1', 'alpha', 'candidate'), ('c2', 'alpha', 'candidate'), ('l1', 'alpha', 'literal'), ('c3', 'beta', 'candidate'), ('c4', 'beta', 'candidate'), ('l2', 'beta', 'literal'), ('l3', 'gamma', 'literal')"


def _decisions(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM ({_EVENTS}) AS e(candidate_id, decision_id, decided_at, status)")


@_query(f"SELECT * FROM ({_EVENTS}) e(candidate_id, decision_id, decided_at, status) QUALIFY row_number() OVER (PARTITION BY candidate_id ORDER BY decided_at DESC, decision_id DESC) = 1")
def latest_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last decision of each candidate."""
    return kw.latest_decisions(_decisions(spark))


@_query(f"SELECT candidate_id, decided_at FROM ({_EVENTS}) e(candidate_id, decision_id, decided_at, status) GROUP BY 1, 2 HAVING count(DISTINCT status) > 1")
def decision_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different decisions at one instant (J08's error)."""
    return kw.conflicting_decisions(_decisions(spark))


@_query(f"""WITH l AS (SELECT * FROM ({_EVENTS}) e(candidate_id, decision_id, decided_at, status) QUALIFY row_number() OVER (PARTITION BY candidate_id ORDER BY decided_at DESC, decision_id DESC) = 1),
t AS (SELECT keyword, count(*) FILTER (tier = 'literal') AS literal, count(*) FILTER (tier = 'candidate' AND status = 'ACCEPTED') AS accepted,
count(*) FILTER (tier = 'candidate' AND coalesce(status, 'REVOKED') = 'REVOKED') AS pending FROM ({_CANDIDATES}) c(candidate_id, keyword, tier) LEFT JOIN l USING (candidate_id) GROUP BY 1)
SELECT *, CASE WHEN pending = 0 THEN literal + accepted END AS reviewed FROM t""")
def keyword_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal, accepted and pending counts, and the reviewed total."""
    return kw.tiers(spark.sql(f"SELECT * FROM ({_CANDIDATES}) AS c(candidate_id, keyword, tier)"), kw.latest_decisions(_decisions(spark)))


@_query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zA-ZäöüßéèêçàùâîôûñóíáúÄÖÜÉÈÊÇÀÓÍÁÚÑ]+')) AS w FROM documents), f AS (SELECT w, strip_accents(replace(lower(w), 'ß', 'ss')) AS f FROM t),
d AS (SELECT * FROM (VALUES ('entre', 'entre'), ('pere', 'père'), ('que', 'que'), ('fur', 'für')) d(folded, keyword))
SELECT keyword, w AS variant, count(*) AS n FROM f JOIN d ON f.f = d.folded WHERE replace(lower(w), 'ß', 'ss') <> keyword GROUP BY 1, 2""")
def single_word_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words equal to a keyword but for case-folded diacritics (J04). Words are counted before the folding UDF runs, so it sees each spelling once."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([a-zA-ZäöüßéèêçàùâîôûñóíáúÄÖÜÉÈÊÇÀÓÍÁÚÑ]+)"), 1)).alias("variant"))
    known = spark.sql("SELECT * FROM (VALUES ('entre', 'entre'), ('pere', 'père'), ('que', 'que'), ('fur', 'für')) AS d(folded, keyword)")
    counted = words.groupBy("variant").agg(F.count("*").alias("n")).withColumn("folded", accent_fold("variant"))
    return counted.join(F.broadcast(known), "folded").where(F.replace(F.lower("variant"), F.lit("ß"), F.lit("ss")) != F.col("keyword")).select("keyword", "variant", "n")


@_query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents)
SELECT page::INT AS page, sum((length(lower(line)) - length(replace(lower(line), 'ing', ''))) // 3)::BIGINT AS n FROM l GROUP BY 1""")
def page_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences attributed to the marker that stands last before them; line ends are the markers."""
    lines = table(spark, sf_dir, "documents").select(F.posexplode(F.split("text", "\n")).alias("page", "line"))
    n = F.regexp_count(F.lower("line"), F.lit("ing"))
    return lines.groupBy((F.col("page") + 1).alias("page")).agg(F.sum(n).cast("long").alias("n"))


# Duplicates, overlap, splits, samples

_sql("exact_duplicates", "SELECT d.doc_id, f.first_id FROM @documents d JOIN (SELECT sha2(text, 256) AS h, min(doc_id) AS first_id FROM @documents GROUP BY 1) f ON sha2(d.text, 256) <=> f.h WHERE d.doc_id <> f.first_id", "SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents) WHERE doc_id <> first_id")
_sql("edition_groups", "SELECT lang, source, count(*) AS editions, min(doc_id) AS first_id FROM @documents GROUP BY lang, source HAVING count(*) > 1")
_sql("missing_and_unexpected", "SELECT doc_id, 'missing' AS side FROM @documents d LEFT ANTI JOIN @labels l USING (doc_id) UNION ALL SELECT doc_id, 'unexpected' AS side FROM @labels l LEFT ANTI JOIN @documents d USING (doc_id)", "SELECT doc_id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'unexpected' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
_sql("unit_set_guard", "SELECT count(*) AS differing FROM ((SELECT doc_id FROM @documents EXCEPT ALL SELECT doc_id FROM @labels) UNION ALL (SELECT doc_id FROM @labels EXCEPT ALL SELECT doc_id FROM @documents))")
_sql("split_leakage", "SELECT s.text_hash, count(DISTINCT s.split) AS splits, count(*) AS n FROM (SELECT sha2(text, 256) AS text_hash, CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'test' ELSE 'train' END AS split FROM @documents) s GROUP BY s.text_hash HAVING count(DISTINCT s.split) > 1", "SELECT sha256(text) AS text_hash, count(DISTINCT CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'test' ELSE 'train' END) AS splits, count(*) AS n FROM documents GROUP BY 1 HAVING count(DISTINCT CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'test' ELSE 'train' END) > 1")
_sql("hash_rank_sample", "SELECT source, doc_id, rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha2(concat('7:sample:', doc_id), 256)) AS rank FROM @documents) WHERE rank <= 5", "SELECT source, doc_id, rank::INT AS rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('7:sample:' || doc_id)) AS rank FROM documents) WHERE rank <= 5")
_sql("round_robin_sample", "SELECT doc_id, lang, turn FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha2(concat('3:', doc_id), 256)) AS turn FROM @documents) ORDER BY turn, lang LIMIT 40", "SELECT doc_id, lang, turn::INT AS turn FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('3:' || doc_id)) AS turn FROM documents) ORDER BY turn, lang LIMIT 40")
_sql("evenly_spaced_sample", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM @documents) WHERE n <= 5 OR r IN (0, bround((n - 1) / 4D), bround(2 * (n - 1) / 4D), bround(3 * (n - 1) / 4D), n - 1)", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE n <= 5 OR r IN (0, round_even((n - 1) / 4, 0), round_even(2 * (n - 1) / 4, 0), round_even(3 * (n - 1) / 4, 0), n - 1)")
_sql("worklist_page", "SELECT doc_id, source, n_chars FROM @documents ORDER BY n_chars DESC, source, doc_id LIMIT 20 OFFSET 40")


@_query(r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^ \t\n\r\f\x0B]+') AS w FROM documents), b AS (SELECT item_id, regexp_extract_all(lower(text), '[^ \t\n\r\f\x0B]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d)),
bs AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS i FROM b)),
dn AS (SELECT doc_id, count(*) AS n FROM ds GROUP BY 1 HAVING count(*) >= 20), bn AS (SELECT item_id, count(*) AS n FROM bs GROUP BY 1 HAVING count(*) >= 20),
p AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY 1, 2 HAVING count(*) >= 8),
j AS (SELECT item_id, doc_id, shared, shared / (dn.n + bn.n - shared) AS jaccard FROM p JOIN dn USING (doc_id) JOIN bn USING (item_id))
SELECT item_id, doc_id, shared, jaccard, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY jaccard DESC, shared DESC, doc_id)::INT AS rank FROM j) WHERE rank <= 3""")
def page_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and items of at least 20 four-word shingles each that share eight, the best three of each item by Jaccard, shared count and id (G07, O16, the text signal of J24)."""
    words = lambda t: F.regexp_extract_all(F.lower(t), F.lit(r"([^ \t\n\r\f\x0B]+)"), 1)

    def exploded(name: str, key: str, size: str) -> DataFrame:
        sets = table(spark, sf_dir, name).select(key, shingles(words("text"), 4).alias("all")).where(F.size("all") >= 20)
        return sets.select(key, F.size("all").alias(size), F.explode("all").alias("s"))

    both = exploded("documents", "doc_id", "n_doc").join(exploded("benchmark", "item_id", "n_item"), "s")
    pairs = both.groupBy("item_id", "n_item", "doc_id", "n_doc").agg(F.count("*").alias("shared")).where("shared >= 8")
    scored = pairs.withColumn("jaccard", F.col("shared") / (F.col("n_doc") + F.col("n_item") - F.col("shared")))
    best = Window.partitionBy("item_id").orderBy(F.col("jaccard").desc(), F.col("shared").desc(), "doc_id")
    return scored.withColumn("rank", F.row_number().over(best)).where("rank <= 3").select("item_id", "doc_id", "shared", "jaccard", "rank")


# Measures of text against a reference

_WHOLE = "SELECT conv_id, turn, text AS reference, CASE WHEN turn % 5 <> 4 THEN replace(replace(text, 'e', CASE WHEN turn % 2 = 0 THEN 'é' ELSE 'e' END), 'th', 'h') END AS prediction FROM conversations"
# levenshtein() of the other engine counts bytes, so each pair's characters are numbered and written as one byte each (127 different ones at most)
_NUMBERED = f"SELECT *, array_to_string(list_distinct(string_split(coalesce(reference, '') || coalesce(prediction, ''), '')), '') AS chars, (SELECT string_agg(chr(i::INT), '' ORDER BY i) FROM range(1, 128) t(i)) AS bytes FROM ({_WHOLE})"
_WHOLE_EDITS = f"SELECT conv_id, turn, length(reference) AS n, CASE WHEN length(chars) <= 127 THEN levenshtein(translate(reference, chars, bytes), translate(coalesce(prediction, ''), chars, bytes)) ELSE error('more than 127 characters') END AS edits, prediction IS NULL AS missing FROM ({_NUMBERED})"


def _whole_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prediction = F.replace(F.replace("text", F.lit("e"), F.when(F.col("turn") % 2 == 0, "é").otherwise("e")), F.lit("th"), F.lit("h"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("reference"), F.when(F.col("turn") % 5 != 4, prediction).alias("prediction"))


def _whole_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = F.levenshtein("reference", F.coalesce("prediction", F.lit("")))
    rows = _whole_pairs(spark, sf_dir).select("conv_id", "turn", F.length("reference").alias("n"), edits.alias("edits"), F.col("prediction").isNull().alias("missing"))
    return rows.withColumn("cer", F.when(F.col("n") > 0, F.col("edits") / F.col("n")))


@_query(f"SELECT conv_id, turn, edits::INT AS edits, CASE WHEN n > 0 THEN edits / n END AS cer FROM ({_WHOLE_EDITS})")
def character_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character edits of whole texts and their rate, all rows, a missing prediction counting in full."""
    return _whole_edits(spark, sf_dir).select("conv_id", "turn", "edits", "cer")


@_query(f"SELECT sum(edits)::BIGINT AS edits, sum(n)::BIGINT AS n, sum(edits) / sum(n) AS micro, avg(CASE WHEN n > 0 THEN edits / n END) AS mean_of_pages, count(*) FILTER (n > 0) AS with_reference, count(*) FILTER (missing) AS missing FROM ({_WHOLE_EDITS})")
def micro_macro_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro rate beside the mean of pages, over whole texts and all rows."""
    return _whole_edits(spark, sf_dir).agg(F.sum("edits").alias("edits"), F.sum("n").cast("long").alias("n"), (F.sum("edits") / F.sum("n")).alias("micro"), F.avg("cer").alias("mean_of_pages"), F.count_if(F.col("n") > 0).alias("with_reference"), F.count_if("missing").alias("missing"))


@_query(rf"""WITH p AS ({_WHOLE}), t AS (SELECT conv_id, turn, unnest(regexp_extract_all(reference, '[^\s]+')) AS w, 1 AS r, 0 AS q FROM p
UNION ALL SELECT conv_id, turn, unnest(regexp_extract_all(prediction, '[^\s]+')), 0, 1 FROM p)
SELECT conv_id, sum(least(r, q))::BIGINT AS matched, sum(r)::BIGINT AS reference, sum(q)::BIGINT AS predicted FROM (SELECT conv_id, turn, w, sum(r) AS r, sum(q) AS q FROM t GROUP BY 1, 2, 3) GROUP BY 1""")
def bag_of_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of whole texts matched as multisets."""
    tokens = lambda c: F.transform(F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(r"([^\s]+)"), 1), lambda w: F.struct(w.alias("w"), F.lit(int(c == "reference")).alias("r"), F.lit(int(c == "prediction")).alias("q")))
    seen = _whole_pairs(spark, sf_dir).select("conv_id", "turn", F.inline(F.concat(tokens("reference"), tokens("prediction"))))
    bags = seen.groupBy("conv_id", "turn", "w").agg(F.sum("r").alias("r"), F.sum("q").alias("q"))
    return bags.groupBy("conv_id").agg(F.sum(F.least("r", "q")).alias("matched"), F.sum("r").alias("reference"), F.sum("q").alias("predicted"))


# Statistics

_sql("latency_summary", "SELECT event_type, count(*) AS n, percentile(value, 0.5) AS p50, avg(value) AS mean, percentile(value, 0.95) AS p95, max(value) AS max FROM @events GROUP BY event_type", "SELECT event_type, count(*) AS n, quantile_cont(value, 0.5) AS p50, avg(value) AS mean, quantile_cont(value, 0.95) AS p95, max(value) AS max FROM events GROUP BY event_type")
_sql("nearest_rank_percentile", "SELECT event_type, percentile_disc(0.9) WITHIN GROUP (ORDER BY value) AS p90 FROM @events GROUP BY event_type")
_sql("regression_check", "SELECT *, p50_now > p50_before * 1.1 AS regressed FROM (SELECT event_type, percentile(value, 0.5) FILTER (WHERE event_id % 2 = 0) AS p50_before, percentile(value, 0.5) FILTER (WHERE event_id % 2 = 1) AS p50_now FROM @events GROUP BY event_type)", "SELECT *, p50_now > p50_before * 1.1 AS regressed FROM (SELECT event_type, quantile_cont(value, 0.5) FILTER (event_id % 2 = 0) AS p50_before, quantile_cont(value, 0.5) FILTER (event_id % 2 = 1) AS p50_now FROM events GROUP BY event_type)")
_sql("holm_adjusted", "SELECT name, p, max(least(1.0D, (m - rank) * p)) OVER (ORDER BY p, name ROWS UNBOUNDED PRECEDING) AS adjusted FROM (SELECT name, p, row_number() OVER (ORDER BY p, name) - 1 AS rank, count(*) OVER () AS m FROM (VALUES ('a', 0.01D), ('b', 0.04D), ('c', 0.03D), ('d', 0.005D), ('e', 0.6D)) AS t(name, p))", "SELECT name, p, max(least(1.0, (m - rank) * p)) OVER (ORDER BY p, name ROWS UNBOUNDED PRECEDING) AS adjusted FROM (SELECT name, p, row_number() OVER (ORDER BY p, name) - 1 AS rank, count(*) OVER () AS m FROM (VALUES ('a', 0.01::DOUBLE), ('b', 0.04), ('c', 0.03), ('d', 0.005), ('e', 0.6)) AS t(name, p))")
_SCORED = "SELECT doc_id, (doc_id * 37 % 101) / 100{d} AS score, quality AS correct FROM @labels"
_s, _o = _SCORED.format(d="D"), _SCORED.format(d=".0::DOUBLE")
_CAL = "SELECT CAST(least(floor(score * 10), 9) AS INT) AS bin, count(*) AS n, avg(score) AS mean_score, avg(correct) AS accuracy FROM ({}) GROUP BY 1"
_sql("calibration_bins", _CAL.format(_s), _CAL.format(_o))
_ECE = "SELECT sum(n * abs(mean_score - accuracy)) / sum(n) AS ece, (SELECT avg(power(score - correct, 2)) FROM ({0})) AS brier FROM (" + _CAL.replace("{}", "{0}") + ")"
_sql("calibration_error", _ECE.format(_s), _ECE.format(_o))
_ROUTE = "SELECT count(*) AS n, sum(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) AS accepted, sum(CASE WHEN score >= 0.5 THEN 1 - correct ELSE 0 END) / nullif(sum(CASE WHEN score >= 0.5 THEN 1{0} ELSE 0 END), 0) AS risk, sum(CASE WHEN score < 0.5 THEN 1 - correct ELSE 0 END) / nullif(sum(1{0} - correct), 0) AS review_recall FROM ({1})"
_sql("review_routing", _ROUTE.format("D", _s), _ROUTE.format(".0::DOUBLE", _o))
_CURVE = "SELECT score, sum(n) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS accepted, sum(errors) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS errors FROM (SELECT score, count(*) AS n, sum(1 - correct) AS errors FROM ({}) GROUP BY score)"
_sql("risk_coverage_curve", _CURVE.format(_s), _CURVE.format(_o))
_sql("cluster_sums", "SELECT c.c_nationkey AS cluster, count(*) AS units, sum(o.o_totalprice) AS numerator, sum(1) AS denominator FROM @orders o JOIN @customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey", "SELECT c.c_nationkey AS cluster, count(*) AS units, sum(o.o_totalprice) AS numerator, count(*) AS denominator FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey")
_ICC = "WITH g AS (SELECT o_custkey % 50 AS k, count(*) AS n, avg(o_totalprice) AS m, sum(o_totalprice) AS s, sum(o_totalprice * o_totalprice) AS ss FROM @orders GROUP BY 1), t AS (SELECT count(*) AS k, sum(n) AS n, sum(n * m) / sum(n) AS grand, sum(n * n) AS nn FROM g), a AS (SELECT sum(g.n * (g.m - t.grand) * (g.m - t.grand)) / (max(t.k) - 1) AS msb, sum(g.ss - g.n * g.m * g.m) / (max(t.n) - max(t.k)) AS msw, (max(t.n) - max(t.nn) / max(t.n)) / (max(t.k) - 1) AS m0 FROM g CROSS JOIN t) SELECT round((msb - msw) / (msb + (m0 - 1) * msw), 6) AS icc FROM a"
_sql("anova_icc", _ICC.replace("sum(n * n) AS nn", "CAST(sum(n * n) AS DOUBLE) AS nn"), _ICC)
_sql("zero_event_bound", "SELECT trials, 1 - power(0.05D, 1D / trials) AS upper, CASE WHEN trials = 0 THEN 'NOT_EVALUATED' WHEN 1 - power(0.05D, 1D / trials) <= 1e-4 THEN 'PASS' ELSE 'FAIL' END AS gate FROM (VALUES (100), (29955), (29956), (46050)) AS t(trials)", "SELECT trials, 1 - power(0.05, 1.0::DOUBLE / trials) AS upper, CASE WHEN trials = 0 THEN 'NOT_EVALUATED' WHEN 1 - power(0.05, 1.0::DOUBLE / trials) <= 1e-4 THEN 'PASS' ELSE 'FAIL' END AS gate FROM (VALUES (100), (29955), (29956), (46050)) t(trials)")
_sql("effective_counts", "SELECT errors, trials, deff, CAST(ceil(errors / deff) AS BIGINT) AS eff_errors, CAST(floor(trials / deff) AS BIGINT) AS eff_trials FROM (VALUES (3, 1000, 1.5D), (0, 500, 2.0D), (7, 90, 1.0D)) AS t(errors, trials, deff)", "SELECT errors, trials, deff, ceil(errors / deff)::BIGINT AS eff_errors, floor(trials / deff)::BIGINT AS eff_trials FROM (VALUES (3, 1000, 1.5::DOUBLE), (0, 500, 2.0), (7, 90, 1.0)) t(errors, trials, deff)")

# Two runs side by side

_RUNS = "b AS (SELECT o_orderkey AS unit, o_totalprice > 100000 AS ok FROM @orders WHERE o_orderkey % 7 <> 0), c AS (SELECT o_orderkey AS unit, o_totalprice > 80000 AND o_orderkey % 3 <> 0 AS ok FROM @orders WHERE o_orderkey % 11 <> 0)"
_sql("paired_runs", f"WITH {_RUNS}, p AS (SELECT CASE WHEN b.ok IS NULL THEN 'only_candidate' WHEN c.ok IS NULL THEN 'only_baseline' WHEN b.ok AND c.ok THEN 'preserved' WHEN c.ok THEN 'fixed' WHEN b.ok THEN 'harmed' ELSE 'still_wrong' END AS verdict FROM b FULL OUTER JOIN c ON b.unit = c.unit) SELECT verdict, count(*) AS n FROM p GROUP BY verdict")
_sql("paired_effects", f"WITH {_RUNS}, p AS (SELECT b.ok AS was, c.ok AS now, CASE WHEN o.o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'other' END AS stratum FROM b JOIN c ON b.unit = c.unit JOIN @orders o ON o.o_orderkey = b.unit), s AS (SELECT was, now, stratum FROM p UNION ALL SELECT was, now, 'overall' FROM p) SELECT stratum, count(*) AS n, sum(CASE WHEN NOT was AND now THEN 1 ELSE 0 END) AS fixed, sum(CASE WHEN was AND NOT now THEN 1 ELSE 0 END) AS harmed, sum(CASE WHEN NOT was AND now THEN 1e0 ELSE 0e0 END) / nullif(sum(CASE WHEN NOT was THEN 1e0 ELSE 0e0 END), 0e0) AS fix_rate, sum(CASE WHEN was AND NOT now THEN 1e0 ELSE 0e0 END) / nullif(sum(CASE WHEN was THEN 1e0 ELSE 0e0 END), 0e0) AS harm_rate FROM s GROUP BY stratum")
_sql("degradation_curve", "WITH m AS (SELECT l_returnflag AS condition, avg(l_discount) AS rate, count(*) AS n FROM @lineitem GROUP BY l_returnflag) SELECT m.condition, m.n, m.rate - c.rate AS delta FROM m CROSS JOIN (SELECT rate FROM m WHERE condition = 'N') c")
_sql("stratified_scorecard", "SELECT coalesce(lang, 'overall') AS stratum, count(*) AS n, sum(n_chars) AS chars FROM @documents GROUP BY ROLLUP (lang)")

# Sequence, layout and tables

_sql("section_assignment", "SELECT conv_id, turn, last(CASE WHEN role = 'user' THEN turn END, true) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM @conversations", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM conversations")
_sql("section_extents", "SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, last_turn) AS last_turn FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last_turn FROM @conversations) WHERE role = 'user'", "SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, last_turn) AS last_turn FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last_turn FROM conversations) WHERE role = 'user'")
_GAPS = "WITH g AS (SELECT source, doc_id, CASE WHEN doc_id - lag(doc_id) OVER (PARTITION BY source, lang ORDER BY doc_id) > 100 THEN 1 ELSE 0 END AS cut, lang FROM @documents), s AS (SELECT source, lang, doc_id, sum(cut) OVER (PARTITION BY source, lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS segment FROM g) SELECT source, lang, segment, min(doc_id) AS anchor, count(*) AS n FROM s GROUP BY source, lang, segment"
_sql("repeated_title_segments", _GAPS)
_sql("pagination_runs", "SELECT conv_id, turn - rn AS shift, count(*) AS n, min(turn) AS first_turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM @conversations WHERE length(text) > 60) GROUP BY conv_id, turn - rn")
_sql("widest_gap", "SELECT user_id, max(gap) AS gap FROM (SELECT user_id, value - max(value + 1) OVER (PARTITION BY user_id ORDER BY value, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM @events) WHERE gap > 0 GROUP BY user_id")
_sql("weighted_quality", "SELECT source, sum(quality * n_chars) / sum(CASE WHEN quality IS NOT NULL THEN n_chars END) AS mean_quality, min(quality) AS worst, count(*) AS blocks, count(quality) AS measured FROM @documents LEFT JOIN @labels USING (doc_id) GROUP BY source")
_sql("chunk_confidence", "SELECT source, CASE WHEN count(quality) = count(*) THEN min(quality) END AS confidence, CASE WHEN count(DISTINCT lang) = 1 THEN min(lang) ELSE 'mixed' END AS lang FROM @documents LEFT JOIN @labels USING (doc_id) GROUP BY source")
_sql("ledger_state", "SELECT user_id, max_by(event_type, struct(ts, event_id)) AS state, count(*) AS events FROM @events GROUP BY user_id", "SELECT user_id, arg_max(event_type, {'ts': ts, 'event_id': event_id}) AS state, count(*) AS events FROM events GROUP BY user_id")
_sql("bounding_boxes", "SELECT l_orderkey, min(l_quantity) AS x0, min(l_extendedprice) AS y0, max(l_quantity) AS x1, max(l_extendedprice) AS y1 FROM @lineitem GROUP BY l_orderkey")
_sql("column_alignment", "SELECT event_type, avg(CASE WHEN props RLIKE '[0-9]' THEN 1e0 ELSE 0e0 END) >= 0.5 AS right_aligned FROM @events GROUP BY event_type", "SELECT event_type, avg(CASE WHEN regexp_matches(props, '[0-9]') THEN 1e0 ELSE 0e0 END) >= 0.5 AS right_aligned FROM events GROUP BY event_type")
_sql("numeric_tokens", r"SELECT doc_id, size(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*', 0)) AS n FROM @documents", r"SELECT doc_id, len(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*'))::INT AS n FROM documents")
_sql("text_layer_ratios", r"SELECT doc_id, regexp_count(text, '[a-zA-Z]') / length(text) AS alpha, regexp_count(text, '[#$%&*!|]') / length(text) AS symbol FROM @documents WHERE length(text) > 0", r"SELECT doc_id, length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / length(text) AS alpha, length(regexp_replace(text, '[^#$%&*!|]', '', 'g')) / length(text) AS symbol FROM documents WHERE length(text) > 0")
_FURNITURE = "WITH l AS (SELECT DISTINCT source, doc_id, line FROM ({}) WHERE length(trim(line)) > 0), p AS (SELECT source, count(DISTINCT doc_id) AS pages FROM @documents GROUP BY source), k AS (SELECT source, line, count(*) AS n FROM l GROUP BY source, line) SELECT source, line, n FROM k JOIN p USING (source) WHERE n >= 2 AND n >= 0.03 * pages"
_sql("running_lines", _FURNITURE.format("SELECT source, doc_id, explode(split(text, '\\\\n')) AS line FROM @documents"), _FURNITURE.format("SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"))

@_query("WITH b AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1) SELECT CASE WHEN n < 2 THEN 'INCONCLUSIVE' WHEN q = floor(q / 2) * 2 THEN 'CONSISTENT' ELSE 'VIOLATION' END AS status, count(*) AS n FROM b GROUP BY 1")
def total_row_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of detail rows against a stated total, as counts of outcomes (T19, A47); stated totals are even numbers here."""
    sums = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n"))
    stated = F.floor(F.col("q") / 2) * 2
    return sums.groupBy(F.when(F.col("n") < 2, "INCONCLUSIVE").when(F.col("q") == stated, "CONSISTENT").otherwise("VIOLATION").alias("status")).agg(F.count("*").alias("n"))


# Review, evaluation and publication

_sql("review_queue", "SELECT keyword, variant, count(*) AS n, min(doc_id) AS first_doc FROM (SELECT lower(role) AS keyword, substr(text, 1, 3) AS variant, conv_id AS doc_id FROM @conversations WHERE text IS NOT NULL) GROUP BY keyword, variant")
_sql("edit_outcomes", "SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN p.text IS NULL THEN 'MISSING_OUTPUT' WHEN p.text = r.text THEN 'EXACT' WHEN lower(p.text) = lower(r.text) THEN 'CASE_ONLY' ELSE 'MISMATCH' END AS outcome FROM (SELECT n_nationkey AS k, n_name AS text FROM @nation) r LEFT JOIN (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 4 = 1 THEN lower(n_name) WHEN n_nationkey % 4 = 2 THEN concat(n_name, 'x') ELSE n_name END AS text FROM @nation WHERE n_nationkey % 5 <> 0) p ON r.k = p.k) GROUP BY outcome")
_sql("review_coverage", "SELECT page, missing, least(missing, alias) AS by_alias, least(greatest(missing - alias, 0), confusable) AS by_confusable, greatest(missing - alias - confusable, 0) AS uncovered FROM (SELECT page, greatest(want - got, 0) AS missing, alias, confusable FROM (VALUES (1, 5, 2, 1, 1), (2, 3, 3, 2, 0), (3, 9, 1, 4, 10), (4, 0, 2, 0, 0)) AS t(page, want, got, alias, confusable))")
_sql("review_outcome", "SELECT source, count(*) AS n, CASE WHEN count(quality) = count(*) THEN count(CASE WHEN quality = 1 AND toxic = 0 THEN 1 END) END AS fixed, CASE WHEN count(quality) = count(*) THEN count(CASE WHEN quality = 0 AND toxic = 1 THEN 1 END) END AS introduced FROM @documents LEFT JOIN @labels USING (doc_id) GROUP BY source")
_sql("keyword_run_differences", "SELECT coalesce(a.k, b.k) AS source, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS missing, greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS extra FROM (SELECT source AS k, count(*) AS n FROM @documents WHERE lang = 'en' GROUP BY source) a FULL OUTER JOIN (SELECT source AS k, count(*) AS n FROM @documents WHERE lang = 'fr' GROUP BY source) b ON a.k = b.k")
_sql("publication_pairs", "SELECT coalesce(b.id, c.id) AS unit, b.id IS NOT NULL AS in_baseline, c.id IS NOT NULL AS in_candidate FROM (SELECT doc_id AS id FROM @documents WHERE doc_id % 3 <> 0) b FULL OUTER JOIN (SELECT doc_id AS id FROM @documents WHERE doc_id % 5 <> 0) c ON b.id = c.id")
_sql("manifest_merge", "SELECT id, count(*) AS shards, CASE WHEN count(*) > 1 THEN 'DUPLICATE' ELSE 'OK' END AS status FROM (SELECT s_suppkey AS id FROM @supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey AS id FROM @supplier WHERE s_suppkey % 3 = 0) GROUP BY id")
_sql("phase_rollup", "SELECT event_type, sum(value) AS seconds, max(value) AS peak, count(DISTINCT user_id) AS units, count(*) - count(DISTINCT user_id) AS retries FROM @events GROUP BY event_type")
_sql("metric_grid", "WITH g AS (SELECT c.config, m.metric FROM (VALUES ('a'), ('b'), ('c')) AS c(config) CROSS JOIN (VALUES ('cer'), ('wer')) AS m(metric)), r AS (SELECT g.config, g.metric, coalesce(p.p, 1e0) AS p FROM g LEFT JOIN (VALUES ('a', 'cer', 1e-2), ('b', 'cer', 4e-2), ('b', 'wer', 2e-2), ('c', 'wer', 5e-1)) AS p(config, metric, p) ON g.config = p.config AND g.metric = p.metric), k AS (SELECT *, row_number() OVER (ORDER BY p, config, metric) - 1 AS rank, count(*) OVER () AS m FROM r) SELECT config, metric, p, max(least(1e0, (m - rank) * p)) OVER (ORDER BY p, config, metric ROWS UNBOUNDED PRECEDING) AS adjusted FROM k")
_sql("hierarchy_accuracy", "SELECT count(*) AS n, avg(CASE WHEN p.depth = r.depth THEN 1e0 ELSE 0e0 END) AS depth, avg(CASE WHEN p.parent = r.parent THEN 1e0 ELSE 0e0 END) AS parent, avg(CASE WHEN p.depth = r.depth AND p.parent = r.parent THEN 1e0 ELSE 0e0 END) AS joint FROM (SELECT n_nationkey AS id, n_nationkey % 4 AS depth, n_regionkey AS parent FROM @nation) r LEFT JOIN (SELECT n_nationkey AS id, CASE WHEN n_nationkey % 7 = 0 THEN 9 ELSE n_nationkey % 4 END AS depth, CASE WHEN n_nationkey % 3 = 0 THEN 9 ELSE n_regionkey END AS parent FROM @nation WHERE n_nationkey <> 5) p ON r.id = p.id")
_sql("prefix_pages", "SELECT doc, page FROM (SELECT d.doc, g.page, row_number() OVER (PARTITION BY d.doc ORDER BY length(g.prefix) DESC) AS r FROM (VALUES ('abc-2020-x'), ('abc-2021'), ('ab'), ('zz')) AS d(doc) JOIN (VALUES ('abc', 1), ('abc-2020', 2), ('ab', 3)) AS g(prefix, page) ON substr(d.doc, 1, length(g.prefix)) = g.prefix) WHERE r = 1")
_sql("longest_row_labels", "SELECT o_orderkey, label FROM (SELECT o.o_orderkey, l.label, row_number() OVER (PARTITION BY o.o_orderkey ORDER BY length(l.label) DESC) AS r FROM @orders o JOIN (VALUES ('1-'), ('1-URGENT'), ('2-H'), ('5')) AS l(label) ON substr(o.o_orderpriority, 1, length(l.label)) = l.label) WHERE r = 1")
_sql("continuation_edges", "SELECT doc_id, following FROM (SELECT doc_id, text, lead(doc_id) OVER w AS following, lead(text) OVER w AS next_text FROM @documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)) WHERE substr(text, length(text), 1) NOT IN ('.', '!', '?') AND substr(next_text, 1, 1) BETWEEN 'A' AND 'z'")
_sql("repeated_titles", "SELECT lang, doc_id FROM (SELECT lang, doc_id, doc_id - lag(doc_id) OVER (PARTITION BY lang ORDER BY doc_id) AS gap FROM @documents) WHERE gap <= 4")
_sql("identity_ranks", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY round(value), event_type, event_id) AS rank, count(*) OVER (PARTITION BY user_id, event_type) > 1 AS repeated FROM @events", "SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY round(value), event_type, event_id))::INT AS rank, count(*) OVER (PARTITION BY user_id, event_type) > 1 AS repeated FROM events")
_sql("contents_pages", "SELECT doc, page FROM (VALUES ('a', 1, 4, 0), ('a', 2, 3, 5), ('a', 3, 0, 6), ('b', 9, 10, 10), ('b', 8, 0, 7)) AS t(doc, page, titled, untitled) WHERE page <= 8 AND (titled >= 4 OR untitled >= 6)")
_sql("spanning_bands", "SELECT id, band, row_number() OVER (ORDER BY band, spans DESC, col, y) AS position FROM (SELECT id, col, y, spans, sum(spans) OVER (ORDER BY y, id ROWS UNBOUNDED PRECEDING) AS band FROM (VALUES ('t', 0, 0, 1), ('a', 0, 10, 0), ('b', 1, 11, 0), ('c', 0, 20, 0), ('u', 0, 30, 1), ('d', 1, 40, 0), ('e', 0, 41, 0)) AS t(id, col, y, spans))", "SELECT id, band::BIGINT AS band, (row_number() OVER (ORDER BY band, spans DESC, col, y))::INT AS position FROM (SELECT id, col, y, spans, sum(spans) OVER (ORDER BY y, id ROWS UNBOUNDED PRECEDING) AS band FROM (VALUES ('t', 0, 0, 1), ('a', 0, 10, 0), ('b', 1, 11, 0), ('c', 0, 20, 0), ('u', 0, 30, 1), ('d', 1, 40, 0), ('e', 0, 41, 0)) AS t(id, col, y, spans))")
_sql("size_levels", "SELECT ratio, CASE WHEN ratio >= 2.6e0 THEN 1 WHEN ratio >= 1.6e0 THEN 2 WHEN ratio >= 1.25e0 THEN 3 ELSE 4 END AS level FROM (VALUES (3e0), (2.6e0), (1.7e0), (1.3e0), (1e0)) AS t(ratio)")
_sql("single_edits", "SELECT a.n_name AS a, b.n_name AS b, levenshtein(a.n_name, b.n_name) AS edits FROM @nation a JOIN @nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey WHERE levenshtein(a.n_name, b.n_name) <= 1", "SELECT a.n_name AS a, b.n_name AS b, levenshtein(a.n_name, b.n_name)::INT AS edits FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey WHERE levenshtein(a.n_name, b.n_name) <= 1")
_sql("candidate_ids", "SELECT conv_id, turn, concat('cand-', substr(sha2(concat_ws(':', role, turn, length(text), lower(role)), 256), 1, 16)) AS candidate_id FROM @conversations", "SELECT conv_id, turn, 'cand-' || substr(sha256(concat_ws(':', role, turn, length(text), lower(role))), 1, 16) AS candidate_id FROM conversations")
_sql("quarter_turns", "SELECT angle, x, y, CASE angle WHEN 0 THEN x WHEN 90 THEN h - y WHEN 180 THEN w - x ELSE y END AS view_x, CASE angle WHEN 0 THEN y WHEN 90 THEN x WHEN 180 THEN h - y ELSE w - x END AS view_y FROM (VALUES (0, 1, 2, 100, 50), (90, 1, 2, 100, 50), (180, 1, 2, 100, 50), (270, 1, 2, 100, 50)) AS t(angle, x, y, w, h)")
_sql("flow_markdown", "SELECT conv_id, array_join(transform(array_sort(collect_list(struct(turn, CASE WHEN role = 'user' THEN concat('# ', coalesce(text, '')) ELSE coalesce(text, '') END AS md))), x -> x.md), '\\n\\n') AS md FROM @conversations GROUP BY conv_id", "SELECT conv_id, string_agg(CASE WHEN role = 'user' THEN '# ' || coalesce(text, '') ELSE coalesce(text, '') END, chr(10) || chr(10) ORDER BY turn, CASE WHEN role = 'user' THEN '# ' || coalesce(text, '') ELSE coalesce(text, '') END) AS md FROM conversations GROUP BY conv_id")
