"""Readers. Schemas are always given or come from Parquet; nothing is inferred from text."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INVENTORY = "document_id string, relative_path string, company_id string, year string, sha256 string, pages string, status string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of texts in an Arrow batch; 10,000 long texts at once are hundreds of MB as Python strings
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of this session are cut by bytes, beside Spark's cut by rows, unless a smaller bound is set."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if not (now and now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        spark.conf.set(name, str(BATCH_BYTES))


def file_snapshot(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below path with their size and SHA-256, and the first path that has the same content."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    hashed = files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    first = F.min("path").over(Window.partitionBy("sha256"))
    return hashed.withColumn("duplicate_of", F.when(first != F.col("path"), first))


def changed_files(before: DataFrame, now: DataFrame) -> DataFrame:
    """Files of `now` that the earlier snapshot does not hold as they are."""
    return now.join(before, ["path", "sha256"], "left_anti")


def dictionary_lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a keyword file in order. It is read on the driver because the dictionary is bounded."""
    return [r.value for r in spark.read.text(path).collect()]


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """The source inventory CSV, with missing values spelled "unknown"."""
    rows = spark.read.schema(INVENTORY).option("header", True).option("enforceSchema", False).csv(path)
    return rows.fillna("unknown", ["company_id", "year"])


def read_again(df: DataFrame, name: str, form: str) -> DataFrame:
    """df written in a text form (csv or json) to the folder named in spark.checkpoint.dir, which all executors share, and read from there with its own types.

    Where the setting is missing, on a local master alone, a fresh temporary folder is taken.
    """
    spark = df.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='leafmark-')}"
    path = f"{base.rstrip('/')}/leafmark-artifacts/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("ignoreNullFields", "false")
    (writer.option("header", "true") if form == "csv" else writer).format(form).save(path)
    return spark.read.format(form).option("header", "true").schema(df.schema).load(path)


RULE_FIELDS = ("schema_version", "updated_at_utc", "curator", "normalization_policy", "approved_global_aliases", "disallowed_false_positives")


def rules(spark: SparkSession, path: str, schema_version: str) -> DataFrame:
    """(status, keyword, alias, required_before, required_after) of a rule file, one JSON object. It is read on the driver because rules are bounded by the dictionary.

    Refused with ValueError: a key said twice, unknown or missing fields, another version or policy, blank or untrimmed texts, an alias both approved and disallowed.
    """
    import json

    def once(pairs):
        if len(dict(pairs)) < len(pairs):
            raise ValueError(f"a key occurs twice in {path}")
        return dict(pairs)

    def text(value, optional=False):
        if value is None and optional:
            return None
        if not isinstance(value, str) or not value.strip() or value != value.strip():
            raise ValueError(f"not a trimmed text in {path}: {value!r}")
        return value

    data = json.loads(spark.read.text(path, wholetext=True).first().value, object_pairs_hook=once)
    if not isinstance(data, dict) or set(data) != set(RULE_FIELDS) or data["schema_version"] != schema_version or data["normalization_policy"] != "NFC_CASEFOLD":
        raise ValueError(f"unknown fields, version or policy in {path}")
    text(data["curator"])
    rows, seen = [], {}
    for field, status in (("approved_global_aliases", "ACCEPTED"), ("disallowed_false_positives", "REJECTED")):
        for keyword, aliases in data[field].items():
            for a in aliases:
                a = {"alias": a} if isinstance(a, str) else a
                if not set(a) <= {"alias", "required_before", "required_after"}:
                    raise ValueError(f"unknown fields of a rule in {path}: {sorted(a)}")
                row = status, text(keyword), text(a.get("alias")), text(a.get("required_before"), True), text(a.get("required_after"), True)
                if seen.setdefault(row[1:3], status) != status:
                    raise ValueError(f"approved and disallowed at once in {path}: {row[2]}")
                rows.append(row)
    return spark.createDataFrame(rows, "status string, keyword string, alias string, required_before string, required_after string").distinct()
