"""Reading tracking events and bulk extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.schema import TRACKING_EVENT, TYPED_FIELDS

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def read_tracking_events(spark: SparkSession, path: str, fmt: str = "text", stream: bool = False) -> DataFrame:
    """One JSON document per line (or a ``value`` column of another format) as parsed columns; bad rows are kept."""
    reader = spark.readStream if stream else spark.read
    if fmt == "text":
        return parse_documents(reader.text(path))
    return parse_documents(reader.format(fmt).schema("value string").load(path))


def parse_documents(df: DataFrame, body: str = "value") -> DataFrame:
    """Parse the document column once: its fields become columns, ``_corrupt`` holds text that is no JSON object.

    ``_typed`` tells whether the identifying fields are JSON strings.
    """
    # A filter on the fields would be moved below their reading, which it then repeats for every field it names. Spark moves none
    # below an expression that is not deterministic, as the partition number is. So texts are parsed, and variants read, once a row.
    once = lambda c: F.when(F.spark_partition_id() >= 0, c)
    parsed = df.withColumn("_doc", once(F.from_json(F.col(body), TRACKING_EVENT, _JSON_OPTIONS)))
    kind = lambda f: F.coalesce(F.schema_of_variant(F.col(f"_doc.{f}")) == "STRING", F.lit(False))
    typed = kind(TYPED_FIELDS[0])
    for f in TYPED_FIELDS[1:]:
        typed = typed & kind(f)
    fields = [once(F.try_variant_get(F.col(f"_doc.{n}"), "$", "string")).alias(n) if n in TYPED_FIELDS else F.col(f"_doc.{n}")
              for n in TRACKING_EVENT.fieldNames()]
    return parsed.select(*df.columns, *fields, once(typed).alias("_typed"))


def decode_envelope(df: DataFrame, data_col: str = "data", body: str = "value") -> DataFrame:
    """Queue record to parsed document: base64, UTF-8, JSON."""
    text = F.decode(F.try_to_binary(F.col(data_col), F.lit("base64")), "UTF-8")
    return parse_documents(df.withColumn(body, text), body)


def read_bulk_profiles(spark: SparkSession, path: str, fmt: str, mapping: dict[str, str],
                       options: dict | None = None) -> DataFrame:
    """Load a JSON, CSV, ORC or Parquet extract and rename its fields to staging attributes.

    Only mapped fields are read; a mapped value may be any SQL expression over source fields.
    """
    reader = spark.read.options(**({"header": "true"} if fmt == "csv" else {}), **(options or {}))
    return map_fields(reader.format(fmt).load(path), mapping)


def map_fields(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(source).alias(target) for target, source in mapping.items()])
