"""File sources and sinks (S1-S5, S9, K1-K8) with explicit schemas, no inference.

Readers return DataFrames; writers take a DataFrame and a path. Parquet is
the engine's default format; CSV / JSON / XML forms are here for exchange.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

NODE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])

POI_SCHEMA = T.StructType([
    T.StructField("osm_id", T.LongType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("name", T.StringType()),
])

CLEANED_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("num_bus_2km", T.IntegerType()),
    T.StructField("num_subway_2km", T.IntegerType()),
    T.StructField("num_shop_2km", T.IntegerType()),
    T.StructField("nearest_shop_m", T.FloatType()),
    T.StructField("num_restaurant_2km", T.IntegerType()),
    T.StructField("neighbourhood_cleansed", T.StringType()),
    T.StructField("room_type", T.StringType()), T.StructField("accommodates", T.IntegerType()),
    T.StructField("baths", T.FloatType()), T.StructField("beds", T.IntegerType()),
    T.StructField("days", T.IntegerType()), T.StructField("amenities", T.IntegerType()),
    T.StructField("price", T.FloatType()), T.StructField("future_occupancy", T.FloatType()),
])

REVIEW_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("date", T.DateType()), T.StructField("reviewer_id", T.LongType()),
    T.StructField("reviewer_name", T.StringType()), T.StructField("comments", T.StringType()),
])

SCORE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("listing_id", T.LongType()),
    T.StructField("reviewer_id", T.LongType()), T.StructField("comments", T.StringType()),
    T.StructField("score", T.DecimalType(32, 18)),
])

_XML_NODE_SCHEMA = T.StructType([
    T.StructField("_id", T.LongType()),
    T.StructField("_timestamp", T.StringType()),
    T.StructField("_lat", T.DoubleType()),
    T.StructField("_lon", T.DoubleType()),
    T.StructField("tag", T.ArrayType(T.StructType([
        T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())]))),
])


def _csv_reader(spark: SparkSession):
    # Quoted multi-line cells; a doubled quote inside a quoted cell is a literal quote.
    return (spark.read.option("multiLine", "true").option("header", "true")
            .option("quote", '"').option("escape", '"'))


def read_text_csv(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Header CSV with every column as text (no inference).

    With ``columns`` the schema is fixed up front (faster: no header pass to
    discover names); otherwise the header names are used.
    """
    reader = _csv_reader(spark)
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return reader.schema(schema).csv(path)
    return reader.csv(path)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema (columns by position)."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def read_typed_csv_drop_malformed(spark: SparkSession, path: str,
                                  schema: T.StructType) -> DataFrame:
    """S3: typed multi-line CSV without malformed rows, independent of column pruning.

    Every column is read as text together with the parser's corrupt-record
    column; a row is dropped when the parser flags it (wrong cell count,
    broken quoting) or when any non-NULL cell does not convert to its type.
    Because the filter references every column, pruning a later projection
    cannot change which rows survive.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                               + [T.StructField(CORRUPT, T.StringType())])
    raw = (_csv_reader(spark).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).schema(text_schema).csv(path))
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    bad = F.col(CORRUPT).isNotNull()
    for f in schema.fields:
        bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    return raw.where(~bad).select(*typed)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines (file, folder or .gz) with a fixed schema."""
    return spark.read.schema(schema).json(path)


def read_osm_xml(spark: SparkSession, path: str) -> DataFrame:
    """``<node id lat lon timestamp><tag k v/>...</node>`` records -> node table.

    One distributed scan with Spark's XML source (row tag ``node``; other
    elements are skipped). Tags become a map; a repeated key keeps its last
    value (session ``mapKeyDedupPolicy=LAST_WIN``); a node without tags gets
    an empty map.
    """
    raw = (spark.read.format("xml").option("rowTag", "node")
           .schema(_XML_NODE_SCHEMA).load(path))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    tags = F.coalesce(
        F.map_from_entries(F.transform("tag", lambda x: F.struct(x["_k"], x["_v"]))), empty)
    return raw.select(F.col("_id").alias("id"), F.col("_timestamp").alias("timestamp"),
                      F.col("_lat").alias("lat"), F.col("_lon").alias("lon"),
                      tags.alias("tags"))


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "errorifexists",
              compression: str | None = None, single_file: bool = False) -> None:
    """CSV with quotes escaped by doubling (multi-line cells survive).

    ``single_file`` writes one part through ``repartition(1)``, which keeps
    the upstream plan parallel; use it only for small summary tables.
    """
    out = df.repartition(1) if single_file else df
    w = out.write.mode(mode).option("header", str(header).lower()).option("escape", '"')
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite",
               compression: str | None = "gzip", single_file: bool = False) -> None:
    """K5 / K6: JSON lines, gzip by default; one part file when ``single_file``."""
    out = df.repartition(1) if single_file else df
    w = out.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_partitioned_csv(df: DataFrame, path: str, key: str, *,
                          mode: str = "overwrite") -> None:
    """K8: one folder per key value (e.g. per-reviewer recommendations)."""
    df.write.mode(mode).partitionBy(key).option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by=None) -> None:
    """Default engine sink."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    """K7: save a fitted pipeline, replacing an existing one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(path)
