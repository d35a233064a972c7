"""GeoJSON FeatureCollection source and sink.

The writer puts a whole collection on one line and many collections into a file: line-delimited JSON,
which is read in parallel. A document over many lines is cut at the borders of its features from byte
ranges (``splits``), so one large file is read by many tasks too. Files with one feature per line are read as
splittable text, with an error for any line that is neither a feature nor part of the collection's frame.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package
from tessera.sources.splits import json_features

POINT = T.StructType([T.StructField("type", T.StringType()),
                      T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
POLYGON = T.StructType([T.StructField("type", T.StringType()),
                        T.StructField("coordinates",
                                      T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))])


def feature_schema(properties: T.StructType, geometry: T.DataType = POINT) -> T.StructType:
    return T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("properties", properties),
                         T.StructField("geometry", geometry)])


def collection_schema(properties: T.StructType, geometry: T.DataType = POINT) -> T.StructType:
    features = T.ArrayType(feature_schema(properties, geometry))
    return T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("features", features)])


#: frame of a collection around its features: what may stand before them on a line, and lines
#: that hold other members of the collection or brackets only
_BEFORE = r'^\s*(\{.*?)?"features"\s*:\s*\['
_FRAME = r'^\s*([\[\]{},\s]*|\{?\s*"(?!features")[^"]+"\s*:.*)$'


def _line_features(value: Column, schema: T.StructType) -> Column:
    """The features on one line of a collection, whatever else the line holds; an error if it holds
    something that is no feature."""
    inner = F.regexp_replace(F.regexp_replace(value, _BEFORE, ""), r",\s*$", "")
    parsed = F.from_json(F.concat(F.lit("["), inner, F.lit("]")), T.ArrayType(schema))
    whole = F.coalesce(F.size(parsed) > 0, F.lit(False)) & F.forall(
        parsed, lambda f: F.coalesce(f["type"] == "Feature", F.lit(False)))
    frame = inner.rlike(r"^[\[\]{},\s]*$") | (value.rlike(_FRAME) & ~value.rlike(r'"type"\s*:\s*"Feature"'))
    return F.when(whole, parsed).when(frame, F.array().cast(T.ArrayType(schema))).otherwise(
        F.raise_error(F.concat(F.lit("not a GeoJSON feature line: "), F.substring(value, 1, 200))))


def read_features(spark: SparkSession, path: str, properties: T.StructType,
                  geometry: T.DataType = POINT, layout: str = "document_per_line") -> DataFrame:
    """One row per feature with columns ``type, properties, geometry`` (explode of S9/P13).

    ``layout``: ``document_per_line`` (a collection on each line, what the writer makes; any other line stops the
    job), ``document`` (collections over any lines: files of any size are cut at feature borders and read by
    many tasks, see ``splits``) or ``feature_per_line``."""
    if layout == "document":
        found = F.from_json("text", feature_schema(properties, geometry))
        return json_features(spark, path).select(found.alias("f")).select("f.*")
    if layout == "document_per_line":
        docs = (spark.read.schema(collection_schema(properties, geometry))
                .option("recursiveFileLookup", True).json(path))
        held = F.when(F.col("features").isNotNull(), F.col("features")).otherwise(F.raise_error(F.lit(
            "a line is no whole FeatureCollection; collections over several lines need layout='document'")))
        return docs.select(F.explode(held).alias("features")).select("features.*")
    if layout == "feature_per_line":
        lines = spark.read.option("recursiveFileLookup", True).text(path)
        found = _line_features(F.col("value"), feature_schema(properties, geometry))
        return lines.select(F.explode(found).alias("f")).select("f.*")
    raise ValueError(f"unknown layout {layout!r}")


def flatten_properties(features: DataFrame, keep_geometry: bool = True) -> DataFrame:
    """Lift every field of ``properties`` to a top-level column (P15); names are read off the
    schema, so any property set works. ``geometry`` is carried through untouched."""
    names = features.schema["properties"].dataType.fieldNames()
    cols: list[Column | str] = [F.col("properties").getField(n).alias(n) for n in names]
    if keep_geometry:
        cols.append("geometry")
    return features.select(*cols)


def _feature_json(properties: Sequence[str], geometry: Column, options: dict[str, str] | None = None) -> Column:
    return F.to_json(F.struct(F.lit("Feature").alias("type"),
                              F.struct(*[F.col(p) for p in properties]).alias("properties"),
                              geometry.alias("geometry")), options)


def write_collections(df: DataFrame, path: str, properties: Sequence[str],
                      geometry: Column, features_per_doc: int = 1_000) -> None:
    """Write ``df`` as GeoJSON FeatureCollections of up to ``features_per_doc`` features, one
    collection per line.

    Features are made by built-in functions; a task then strings its own rows together as they come
    (Arrow batches), so nothing is shuffled or counted, no more than one collection is held, and a task
    that runs again writes its file anew. An empty partition writes no collection."""
    ship_package(df.sparkSession)

    def collections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            held.extend(batch.column("value").to_pylist())
            full = len(held) - len(held) % features_per_doc
            yield _as_documents(held[:full], features_per_doc)
            held = held[full:]
        yield _as_documents(held, features_per_doc)

    (df.select(_feature_json(properties, geometry).alias("value"))
     .mapInArrow(collections, "value string").write.mode("overwrite").text(path))


def _as_documents(features: list[str], per_doc: int) -> pa.RecordBatch:
    lines = ['{"type":"FeatureCollection","features":[' + ",".join(features[i:i + per_doc]) + "]}"
             for i in range(0, len(features), per_doc)]
    return pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})


def write_feature_lines(df: DataFrame, path: str, properties: Sequence[str], geometry: Column) -> None:
    """Write ``df`` with one feature per line, separated by commas; the frame is left to who joins the
    files (``feature_per_line`` reads them with or without it)."""
    line = F.concat(_feature_json(properties, geometry), F.lit(","))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str, properties: Sequence[str], geometry: Column) -> None:
    """Write ``df`` as GeoJSON documents over many lines, one per task: a file is one FeatureCollection with every
    member on a line of its own. Nothing is held; an empty partition writes an empty file."""
    ship_package(df.sparkSession)
    one = _feature_json(properties, geometry, {"pretty": "true"})

    def framed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: str | None = None
        for batch in batches:
            lines = []
            for text in batch.column("value").to_pylist():
                lines.append('{\n"type": "FeatureCollection",\n"features": [' if last is None else f"{last},")
                last = text
            yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
        if last is not None:
            yield pa.RecordBatch.from_pydict({"value": pa.array([f"{last}\n]\n}}"], pa.string())})

    df.select(one.alias("value")).mapInArrow(framed, "value string").write.mode("overwrite").text(path)
