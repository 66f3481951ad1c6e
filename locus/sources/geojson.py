"""GeoJSON region scan and sink.

Two layouts are read:

* FeatureCollection documents.  A document is read by as many tasks as it has splits: the text reader cuts it at every
  ``"Feature"`` (the value of each feature's type member), each piece closes one feature and opens the next, and what a split's first
  and last piece leave over (two rows a split) is put together across splits.  A feature may be laid out over any lines, its members in any order.
  ``"type": "Feature"`` inside a feature's own members raises;
* newline-delimited features (one Feature per line; splittable, what the sink writes).

``id`` is optional in GeoJSON and may be a number or a string.  Features are ordered (J5) by
``feature_order``: first those whose id is a whole number, by it; then by file and by place in the
file (position in the collection, or start of the block and row in it).

Geometry coordinates are read as raw JSON text and parsed by geometry type,
since a Polygon is 3 arrays deep and a MultiPolygon 4; both come out as a
MultiPolygon: polygons -> rings -> vertices -> (lon, lat) (J4).
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from locus.runtime import materialize

# Task closures call this module's functions; see functions.centers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = "array<array<array<array<double>>>>"

_GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", T.StringType()),   # raw JSON, parsed by type
])
_PROPS = T.StructType([
    T.StructField("prov_name", T.StringType()),
    T.StructField("reg_name", T.StringType()),
])
FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),   # number or string, or absent
    T.StructField("properties", _PROPS),
    T.StructField("geometry", _GEOMETRY),
])
COLLECTION_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(FEATURE_SCHEMA)),
])


def as_multipolygon(geom_type: F.Column, coords_json: F.Column) -> F.Column:
    """Polygon -> [polygon]; MultiPolygon as is."""
    return (F.when(geom_type == "Polygon", F.array(F.from_json(coords_json, POLYGON)))
            .when(geom_type == "MultiPolygon", F.from_json(coords_json, MULTIPOLYGON)))


def _regions(features: DataFrame) -> DataFrame:
    """``features``: f, and its place: file, pos."""
    number = F.when(F.col("f.id").rlike("^-?[0-9]{1,18}$"), F.col("f.id").cast("long"))
    return features.select(
        number.alias("feature_id"),
        F.struct(number.isNull().alias("unnumbered"), F.coalesce(number, F.lit(0)).alias("number"),
                 "file", "pos").alias("feature_order"),
        F.col("f.properties.prov_name").alias("prov_name"),
        F.col("f.properties.reg_name").alias("reg_name"),
        as_multipolygon(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geometry"))


# --- FeatureCollection documents, cut into pieces

MARK = '"Feature"'
_BRACES = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]')
_FEATURES = re.compile(r'"features"\s*:\s*\[')
_OPENS = re.compile(r'"type"\s*:\s*$')
#: Places of a split, for the running numbers of its pieces.
PLACES = 1 << 24
PIECES = "file string, block bigint, place bigint, head string, tail string"


def closed(piece: str) -> tuple[str, str | None]:
    """(tail, head): the end of the feature that is open at the piece's start, and the beginning of the next (null after the last)."""
    depth = 1
    for m in _BRACES.finditer(piece):
        depth += {"{": 1, "}": -1}.get(m.group(), 0)
        if not depth:
            rest = piece[m.end():].lstrip()
            return piece[:m.end()], rest[1:] if rest.startswith(",") else None
    raise ValueError('a feature is cut: "Feature" stands within its own members')


def halves(texts: Iterator[tuple[str, int, str]]) -> Iterator[tuple]:
    """Rows of a task, in file order -> (file, block, place, head, tail): whole features, and for each block a tail without
    its head (place 0) and a head without its tail (place -1)."""
    now, head, place = None, None, 0
    for file, block, text in texts:
        if (file, block) != now:
            if now and head is not None:
                yield *now, -1, head, None
            now, head, place = (file, block), None, 0
            if block == 0:
                # What stands before the first feature.
                start = _FEATURES.search(text)
                rest = text[start.end():].lstrip() if start else "]"
                head = rest if rest.startswith("{") else None
                continue
        if head is not None and not _OPENS.search(head):
            # Not a type's value: the piece goes on where the one before ended.
            raise ValueError('"Feature" is not the type of a feature')
        tail, rest = closed(text)
        yield file, block, place, head, tail
        head, place = rest, place + 1
    if now and head is not None:
        yield *now, -1, head, None


def _halves(batches):
    rows = ((f.as_py(), b.as_py(), t.as_py()) for batch in batches for f, b, t in zip(*batch.columns))
    out: list[tuple] = []
    size = 0
    names = ["file", "block", "place", "head", "tail"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for row in halves(rows):
        out.append(row)
        size += sum(len(x or "") for x in row[3:])
        if size >= 8 << 20 or len(out) >= 2000:
            yield batch()
            out.clear()
            size = 0
    if out:
        yield batch()


def collection_features(spark: SparkSession, path: str) -> DataFrame:
    """(f, file, pos) of every feature of FeatureCollection documents."""
    pieces = spark.read.option("lineSep", MARK).text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), "value")
    parts = materialize(pieces.mapInArrow(_halves, PIECES), "geo-pieces")
    # Two rows a split at most: the head that the split before left over belongs to a split's first tail.
    over = parts.filter("place = -1 OR place = 0 AND head IS NULL").withColumn(
        "kept", F.lag("head").over(Window.partitionBy("file").orderBy("block", F.col("place") == -1)))
    joined = over.filter("place = 0").select("file", "block", "place", F.col("kept").alias("head"), "tail")
    whole = parts.filter("place >= 0 AND head IS NOT NULL").unionByName(joined)
    text = F.concat("head", F.lit(MARK), "tail")
    return whole.select(F.from_json(text, FEATURE_SCHEMA).alias("f"), "file", (F.col("block") * PLACES + F.col("place")).alias("pos"))


def read_regions(spark: SparkSession, path: str, collection: bool = False) -> DataFrame:
    """(feature_id, feature_order, prov_name, reg_name, geometry MULTIPOLYGON array).

    feature_id is null where the feature has no whole number as its id.
    """
    if collection:
        return _regions(collection_features(spark, path))
    # Rows of a block come in file order, so the running number in a partition orders them.
    feats = spark.read.schema(FEATURE_SCHEMA).json(path).select(
        F.struct("type", "id", "properties", "geometry").alias("f"), F.input_file_name().alias("file"),
        (F.input_file_block_start() * (1 << 20) + F.monotonically_increasing_id() % (1 << 33)).alias("pos"))
    return _regions(feats)


def write_features(regions: DataFrame, path: str) -> None:
    """Write (feature_id, prov_name, reg_name, geom_type, coords_json) as
    newline-delimited GeoJSON Features; ``coords_json`` is the coordinates
    member as JSON text (its depth depends on the geometry type)."""
    feature_lines(regions).write.mode("overwrite").text(path)


def write_collections(regions: DataFrame, path: str) -> None:
    """The same as FeatureCollection documents, one for each task."""
    def document(batches):
        last = None
        for batch in batches:
            for line in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(['{"type":"FeatureCollection","features":[' if last is None else last + ","])], ["value"])
                last = line.as_py()
        yield pa.RecordBatch.from_arrays([pa.array([last + "]}"] if last else [], pa.string())], ["value"])

    feature_lines(regions).mapInArrow(document, "value string").write.mode("overwrite").text(path)


def feature_lines(regions: DataFrame) -> DataFrame:
    line = F.concat(
        F.lit('{"type":"Feature","id":'), F.col("feature_id").cast("string"),
        F.lit(',"properties":'), F.to_json(F.struct("prov_name", "reg_name")),
        F.lit(',"geometry":{"type":"'), F.col("geom_type"), F.lit('"'),
        F.lit(',"coordinates":'), F.col("coords_json"), F.lit("}}"))
    return regions.select(line.alias("value"))
