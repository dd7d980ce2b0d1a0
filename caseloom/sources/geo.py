"""GeoJSON in and out."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.text import col


def read_geojson(spark: SparkSession, path: str, properties: list[str], id_property: str) -> DataFrame:
    """Features of a collection: the named properties as strings, ``area_id`` and ``geometry`` (GeoJSON text).

    Only longitude-latitude coordinates are accepted (no ``crs`` or EPSG:4326).
    """
    raw = spark.read.text(path, wholetext=True)
    crs = raw.select(F.get_json_object("value", "$.crs.properties.name")).first()[0]
    if crs and not crs.upper().replace("::", ":").endswith(("EPSG:4326", "CRS84")):
        raise ValueError(f"coordinates must be EPSG:4326, not {crs}")
    f = raw.select(F.explode(F.from_json(F.get_json_object("value", "$.features"), "array<string>")).alias("_f"))
    prop = lambda p: F.get_json_object("_f", f"$.properties['{p}']")
    return f.select(prop(id_property).alias("area_id"), *[prop(p).alias(p) for p in properties if p != "area_id"], F.get_json_object("_f", "$.geometry").alias("geometry"))


def feature_lines(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature a row, ready for ``write.text``."""
    props = F.to_json(F.struct(*[col(c) for c in df.columns if c != geometry]))
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), F.coalesce(col(geometry), F.lit("null")), F.lit("}")).alias("value"))


def write_geojson(df: DataFrame, path: str, geometry: str = "geometry") -> None:
    """A small result (a report's areas) as one FeatureCollection, streamed feature by feature."""
    with open(path, "w") as f:
        f.write('{"type":"FeatureCollection","features":[')
        for i, r in enumerate(feature_lines(df, geometry).toLocalIterator()):
            f.write("," * (i > 0) + json.dumps(json.loads(r["value"])))
        f.write("]}")
