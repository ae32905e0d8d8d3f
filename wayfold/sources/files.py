"""Readers and writers for dirty files: encodings, headers, wrapped JSON, shapes, rasters, OSM text."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.functions import text
from wayfold.operators import fuse

def file_encodings(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Encoding to the files of a path that it reads: UTF-8 where every line is valid UTF-8, else the Korean code page.

    Every file is judged by itself and to its end, by all executors; the driver gets a row a file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok"))
    per = lines.groupBy("file").agg(F.bool_and("ok").alias("ok")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(per, key=lambda r: r.file):
        out.setdefault("UTF-8" if r.ok else "x-windows-949", []).append(r.file)
    return out


def clean_header(name: str) -> str:
    return name.lstrip("﻿").strip().strip('"').strip()


def read_csv(spark: SparkSession, path: str, required: Sequence[str] = (), encoding: str | None = None, multi_line: bool = False) -> DataFrame:
    """All columns as trimmed text, with clean header names; a missing required column is an error.

    Without encoding every file is read in its own. Columns that only some files have are null in the others.
    """
    by_encoding = {encoding: [path]} if encoding else file_encodings(spark, path)
    if not by_encoding:
        raise FileNotFoundError(f"no lines in {path}")
    out: DataFrame | None = None
    for name, files in by_encoding.items():
        if name not in ("UTF-8", "ISO-8859-1", "US-ASCII"):
            spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # the reader else knows a few Western and Unicode charsets only
        df = spark.read.option("header", True).option("encoding", name).option("escape", '"').option("multiLine", multi_line).csv(files)
        df = df.toDF(*[clean_header(c) for c in df.columns])
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"{path} lacks {missing}")
        df = df.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str, columns: Sequence[str], single: bool = False) -> None:
    """Columns in a fixed order; single writes one file and is for small reports."""
    out = df.select(*columns)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_wrapped_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of `window.NAME = [...];` scripts; each file holds one small document."""
    whole = spark.read.option("wholetext", True).text(path)
    body = F.regexp_extract("value", r"(?s)=\s*(\[.*\]|\{.*\})\s*;?\s*$", 1)
    return whole.select(F.explode(F.from_json(body, f"array<struct<{schema}>>")).alias("r")).select("r.*")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """geometry_type, coordinates (JSON text), properties (map) of a FeatureCollection."""
    schema = "features array<struct<geometry: struct<type: string, coordinates: string>, properties: map<string, string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return rows.select(F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.properties").alias("properties"))


def manifest(df: DataFrame, group: Sequence[str], kind: str) -> DataFrame:
    """Rows and the kinds that occur in each group."""
    return df.groupBy(*group).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(kind)), ",").alias("kinds"))


def folder_manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, encoding, n_lines, header of every text file of a path."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.is_valid_utf8("value").alias("ok"), F.monotonically_increasing_id().alias("at"))
    first = F.min_by("value", F.when(F.col("block") == 0, F.col("at")))
    return lines.groupBy("file").agg(F.when(F.bool_and("ok"), "UTF-8").otherwise("x-windows-949").alias("encoding"), F.count("*").alias("n_lines"), first.alias("header"))


def with_path_part(df: DataFrame, name: str, pattern: str, group: int = 1) -> DataFrame:
    """A column taken from the path of the file that a row was read from."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, group))


# ---- shapefiles: polygons and attributes without a geometry library


def dbf_rows(data: bytes, encodings: Sequence[str] = ("utf-8", "cp949")) -> Iterator[dict[str, str]]:
    """Records of a dBASE table as text; deleted ones are left out."""
    n, head, size = struct.unpack("<IHH", data[4:12])
    fields, at = [], 32
    while at + 32 <= head and data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii", "replace"), data[at + 16]))
        at += 32
    for i in range(n):
        row = data[head + i * size : head + (i + 1) * size]
        if len(row) < size or row[:1] == b"*":
            continue
        out, pos = {}, 1
        for name, width in fields:
            raw = row[pos : pos + width]
            pos += width
            for e in encodings:
                try:
                    out[name] = raw.decode(e).strip(" \0")
                    break
                except UnicodeDecodeError:
                    out[name] = raw.decode("latin-1").strip(" \0")
        yield out


def shp_rings(data: bytes) -> Iterator[list[list[tuple[float, float]]]]:
    """Rings (or lines) of each polygon or polyline record; other kinds give an empty list."""
    at = 100
    while at + 8 <= len(data):
        length = struct.unpack(">i", data[at + 4 : at + 8])[0] * 2
        body = data[at + 8 : at + 8 + length]
        at += 8 + length
        if len(body) < 44 or struct.unpack("<i", body[:4])[0] not in (3, 5, 13, 15, 23, 25):
            yield []
            continue
        parts, points = struct.unpack("<ii", body[36:44])
        starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
        flat = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
        yield [[(flat[2 * k], flat[2 * k + 1]) for k in range(a, b)] for a, b in zip(starts, starts[1:])]


def read_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """path, record_no, rings, attributes of every .shp below the folder with its .dbf; one task a file."""
    pair = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{shp,dbf}").load(folder)
    pair = pair.select(F.regexp_replace("path", r"\.[^.]+$", "").alias("stem"), F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1)).alias("kind"), "content")
    both = pair.where("kind = 'shp'").select("stem", F.col("content").alias("shp")).join(pair.where("kind = 'dbf'").select("stem", F.col("content").alias("dbf")), "stem", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for stem, shp, dbf in zip(b.stem, b.shp, b.dbf):
                rings = list(shp_rings(bytes(shp)))
                rows = list(dbf_rows(bytes(dbf))) if dbf is not None else []
                rows += [{}] * (len(rings) - len(rows))
                yield pd.DataFrame({"path": stem, "record_no": range(len(rings)), "rings": [[[{"x": x, "y": y} for x, y in ring] for ring in rs] for rs in rings], "attributes": rows[: len(rings)]})

    return both.mapInPandas(run, "path string, record_no bigint, rings array<array<struct<x: double, y: double>>>, attributes map<string, string>")


# ---- rasters and OSM text


def sample_raster(points: DataFrame, cells: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """z of the cell under each point (x, y): an equi-join on row and column. cells: row, col, z; y falls with the row."""
    at = points.withColumn("col", F.floor((F.col("x") - x0) / size).cast("bigint")).withColumn("row", F.floor((F.lit(y0) - F.col("y")) / size).cast("bigint"))
    return at.join(cells, ["row", "col"], "left").drop("row", "col")


def escaped(c: Column) -> Column:
    for raw, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(mark))
    return c


def osm_nodes(nodes: DataFrame, segments: DataFrame) -> DataFrame:
    """osm_id, lon, lat, key of graph nodes and of inner points of lines; points with one coordinate key share a node.

    nodes: vertex_id, lon, lat; segments: edge_id, points. Graph nodes keep their ids, inner points
    get negative ones, numbered by key.
    """
    keyed = nodes.select(F.col("vertex_id").alias("osm_id"), "lon", "lat", text.coordinate_key(F.col("lon"), F.col("lat")).alias("key"))
    inner = F.slice("points", F.lit(2), F.greatest(F.size("points") - 2, F.lit(0)))
    shape = segments.select(F.explode(inner).alias("p")).select(F.col("p.x").alias("lon"), F.col("p.y").alias("lat"), text.coordinate_key(F.col("p.x"), F.col("p.y")).alias("key"))
    extra = shape.groupBy("key").agg(F.min("lon").alias("lon"), F.min("lat").alias("lat")).join(keyed.select("key").distinct(), "key", "left_anti")
    numbered = fuse.renumber(extra, "n_", "key")
    return keyed.unionByName(numbered.select((-F.col("n_")).alias("osm_id"), "lon", "lat", "key"))


#: fixed values: tags of every way
WAY_TAGS = {"highway": "footway", "foot": "yes", "oneway": "no"}


def osm_ways(segments: DataFrame, osm: DataFrame, tags: Mapping[str, str], source: str = "graph", prefix: str = "") -> DataFrame:
    """edge_id, refs, tags: a way runs from its from_node_id over the nodes of its inner points to its to_node_id, repeats dropped.

    The ends are the graph's own nodes, wherever the drawn line ends, so that ways stay connected; an
    end that is no node is an error. tags: tag to column, written with the prefix, UNKNOWN for blanks.
    """
    ids = osm.groupBy("key").agg(F.min_by("osm_id", F.struct((F.col("osm_id") < 0), "osm_id")).alias("osm_id"))
    inner = F.slice("points", F.lit(2), F.greatest(F.size("points") - 2, F.lit(0)))
    at = segments.select("edge_id", F.posexplode(inner).alias("pos", "p")).select("edge_id", "pos", text.coordinate_key(F.col("p.x"), F.col("p.y")).alias("key")).join(ids, "key")
    middle = at.groupBy("edge_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "osm_id"))), lambda s: s.osm_id).alias("middle"))  # points of one line
    own = osm.where("osm_id >= 0").select("osm_id").distinct()
    j = segments.join(middle, "edge_id", "left")
    for end in ("from", "to"):
        j = j.join(own.select(F.col("osm_id").alias(f"{end}_node_id"), F.lit(True).alias(f"{end}_ok")), f"{end}_node_id", "left")
    sure = F.when(F.col("from_ok") & F.col("to_ok"), F.col("edge_id")).otherwise(F.raise_error(F.format_string("edge %d ends at a node that does not exist", "edge_id")).cast("bigint"))
    all_ = F.concat(F.array("from_node_id"), F.coalesce("middle", F.array().cast("array<bigint>")), F.array("to_node_id"))
    refs = F.filter(all_, lambda v, i: (i == 0) | (v != F.get(all_, i - 1)))
    fixed = [F.lit(x) for kv in (WAY_TAGS | {"source": source}).items() for x in kv]
    filled = [x for tag, c in tags.items() for x in (F.lit(prefix + tag), F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("UNKNOWN")))]
    return j.select(sure.alias("edge_id"), refs.alias("refs"), F.create_map(*fixed, *filled).alias("tags"))


def osm_lines(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """Text lines of OSM XML elements, one element a row; a header and footer go around the files."""
    n = nodes.select(F.format_string('<node id="%d" lat="%.8f" lon="%.8f"/>', "osm_id", "lat", "lon").alias("value"))
    refs = F.array_join(F.transform("refs", lambda r: F.format_string('<nd ref="%d"/>', r)), "")
    tags = F.array_join(F.transform(F.map_entries("tags"), lambda e: F.concat(F.lit('<tag k="'), escaped(e.key), F.lit('" v="'), escaped(e.value), F.lit('"/>'))), "")
    w = ways.select(F.concat(F.format_string('<way id="%d">', "edge_id"), refs, tags, F.lit("</way>")).alias("value"))
    return n.unionByName(w)
