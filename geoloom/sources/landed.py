"""Sources: landed files of the web services and archives, each with a schema or an explicit dialect."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo

#: The characters of windows-1252 where it differs from ISO-8859-1.
CP1252 = {b: c for b in range(0x80, 0xA0) if (c := bytes([b]).decode("cp1252", "ignore"))}
COORDINATES = "array<array<array<array<double>>>>"


def csv_rows(spark: SparkSession, path: str | list[str], multiline: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """All columns as text, doubled quotes unescaped, short rows padded; repeated headers are numbered from 2 on and byte-order marks dropped. gzip is told by the file name. Files of one call share their header."""
    options = {"quote": '"', "escape": '"', "multiLine": multiline, "mode": "PERMISSIVE", "encoding": encoding}
    first = spark.read.csv(path, header=False, **options).first() or ()
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(first))])
    return spark.read.csv(path, header=True, schema=schema, **options).toDF(*header_names(first))


def header_names(names) -> list[str]:
    """Trimmed, without a byte-order mark; repeated ones are numbered from 2 on."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        n = (n or "").lstrip("\ufeff").strip()
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return out


def geojson(spark: SparkSession, path: str | list[str], properties: str, lines: bool = False) -> DataFrame:
    """Features with typed properties, geometry_type and coordinates (as text). properties: their DDL schema. A file is one collection, whose text a task reads whole and whose features are rows from then on; with lines, each line is a feature, which reads in parallel: large sets belong there. What is not JSON or no collection (feature) raises an error."""
    feature = f"struct<type:string,id:string,geometry:struct<type:string,coordinates:string>,properties:struct<{properties}>>"
    raw = spark.read.text(path, wholetext=not lines).where(F.trim("value") != "")
    if lines:
        found = raw.select(F.from_json("value", feature).alias("f"), "value").where(_proven(F.col("f.type") == "Feature", "value"))
        return found.select(F.lit(None).cast("int").alias("feature_index"), F.col("f.properties.*"), F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))
    found = raw.select(F.from_json("value", f"struct<type:string,features:array<{feature}>>").alias("c"), "value").where(_proven(F.col("c.type") == "FeatureCollection", "value"))
    return found.select(F.posexplode("c.features").alias("feature_index", "f")).select("feature_index", F.col("f.properties.*"), F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def split_geojson(spark: SparkSession, path: str | list[str], properties: str) -> DataFrame:
    """As geojson(), without the features' numbers, for large collections: one file is read by many tasks, each from the first feature that begins in its range of bytes. Files of one call are written alike: every feature begins with its type, spaced as the first one of all. Other files raise an error, and are for geojson()."""
    feature = f"struct<type:string,id:string,geometry:struct<type:string,coordinates:string>,properties:struct<{properties}>>"
    mark = '"Feature"'
    # A quote inside of a JSON text is escaped, so the mark is no part of one.
    heads = spark.read.text(path, lineSep=mark).where(F.regexp_count("value", F.lit(r'"type"\s*:\s*"FeatureCollection"')) > 0).select(F.regexp_extract("value", r'(\{\s*"type"\s*:\s*)$', 1))
    found = heads.first()
    if found is None:
        return geojson(spark, path, properties)
    if not found[0]:
        raise ValueError("features do not begin with their type: read them with geojson()")
    begin = found[0] + mark
    parts = spark.read.text(path, lineSep=begin)
    # What stands before the first feature of a file holds no other one; a part with another feature is written unlike.
    other = F.col("value").rlike(r'"type"\s*:\s*"Feature"')
    alike = F.coalesce(F.when(~other, True), F.raise_error(F.concat(F.lit("features are written in several ways: "), F.substring("value", 1, 80))).cast("boolean"))
    head = F.col("value").rlike(r'^\s*\{[\s\S]*"type"\s*:\s*"FeatureCollection"')
    # Before a file's first feature there may be a comma, and in a file without any the end of the collection.
    between = F.col("value").rlike(r"^\s*,?\s*(\][\s\S]*)?$")
    rows = parts.where(alike & ~head & ~between).select(F.from_json(F.concat(F.lit(begin), F.regexp_replace("value", r"[\s,]+$", "")), feature).alias("f"), "value")
    return rows.where(_proven(F.col("f.type") == "Feature", "value")).select(F.col("f.properties.*"), F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def _proven(condition: Column, text: str) -> Column:
    """True, or an error that shows where the text begins."""
    return F.coalesce(F.when(condition, True), F.raise_error(F.concat(F.lit("no feature or collection: "), F.substring(text, 1, 80))).cast("boolean"))


def polygon_parts(kind: Column, coordinates: Column) -> Column:
    """A multipolygon from coordinate text; null for other geometries."""
    ring = lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    parts = F.when(kind == "MultiPolygon", F.from_json(coordinates, COORDINATES)).when(kind == "Polygon", F.array(F.from_json(coordinates, "array<array<array<double>>>")))
    return F.transform(parts, lambda p: F.transform(p, ring))


def esri_features(spark: SparkSession, path: str | list[str], attributes: str) -> DataFrame:
    """Rows of {attributes, geometry: {x, y | paths | rings}} arrays in projected metres."""
    schema = f"array<struct<attributes:struct<{attributes}>,geometry:struct<x:double,y:double,paths:array<array<array<double>>>,rings:array<array<array<double>>>>>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", schema)).alias("f"))
    return rows.select("f.attributes.*", "f.geometry.*")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of all ZIP files below a path, without side-car files."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return df.where(~F.element_at(F.split("path", "/"), -1).startswith("._"))


def archive_members(zips: DataFrame) -> DataFrame:
    """(path, member, size); archives that cannot be read give one row with an error instead of failing the job."""

    def rows(frames):
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out += [(path, m.filename, m.file_size, None) for m in zipfile.ZipFile(io.BytesIO(content)).infolist()]
                except zipfile.BadZipFile as e:
                    out.append((path, None, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "member", "size", "error"]).astype({"size": "Int64"})

    return zips.select("path", "content").mapInPandas(rows, "path string, member string, size long, error string")


def archive_csv(zips: DataFrame, pattern: str, columns: list[str]) -> DataFrame:
    """Text columns of the CSV members whose name fits a pattern, as (path, member, row, columns...), read in chunks."""
    import re

    def rows(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                z = zipfile.ZipFile(io.BytesIO(content))
                for name in sorted(z.namelist()):
                    if not re.search(pattern, name):
                        continue
                    n = 0
                    with z.open(name) as f:
                        for part in pd.read_csv(f, dtype=str, keep_default_na=False, chunksize=10_000, encoding="utf-8-sig", encoding_errors="replace"):
                            part = part.reindex(columns=columns)
                            part.insert(0, "row", range(n, n + len(part)))
                            part.insert(0, "member", name)
                            part.insert(0, "path", path)
                            n += len(part)
                            yield part

    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("member", T.StringType()), T.StructField("row", T.LongType()), *(T.StructField(c, T.StringType()) for c in columns)])
    return zips.select("path", "content").mapInPandas(rows, schema)


def decoded(content: Column) -> Column:
    """UTF-8 text, or what windows-1252 reads where that is not valid; its five bytes without a character are control characters."""
    text = content.cast("string")
    western = F.translate(F.decode(content, "ISO-8859-1"), "".join(chr(b) for b in CP1252), "".join(CP1252.values()))
    return F.when(F.is_valid_utf8(text), text).otherwise(western)


def jsonp(text: Column, schema: str) -> Column:
    """The argument of a callback, or plain JSON, parsed."""
    inner = F.regexp_extract(F.trim(text), r"(?s)^[A-Za-z_$][\w$.]*\(\s*(.*)\s*\)\s*;?$", 1)
    return F.from_json(F.when(inner != "", inner).otherwise(text), schema)


def html_tables(pages: DataFrame, html: str, row_pattern: str = r"(?is)<tr\b[^>]*>(.*?)</tr>", cell_pattern: str = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>") -> DataFrame:
    """pages with a row for each table row, as row_index and the array of its raw cells."""
    rows = pages.select("*", F.posexplode(F.regexp_extract_all(html, F.lit(row_pattern), F.lit(1))).alias("row_index", "_row"))
    return rows.withColumn("cells", F.regexp_extract_all("_row", F.lit(cell_pattern), F.lit(1))).drop("_row").where(F.size("cells") > 0)


def paged_offsets(spark: SparkSession, total: int, page: int) -> DataFrame:
    """(offset, size) of the requests that a paged service needs: a partition each, for readers that fetch."""
    return spark.range(0, max(total, 0), page).select(F.col("id").alias("offset"), F.least(F.lit(page), F.lit(total) - F.col("id")).alias("size"))


def id_batches(ids: DataFrame, key: str, size: int) -> DataFrame:
    """(batch, ids): sorted ids in batches; ids that are dense numbers are batched by value, so without a global sort."""
    return ids.groupBy(F.floor(F.col(key) / size).alias("batch")).agg(F.array_sort(F.collect_list(key)).alias("ids"))


def candidate_urls(spark: SparkSession, prefix: str, suffix: str, most: int, width: int = 2) -> DataFrame:
    """Numbered addresses, plain and zero-padded."""
    n = spark.range(1, most + 1)
    return n.select(F.explode(F.array_distinct(F.array(F.concat(F.lit(prefix), F.col("id").cast("string"), F.lit(suffix)), F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), width, "0"), F.lit(suffix))))).alias("url"))


def box(parts: str = "parts") -> Column:
    return geo.bbox(F.col(parts)).alias("box")


def checked_count(df: DataFrame, expected: int) -> DataFrame:
    """df, or an error where it has another number of rows."""
    got = df.agg(F.count("*").alias("n")).select(F.assert_true(F.col("n") == expected, F.concat(F.lit(f"expected {expected} rows, got "), F.col("n").cast("string"))).alias("ok"))
    return df.crossJoin(F.broadcast(got)).drop("ok")  # one row


def csv_of_years(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Exports landed as one folder a year (year=2020 and so on) under one schema, with the year as a column."""
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"')


def arcgis_pages(spark: SparkSession, path: str | list[str], attributes: str, geometry: bool = True) -> DataFrame:
    """The features of all landed pages ({features: [{attributes, geometry}]}), one file a page: their typed attributes and, if wanted, geometry. An {error} payload raises an error."""
    feature = f"struct<attributes:struct<{attributes}>" + (",geometry:struct<x:double,y:double,rings:array<array<array<double>>>>" if geometry else "") + ">"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<error:string,features:array<{feature}>>").alias("p"))
    ok = F.when(F.col("p.error").isNotNull(), F.raise_error(F.concat(F.lit("service error: "), F.col("p.error"))).cast("boolean")).otherwise(True)
    rows = raw.where(ok).select(F.explode("p.features").alias("f"))
    return rows.select("f.attributes.*", *(["f.geometry"] if geometry else []))


def overpass_elements(text: Column) -> Column:
    """Elements of a map query's answer, with their tags as a map."""
    return F.from_json(text, "elements array<struct<type:string,id:bigint,lat:double,lon:double,tags:map<string,string>>>")["elements"]


def wfs_request(layer: str, box: tuple[float, float, float, float], conditions: dict[str, str | None], most: int) -> dict[str, str]:
    """Parameters of one request: the box and the conditions (null: the field is) as one filter of the server."""
    parts = [f"BBOX(GEOMETRY,{','.join(map(str, box))})", *(f"{k} IS NULL" if v is None else f"{k}='{v}'" for k, v in conditions.items())]
    return {"service": "WFS", "request": "GetFeature", "typeNames": layer, "outputFormat": "application/json", "maxFeatures": str(most), "CQL_FILTER": " AND ".join(parts)}


def wfs_matches(columns: dict[str, Column], conditions: dict[str, str | None], box: tuple[float, float, float, float] | None = None, extent: Column | None = None) -> Column:
    """The same conditions on landed rows; with a box, only those whose extent (struct of xmin, ymin, xmax, ymax) meets it, borders included."""
    from functools import reduce

    kept = reduce(lambda a, b: a & b, (columns[k].isNull() if v is None else columns[k] == v for k, v in conditions.items()), F.lit(True))
    if box is None:
        return kept
    west, south, east, north = box
    return kept & (extent["xmin"] <= east) & (extent["xmax"] >= west) & (extent["ymin"] <= north) & (extent["ymax"] >= south)


def service_access(page: Column) -> Column:
    """struct(url, token) of the map service that a page of the property register names in its script; a page without either raises an error."""
    token, server = F.regexp_extract(page, r"gistoken\s*=\s*'([^']+)'", 1), F.regexp_extract(page, r"mapserverUrl\s*=\s*'([^']+)'", 1)
    found = F.when((token != "") & (server != ""), F.struct(F.concat(F.regexp_replace(server, "/+$", ""), F.lit("/0/query")).alias("url"), token.alias("token")))
    return F.coalesce(found, F.raise_error(F.lit("no token and server address on the page")).cast("struct<url:string,token:string>"))


def exported_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, rows) of CSV exports: lines that are not blank, without each file's header."""
    lines = spark.read.text(path).where(F.trim("value") != "").groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return lines.select("file", (F.col("n") - 1).alias("rows"))


def key_values(cells: Column) -> Column:
    """A map of snake-case labels to texts, of the rows of a two-column table (an array of arrays of cells); rows without both are left out and the first of equal labels stands."""
    clean = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))
    label = lambda r: F.regexp_replace(F.regexp_replace(F.lower(clean(r[0])), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    entries = F.transform(F.filter(cells, lambda r: F.size(r) >= 2), lambda r: F.struct(label(r).alias("key"), clean(r[1]).alias("value")))
    named = F.filter(entries, lambda e: e["key"] != "")
    firsts = F.filter(named, lambda e, i: ~F.exists(F.slice(named, 1, i), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(firsts)


def workbook_rows(files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the first sheet of workbooks (path, content), by the names in its first row: (path, row, columns... as text); a column that a sheet lacks is null. A workbook is a ZIP file of XML; sheets are read as streams."""
    import re
    import xml.etree.ElementTree as ET

    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

    def text_of(node) -> str:
        return "".join(t.text or "" for t in node.iter(f"{space}t"))

    def column_of(reference: str) -> int:
        n = 0
        for c in re.match("[A-Z]+", reference)[0]:
            n = 26 * n + ord(c) - 64
        return n - 1

    def cells(content: bytes):
        z = zipfile.ZipFile(io.BytesIO(content))
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as f:
                shared = [text_of(e) for _, e in ET.iterparse(f) if e.tag == f"{space}si"]
        first = min((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet[0-9]+\.xml", n)), key=lambda n: int(re.search("[0-9]+", n)[0]))
        with z.open(first) as f:
            for _, row in ET.iterparse(f):
                if row.tag == f"{space}row":
                    out = {}
                    for i, c in enumerate(row.iter(f"{space}c")):
                        value = c.find(f"{space}v")
                        kind = c.get("t")
                        text = text_of(c) if kind == "inlineStr" else None if value is None else shared[int(value.text)] if kind == "s" else value.text
                        out[column_of(c.get("r")) if c.get("r") else i] = text
                    yield out
                    row.clear()

    def rows(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                at, out, n = None, [], 0
                for row in cells(content):
                    if at is None:
                        names = {(v or "").strip(): k for k, v in row.items()}
                        at = [names.get(c) for c in columns]
                        continue
                    out.append((path, n, *(row.get(k) for k in at)))
                    n += 1
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=["path", "row", *columns])
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=["path", "row", *columns])

    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("row", T.LongType()), *(T.StructField(c, T.StringType()) for c in columns)])
    return files.select("path", "content").mapInPandas(rows, schema)


def probe_outcome(status: Column, length: Column, error: Column) -> Column:
    """struct(ok, status, content_length, error) of a probe of an address: a failure is a value, not an exception."""
    return F.struct((error.isNull() & status.between(200, 299)).alias("ok"), status.alias("status"), length.try_cast("long").alias("content_length"), error.alias("error"))
