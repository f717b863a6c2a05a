"""Readers for landed API responses.

The reference fetches JSON over HTTP per request. Here responses are files
in a landing folder, one document per line, so the read splits across tasks.
Each reader looks at every line once and gives each a verdict: a row of the
result, or a row of the rejects with the reason, the line or value and its
file. Nothing is dropped silently: entries in = rows out + rejects.
Writers that produce the same layout from DataFrames are included for tests
and replays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.geo import multipolygon_coords, polygon_to_multipolygon
from ..functions.timeutil import parse_iso_utc

S, D = T.StringType(), T.DoubleType()
CORRUPT = "_corrupt_record"


def _doc(*fields) -> T.StructType:
    return T.StructType([*(T.StructField(n, t) for n, t in fields), T.StructField(CORRUPT, S)])


SOURCE = T.StructType([T.StructField(n, S) for n in (
    "id", "dwd_station_id", "wmo_station_id", "station_name", "observation_type", "lat", "lon", "height",
    "first_record", "last_record", "distance")])
STATION_DOC = _doc(("sources", T.ArrayType(SOURCE)))

# Values are read as text and bound to the table types afterwards (H13):
# numbers sent as numbers or as text ("72.0") both load, a bad value becomes
# null; nested values such as ``fallback_source_ids`` arrive as JSON text.
NUMBERS = ("source_id", "precipitation", "pressure_msl", "sunshine", "temperature",
           "wind_direction", "wind_speed", "cloud_cover", "dew_point", "relative_humidity", "visibility",
           "wind_gust_direction", "wind_gust_speed", "precipitation_probability",
           "precipitation_probability_6h", "solar")
WEATHER_FIELDS = ("timestamp", *NUMBERS, "condition", "icon", "fallback_source_ids")
# ``issued`` is optional: when the answer was issued. Without it the landed
# file's time stands in.
WEATHER_DOC = _doc(("station_id", S), ("issued", S), ("weather", T.ArrayType(T.StructType([T.StructField(n, S) for n in WEATHER_FIELDS]))))

FEATURE = T.StructType([
    T.StructField("properties", T.StructType([T.StructField("postcode", S)])),
    T.StructField("geometry", T.StructType([T.StructField("type", S), T.StructField("coordinates", S)])),
])

#: What a reject looks like: why, what was read, where from.
REJECTS = "reason string, value string, file string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``_file`` and ``_issued`` (the file's time) of each line that is not blank."""
    return with_origin(spark.read.text(path))


def with_origin(text: DataFrame) -> DataFrame:
    return (text.select("value", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_issued"))
                .filter(F.trim("value") != ""))


def _parsed(text: DataFrame, schema: T.StructType) -> DataFrame:
    return text.withColumn("_d", F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT}))


def _broken() -> Column:
    return F.col("_d").isNull() | F.col(f"_d.{CORRUPT}").isNotNull()


def _rejects(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), F.col("_shown").alias("value"), F.col("_file").alias("file"))


# ---------------------------------------------------------------- stations --

def judged_stations(text: DataFrame) -> DataFrame:
    docs = _parsed(text, STATION_DOC)
    one = docs.withColumn("_broken", _broken()).withColumn(
        "_s", F.explode_outer(F.when(~F.col("_broken"), F.col("_d.sources"))))
    listed = F.col("_broken") | F.col("_s").isNotNull() | F.col("_d.sources").isNull()
    reason = (F.when(F.col("_broken"), F.lit("malformed document"))
              .when(F.col("_d.sources").isNull(), F.lit("no sources"))
              .when(F.col("_s.id").isNull(), F.lit("no station id")))
    # an empty list gives no row and is no reject
    return one.filter(listed | (F.size("_d.sources") > 0)).select(
        "_s", "_file", reason.alias("_reason"),
        F.when(F.col("_s").isNull(), F.col("value")).otherwise(F.to_json("_s")).alias("_shown"))


def read_stations(spark: SparkSession, path: str, load_time=None) -> tuple[DataFrame, DataFrame]:
    """A4: ``{"sources": [...]}`` documents -> raw station rows, and the rejects."""
    judged = judged_stations(lines(spark, path))
    rows = judged.filter(F.col("_reason").isNull()).select("_s.*")
    rows = (rows.withColumn("first_record", parse_iso_utc("first_record"))
                .withColumn("last_record", parse_iso_utc("last_record")))
    return (schemas.bind_by_name(rows, schemas.STATIONS, load_time, "created_at"), _rejects(judged))


def read_stations_json(spark: SparkSession, path: str) -> DataFrame:
    return read_stations(spark, path)[0]


# ----------------------------------------------------------------- weather --

def judged_weather(text: DataFrame) -> DataFrame:
    """One row for each entry of each document, with ``_reason`` where it cannot be loaded.

    Which documents give rows is settled by the list that is exploded, and its elements carry
    what is needed of their document: a condition on the document itself, also one that a join
    asks for, would be pushed down to its text, which would be parsed again for each.
    """
    docs = _parsed(text, WEATHER_DOC).withColumn("_broken", _broken())

    def entry(w: Column) -> Column:
        return F.struct("_d.station_id", "_d.issued", F.col("_broken").alias("broken"), w.alias("w"))

    none = F.lit(None).cast(WEATHER_DOC["weather"].dataType.elementType)
    entries = F.when(F.col("_broken"), F.array(entry(none))).otherwise(F.transform("_d.weather", entry))
    one = docs.select("value", "_file", "_issued", F.explode(entries).alias("_e")).select(
        "value", "_file", "_issued", F.col("_e.station_id").alias("_id"), F.col("_e.issued").alias("_said"),
        F.col("_e.broken").alias("_broken"), F.col("_e.w").alias("_w"))
    at = parse_iso_utc("_w.timestamp")
    reason = (F.when(F.col("_broken"), F.lit("malformed document"))
              .when(F.col("_id").isNull(), F.lit("no station id"))
              .when(F.col("_w").isNull(), F.lit("empty entry"))
              .when(F.col("_w.timestamp").isNull(), F.lit("no timestamp"))
              .when(at.isNull(), F.lit("bad timestamp")))
    # a null or empty list gives no row and is no reject
    return one.select(
        F.col("_id").alias("station_id"), "_w", at.alias("_at"), "_file",
        F.coalesce(parse_iso_utc("_said"), "_issued").alias("_issued"), reason.alias("_reason"),
        F.when(F.col("_w").isNull(), F.col("value")).otherwise(F.to_json("_w")).alias("_shown"))


def weather_rows(judged: DataFrame, schema: T.StructType = schemas.OBSERVATIONS, load_time=None,
                 keep: tuple = ()) -> DataFrame:
    """Good entries as rows of ``schema`` (forecasts: ``timestamp`` is
    ``forecast_timestamp``, B2). ``keep`` names columns of ``judged`` to carry."""
    return _bound_weather(judged.filter(F.col("_reason").isNull()), schema, load_time, keep)


#: What a reject is made of.
VERDICT = ("_reason", "_shown", "_file")


def weather_verdicts(judged: DataFrame, schema: T.StructType = schemas.OBSERVATIONS, load_time=None,
                     keep: tuple = ()) -> DataFrame:
    """All entries, each either bound as in ``weather_rows`` or with a reason and what is shown of it (null for good ones);
    so both can be written in one pass over the text and without the parsed documents."""
    bad = F.col("_reason").isNotNull()
    return _bound_weather(judged.withColumns({c: F.when(bad, F.col(c)) for c in ("_shown", "_file")}), schema, load_time, (*keep, *VERDICT))


def _bound_weather(good: DataFrame, schema: T.StructType, load_time, keep: tuple) -> DataFrame:
    ts = "timestamp" if "timestamp" in schema.fieldNames() else "forecast_timestamp"
    # JSON numbers are numbers to the reference, so they round as such
    fields = [F.col("_at").alias(ts), *(F.col(f"_w.{n}").try_cast("double").alias(n) for n in NUMBERS),
              *(F.col(f"_w.{n}").alias(n) for n in ("condition", "icon", "fallback_source_ids"))]
    return schemas.bind_by_name(good.select("station_id", *fields, *keep), schema, load_time, "ingested_at", keep)


def read_weather(spark: SparkSession, path: str, schema: T.StructType = schemas.OBSERVATIONS,
                 load_time=None) -> tuple[DataFrame, DataFrame]:
    """A5: ``{"station_id": .., "weather": [...]}`` documents -> rows, and the rejects.

    An empty or null list yields no rows; timestamps with offsets become UTC.
    """
    judged = judged_weather(lines(spark, path))
    return weather_rows(judged, schema, load_time), _rejects(judged)


def read_weather_json(spark: SparkSession, path: str, schema: T.StructType = schemas.OBSERVATIONS) -> DataFrame:
    return read_weather(spark, path, schema)[0]


# ------------------------------------------------------------------- areas --

def _geometry(g: Column) -> Column:
    """H8: GeoJSON Polygon / MultiPolygon -> multipolygon; other types -> null."""
    t, coords = g["type"], g["coordinates"]
    poly = F.from_json(coords, "array<array<array<double>>>")
    multi = F.from_json(coords, "array<array<array<array<double>>>>")
    return (F.when(t == "Polygon", polygon_to_multipolygon(poly))
             .when(t == "MultiPolygon", multipolygon_coords(multi)))


def _whole(shape: Column) -> Column:
    """A shape whose every point has both coordinates, with at least one ring."""
    points = F.flatten(F.flatten(shape))
    return (F.size(points) > 0) & F.forall(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull())


#: What stands once in every feature of a collection (``"type": "Feature"``), so files are cut there.
FEATURE_MARK = '"Feature"'


def collection_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Collection documents as the text between feature marks: ``value``, ``_file``.

    The mark is the record separator of the read, so a document of any size and
    on any number of lines is split over tasks; no record is longer than two features.
    """
    return with_origin(spark.read.option("lineSep", FEATURE_MARK).text(path))


def collection_files(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path`` that hold collection documents: ``_file``."""
    return collection_pieces(spark, path).filter(F.col("value").contains('"FeatureCollection"')).select("_file").distinct()


def collection_features(pieces: DataFrame) -> DataFrame:
    """One row per feature: its text in ``value``, repaired where the mark cut it.

    A piece begins inside the feature whose mark stands before it. If members
    follow, the piece holds them up to the feature's end, and what stands after is
    left to the next one. If the feature closes at once, its members stood before its
    mark, so the piece holds those of the feature that follows. ``_lost``
    is true where a feature has members on both sides in a way that one piece cannot hold.
    """
    inside = F.col("value").rlike(r"(?s)^\s*[,}]")
    closes = F.col("value").rlike(r"(?s)^\s*\}")
    ahead = F.when(inside, F.regexp_extract("value", r"(?s)^\s*\}\s*,\s*(\{.*)$", 1)) \
             .otherwise(F.regexp_extract("value", r"(?s)\"features\"\s*:\s*\[\s*(\{.*)$", 1))
    bare = ahead.rlike(r"(?s)^\{[^{}]*$")  # only its type, or plain members such as an id, before the mark
    whole = F.when(inside & ~closes, F.concat(F.lit('{"type":' + FEATURE_MARK), "value")) \
             .when((ahead != "") & ~bare, F.concat(ahead, F.lit(FEATURE_MARK + "}")))
    ends = F.col("value").rlike(r"(?s)(,\s*\{[^{}]*|\]\s*(,.*)?\}\s*)$")
    lost = inside & ~closes & ~ends & F.col("value").rlike(r'"type"\s*:\s*$')
    made = F.array_compact(F.array(F.when(whole.isNotNull(), F.struct(whole.alias("text"), F.lit(False).alias("lost"))),
                                   F.when(lost, F.struct(F.col("value").alias("text"), F.lit(True).alias("lost")))))
    return pieces.select(F.explode(made).alias("_m"), "_file").select(
        F.col("_m.text").alias("value"), "_file", F.col("_m.lost").alias("_lost"))


def judged_areas(text: DataFrame) -> DataFrame:
    """One row for each feature in ``value``, with ``_reason`` where it is no area."""
    one = _parsed(text, T.StructType([*FEATURE.fields, T.StructField(CORRUPT, S)])) \
        .withColumn("_broken", _broken()).withColumn("_f", F.struct("_d.properties", "_d.geometry"))
    one = one.withColumn("_shape", F.when(~F.col("_broken"), _geometry(F.col("_f.geometry"))))
    kind = F.col("_f.geometry.type")
    lost = F.col("_lost") if "_lost" in text.columns else F.lit(False)
    reason = (F.when(lost, F.lit("a feature with members on both sides of its type"))
              .when(F.col("_broken"), F.lit("malformed document"))
              .when(F.col("_f.geometry").isNull() | kind.isNull(), F.lit("no geometry"))
              .when(~kind.isin("Polygon", "MultiPolygon"), F.lit("not a polygon"))
              .when(F.col("_shape").isNull() | ~F.coalesce(_whole(F.col("_shape")), F.lit(False)), F.lit("bad coordinates"))
              .when(F.col("_f.properties.postcode").isNull(), F.lit("no postcode")))
    return one.select(F.col("_f.properties.postcode").alias("plz"), F.col("_shape").alias("geometry"), "_file",
                      reason.alias("_reason"), F.col("value").alias("_shown"))


LAYOUTS = ("lines", "collection", "any")


def area_features(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """The landed features, one a row. ``any``: each file by what it holds, told by one scan."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout is one of {LAYOUTS}")
    if layout == "lines":
        return lines(spark, path)
    if layout == "collection":
        return collection_features(collection_pieces(spark, path))
    documents = collection_files(spark, path)
    return (lines(spark, path).join(documents, "_file", "left_anti").select("value", "_file", F.lit(False).alias("_lost"))
            .unionByName(collection_features(collection_pieces(spark, path).join(documents, "_file", "left_semi"))))


def read_geojson(spark: SparkSession, path: str, prefixes=None, layout: str = "lines",
                 load_time=None) -> tuple[DataFrame, DataFrame]:
    """A6 + A7 + B8: GeoJSON features -> area rows with a shape, and the rejects.

    ``layout``: ``lines`` (one feature per line), ``collection`` (whole
    FeatureCollection documents, split over tasks) or ``any`` (files of both).
    Features outside ``prefixes`` are neither rows nor rejects.
    """
    judged = judged_areas(area_features(spark, path, layout))
    rows = judged.filter(F.col("_reason").isNull()).select("plz", "geometry", F.col("plz").alias("name"))
    if prefixes:
        from ..plans.products import prefix_filter
        rows = rows.filter(prefix_filter("plz", prefixes))
    return schemas.bind_by_name(rows, schemas.AREAS, load_time, "created_at"), _rejects(judged)


def read_geojson_areas(spark: SparkSession, path: str, prefixes=None, layout: str = "lines") -> DataFrame:
    return read_geojson(spark, path, prefixes, layout)[0]


# ----------------------------------------------------------------- writers --

def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def feature_json(type_first: bool = True) -> Column:
    """An area row as a GeoJSON feature (MultiPolygon geometry); its type stands first or last."""
    coords = F.transform("geometry", lambda part: F.transform(part, lambda ring: F.transform(
        ring, lambda p: F.array(p["x"], p["y"]))))
    members = [F.lit("Feature").alias("type"),
               F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates")).alias("geometry"),
               F.struct(F.col("plz").alias("postcode")).alias("properties")]
    return F.to_json(F.struct(*(members if type_first else members[1:] + members[:1])))


def land_areas_geojson(areas: DataFrame, path: str) -> None:
    """Areas -> one GeoJSON feature per line (MultiPolygon geometry)."""
    areas.select(feature_json().alias("value")).write.mode("overwrite").text(path)


def land_areas_collection(areas: DataFrame, path: str, type_first: bool = True, separator: str = ",") -> None:
    """Areas -> one FeatureCollection document, and so one file, written by one task."""
    head = F.when(F.col("_k") == 0, F.lit('{"type":"FeatureCollection","features":[')).otherwise(F.lit(separator))
    rows = areas.select("plz", feature_json(type_first).alias("_t")).coalesce(1).sortWithinPartitions("plz")
    rows = rows.withColumn("_k", F.monotonically_increasing_id()).select(F.concat(head, "_t").alias("value"))
    close = areas.sparkSession.range(1).select(F.lit("]}").alias("value"))
    rows.unionByName(close).coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)


def land_stations_json(stations: DataFrame, path: str) -> None:
    """Station rows -> ``{"sources": [station]}`` documents, one per row."""
    cols = [c for c in SOURCE.fieldNames() if c in stations.columns]
    item = F.struct(*[(_iso(F.col(c)) if c.endswith("_record") else F.col(c)).alias(c) for c in cols])
    stations.select(F.to_json(F.struct(F.array(item).alias("sources"))).alias("value")).write.mode("overwrite").text(path)


def land_weather_json(rows: DataFrame, path: str, ts: str = "timestamp", mode: str = "overwrite") -> None:
    """Rows -> ``{"station_id", "weather": [row]}`` documents, one per row.

    The reader accepts lists of any length; emitting one document per row
    needs no grouping, so no key (however hot) is gathered into one task.
    """
    cols = [c for c in rows.columns if c not in ("station_id", "wmo_station_id", "ingested_at", "issued", ts)]
    item = F.struct(_iso(F.col(ts)).alias("timestamp"), *[F.col(c) for c in cols])
    issued = [_iso(F.col("issued")).alias("issued")] if "issued" in rows.columns else []
    doc = F.struct(F.col("station_id"), *issued, F.array(item).alias("weather"))
    rows.select(F.to_json(doc).alias("value")).write.mode(mode).text(path)
