"""Parsers for JSON, XML and GeoJSON documents carried in string columns.

``from_json`` / ``from_xml`` run inside the JVM with an explicit schema and
the PERMISSIVE mode: a malformed document yields a struct of NULLs instead of
failing the task, so bad rows are dropped by a filter on a required field.
(``xpath_*`` would throw on malformed input.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.records import keep_parsed

# Fixed value: the category label of a deletion notice (compared ignoring
# case) and the verb suffix that marks a deletion.
DELETED_LABEL = "note deleted"
DELETE_VERB_SUFFIX = "/delete"

JSON_ENTRY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("postedTime", T.StringType()),
    T.StructField("object", T.StructType([T.StructField("summary", T.StringType())])),
])

XML_ENTRY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("verb", T.StringType()),
    T.StructField("category", T.ArrayType(T.StructType([
        T.StructField("_term", T.StringType()),
        T.StructField("_label", T.StringType())]))),
    T.StructField("link", T.ArrayType(T.StructType([
        T.StructField("_rel", T.StringType()),
        T.StructField("_href", T.StringType())]))),
    T.StructField("object", T.StructType([T.StructField("content", T.StringType())])),
])

# A feed's root document: its entries, and the address of the next request.
XML_FEED_SCHEMA = T.StructType([
    T.StructField("_refreshURL", T.StringType()),
    T.StructField("entry", T.ArrayType(XML_ENTRY_SCHEMA)),
])

RSS_CHANNEL_SCHEMA = T.StructType([
    T.StructField("channel", T.StructType([
        T.StructField("item", T.ArrayType(T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("link", T.StringType())])))]))])

GEOJSON_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("properties", T.StructType([
            T.StructField("mag", T.DoubleType()),
            T.StructField("time", T.LongType()),
            T.StructField("place", T.StringType())])),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.ArrayType(T.DoubleType()))]))]))),
])


def to_epoch_millis(text: Column) -> Column:
    """ISO-8601 text (``Z`` or ``+hh:mm``, with or without a fraction) to
    epoch milliseconds; NULL when it does not parse."""
    return F.unix_millis(text.try_cast("timestamp"))


def parse_json_entries(df: DataFrame, col: str = "str") -> DataFrame:
    """``(id, tweet, published)``: id, ``object.summary`` and ``postedTime``
    as epoch ms. Malformed documents and rows missing any of them are dropped."""
    e = F.from_json(F.col(col), JSON_ENTRY_SCHEMA, {"mode": "PERMISSIVE"})
    return keep_parsed(df.select(e.alias("e")), [
        F.col("e.id").alias("id"),
        F.col("e.object.summary").alias("tweet"),
        to_epoch_millis(F.col("e.postedTime")).alias("published"),
    ], ["id", "tweet", "published"])


def parse_xml_entries(df: DataFrame, col: str = "str") -> DataFrame:
    """``(id, category, content, published)`` from ActivityStreams entries.

    Deletion notices (category label or verb) and documents that do not
    parse are dropped; ``published`` is epoch ms (UTC).
    """
    e = F.from_xml(F.col(col), XML_ENTRY_SCHEMA, {"mode": "PERMISSIVE"})
    labels = F.transform(F.coalesce(F.col("e.category"), F.array()),
                         lambda c: F.lower(c["_label"]))
    # array_contains is NULL when no label matches and one label is missing
    deleted = (F.coalesce(F.array_contains(labels, DELETED_LABEL), F.lit(False))
               | F.coalesce(F.col("e.verb").endswith(DELETE_VERB_SUFFIX), F.lit(False)))
    kept = F.when(~deleted, F.col("e.id"))
    return keep_parsed(df.select(e.alias("e")), [
        kept.alias("id"),
        F.get(F.col("e.category"), 0)["_label"].alias("category"),
        F.col("e.object.content").alias("content"),
        to_epoch_millis(F.col("e.published")).alias("published"),
    ], ["id", "published"])


def xml_feed_documents(df: DataFrame, col: str = "str") -> DataFrame:
    """Root documents of a feed as ``(refresh_url, id, title, href, message)``, one
    row per entry, with the cursor of the request that would follow. A document
    that does not parse gives no rows."""
    from rivulet.functions.text import event_message

    doc = F.from_xml(F.col(col), XML_FEED_SCHEMA, {"mode": "PERMISSIVE"})
    entries = df.select(doc.alias("d")).select(
        F.col("d._refreshURL").alias("refresh_url"), F.explode("d.entry").alias("e"))
    href = F.get(F.col("e.link"), 0)["_href"]
    return entries.select("refresh_url", F.col("e.id").alias("id"), F.col("e.title").alias("title"),
                          href.alias("href"), event_message(F.col("e.title"), href)
                          .alias("message"))


def xml_feed_events(df: DataFrame, col: str = "str") -> DataFrame:
    """Feed entries as ``(id, title, href, message)`` where message is
    ``title ---> first link href``; entries that do not parse are dropped."""
    from rivulet.functions.text import event_message

    e = F.from_xml(F.col(col), XML_ENTRY_SCHEMA, {"mode": "PERMISSIVE"})
    href = F.get(F.col("e.link"), 0)["_href"]
    return keep_parsed(df.select(e.alias("e")), [
        F.col("e.id").alias("id"), F.col("e.title").alias("title"), href.alias("href"),
        event_message(F.col("e.title"), href).alias("message"),
    ], ["id"])


def rss_items(df: DataFrame, col: str = "xml", city: str = "city") -> DataFrame:
    """RSS documents to ``(city, title, link, groupBy)`` rows, one per item."""
    doc = F.from_xml(F.col(col), RSS_CHANNEL_SCHEMA, {"mode": "PERMISSIVE"})
    items = df.select(F.col(city).alias("city"), doc.alias("_d")).select(
        "city", F.explode(F.col("_d.channel.item")).alias("item"))
    return items.select("city", F.col("item.title").alias("title"),
                        F.col("item.link").alias("link"),
                        F.col("city").alias("groupBy"))


def geojson_features(df: DataFrame, col: str = "json",
                     min_magnitude: float | None = 2.5, keep=()) -> DataFrame:
    """``(keep..., time, mag)`` per feature; with ``min_magnitude`` only
    features with a magnitude strictly above it (a NULL magnitude never
    passes)."""
    d = F.from_json(F.col(col), GEOJSON_SCHEMA, {"mode": "PERMISSIVE"})
    f = df.select(*keep, F.explode(d["features"]).alias("f")).select(
        *keep, F.col("f.properties.time").alias("time"),
        F.col("f.properties.mag").alias("mag"))
    if min_magnitude is not None:
        f = f.where(F.col("mag") > F.lit(float(min_magnitude)))
    return f


def read_geojson(spark, path: str, min_magnitude: float | None = 2.5,
                 multi_line: bool = True) -> DataFrame:
    """GeoJSON files to ``(time, mag)``: one FeatureCollection per file
    (``multi_line``, as published by the feed) or one per line."""
    raw = (spark.read.schema(GEOJSON_SCHEMA)
           .option("multiLine", str(multi_line).lower()).json(path))
    f = raw.select(F.explode("features").alias("f")).select(
        F.col("f.properties.time").alias("time"), F.col("f.properties.mag").alias("mag"))
    if min_magnitude is not None:
        f = f.where(F.col("mag") > F.lit(float(min_magnitude)))
    return f
