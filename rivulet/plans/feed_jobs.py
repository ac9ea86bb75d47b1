"""Document feeds: JSON and XML entries, GeoJSON features, RSS items, the
union of two feeds, and the truncate-then-load of keyed features."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.plans import derived as DV
from rivulet.plans.registry import register
from rivulet.sinks.tables import truncate_load as truncate_load_op
from rivulet.sources import documents as DOC
from rivulet.session import scratch_path

_FEED_SQL = """
  SELECT CAST(event_id AS VARCHAR) AS id,
         CASE WHEN event_type = 'click' THEN NULL
              ELSE event_type || ' by user ' || CAST(user_id AS VARCHAR) END AS title,
         CASE WHEN event_type = 'purchase' THEN NULL
              ELSE 'http://feed.example/e/' || CAST(event_id AS VARCHAR) END AS href,
         coalesce(CASE WHEN event_type = 'click' THEN NULL
                       ELSE event_type || ' by user ' || CAST(user_id AS VARCHAR) END, 'null')
           || ' ---> ' ||
         coalesce(CASE WHEN event_type = 'purchase' THEN NULL
                       ELSE 'http://feed.example/e/' || CAST(event_id AS VARCHAR) END, '???')
           AS message,
         event_type, user_id
  FROM events WHERE event_type <> 'error'"""


@register("json_entry_parse", """
SELECT CAST(event_id AS VARCHAR) AS id, concat_ws(' ', event_type, props) AS tweet,
       (epoch_us(ts) // 1000) AS published
FROM events WHERE event_type <> 'error'""")
def json_entry_parse(spark, sf_dir):
    """JSON entries (some malformed, mixed zone suffixes) to (id, tweet, ms)."""
    return DOC.parse_json_entries(DV.json_entries(spark, sf_dir))


@register("xml_entry_parse", """
SELECT CAST(event_id AS VARCHAR) AS id, 'Status Posted' AS category,
       concat_ws(' ', event_type, props) AS content, (epoch_us(ts) // 1000) AS published
FROM events WHERE event_type NOT IN ('error', 'signup')""")
def xml_entry_parse(spark, sf_dir):
    """XML entries; deletion notices and malformed documents dropped."""
    return DOC.parse_xml_entries(DV.xml_entries(spark, sf_dir))


@register("xml_feed_events", f"SELECT id, title, href, message FROM ({_FEED_SQL})")
def xml_feed_events(spark, sf_dir):
    """Feed entries to log messages ``title ---> href``."""
    return DOC.xml_feed_events(DV.xml_entries(spark, sf_dir))


@register("xml_feed_documents", f"""
SELECT 'http://feed.example/after/' || CAST(u.last AS VARCHAR) AS refresh_url, id, message
FROM ({_FEED_SQL}) f JOIN (
  SELECT user_id, max(event_id) AS last FROM events WHERE event_type <> 'error'
  GROUP BY user_id) u USING (user_id)""")
def xml_feed_documents(spark, sf_dir):
    """Root documents with many entries each: one message per entry, with the cursor."""
    return DOC.xml_feed_documents(DV.xml_feed_docs(spark, sf_dir)).select(
        "refresh_url", "id", "message")


@register("feed_union", f"""
SELECT id, message FROM ({_FEED_SQL}) WHERE event_type = 'click'
UNION ALL
SELECT id, message FROM ({_FEED_SQL}) WHERE event_type <> 'click'""")
def feed_union(spark, sf_dir):
    """Two feeds (click entries, all other entries) into one consumer."""
    click = F.col("event_type") == "click"
    feeds = [DV.xml_entries(spark, sf_dir, where=w) for w in (click, ~click)]
    a, b = (DOC.xml_feed_events(f).select("id", "message") for f in feeds)
    return a.unionByName(b)


@register("rss_items", r"""
SELECT p_brand AS city,
       p_name || ' $' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || ' '
         || CAST(p_size AS VARCHAR) || ' sqft' AS title,
       'http://listings.example/' || CAST(p_partkey AS VARCHAR) AS link,
       p_brand AS groupBy
FROM part""")
def rss_items(spark, sf_dir):
    return DOC.rss_items(DV.rss_docs(spark, sf_dir))


@register("geojson_features", """
SELECT (epoch_us(ts) // 1000) AS time, value / 100 AS mag
FROM events WHERE event_type <> 'signup' AND value / 100 > 2.5""")
def geojson_features(spark, sf_dir):
    """Features with magnitude strictly above 2.5 (NULL magnitudes dropped)."""
    return DOC.geojson_features(DV.geojson_docs(spark, sf_dir))


@register("truncate_load", """
SELECT (epoch_us(ts) // 1000) AS time, arg_max(value / 100, event_id) AS mag
FROM events WHERE event_type <> 'signup' AND value / 100 > 2.5
GROUP BY (epoch_us(ts) // 1000)""")
def truncate_load(spark, sf_dir):
    """Truncate the keyed table, then load (time -> mag); a repeated time
    keeps the feature that came last in the feed."""
    feats = DOC.geojson_features(DV.geojson_docs(spark, sf_dir), keep=["event_id"])
    path = scratch_path(spark, "truncate_load")
    return truncate_load_op(feats, path, keys=["time"], value="mag", order="event_id")


@register("event_message", f"SELECT id, message FROM ({_FEED_SQL})")
def event_message(spark, sf_dir):
    """``title ---> href`` per feed entry (missing title ``null``, missing
    link ``???``)."""
    return DOC.xml_feed_events(DV.xml_entries(spark, sf_dir)).select("id", "message")


@register("geojson_file_scan", """
SELECT (epoch_us(ts) // 1000) AS time, value / 100 AS mag
FROM events WHERE event_type <> 'signup' AND value / 100 > 2.5""")
def geojson_file_scan(spark, sf_dir):
    """GeoJSON documents landed as files (one FeatureCollection per line)
    and read back with the JSON reader and an explicit schema."""
    path = scratch_path(spark, "geojson")
    DV.geojson_docs(spark, sf_dir).select(F.col("json").alias("value")).write.text(path)
    return DOC.read_geojson(spark, path, multi_line=False)
