"""Stand-in inputs derived from the driver tables.

The reference consumes message-bus topics, feeds and files that are not
shipped. These functions render equivalent inputs from the driver's tables,
inside Spark, so every query's work grows with the tables. Each rendering has
a column-level description that the SQL oracles use directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.records import epoch_millis
from rivulet.session import table

# Fixed values of the renderings (the oracles restate them):
#   quake events:   event_type 'error' with value > 150
#   messages:       every other event; text = event_type || ' ' || props
#   magnitude:      value / 100; 'signup' events carry no magnitude
#   malformed docs: 'error' events lose their last character
#   deletions:      'signup' entries are deletion notices
#   zone suffix:    'view' timestamps end in '+00:00', all others in 'Z'
QUAKE_TYPE = "error"
QUAKE_MIN_VALUE = 150.0
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def stock_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as daily-price lines (see :func:`render_stock_lines`)."""
    return render_stock_lines(table(spark, sf_dir, "lineitem"))


def render_stock_lines(li: DataFrame) -> DataFrame:
    """Lines ``flag, suppkey, date, discount, extendedprice, tax,
    extendedprice, quantity, 0`` -- so field 6 * field 7 = extendedprice *
    quantity. Works on a batch or a streaming ``lineitem``."""
    s = lambda c: F.col(c).cast("string")
    return li.select(F.concat_ws(
        ",", F.col("l_returnflag"), s("l_suppkey"),
        F.date_format("l_shipdate", "yyyy-MM-dd"), s("l_discount"),
        s("l_extendedprice"), s("l_tax"), s("l_extendedprice"), s("l_quantity"),
        F.lit("0")).alias("str"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as classified listings ``(city, title, link, groupBy)``:
    city = brand, title = ``name $<whole price> <size> sqft``, link = partkey."""
    p = table(spark, sf_dir, "part")
    title = F.concat(F.col("p_name"), F.lit(" $"),
                     F.floor("p_retailprice").cast("bigint").cast("string"),
                     F.lit(" "), F.col("p_size").cast("string"), F.lit(" sqft"))
    return p.select(F.col("p_brand").alias("city"), title.alias("title"),
                    F.col("p_partkey").cast("string").alias("link"),
                    F.col("p_brand").alias("groupBy"))


def event_ms(ts: str = "ts"):
    """Epoch milliseconds of a UTC wall-clock (timestamp_ntz) column."""
    return epoch_millis(ts)


def _quake():
    return (F.col("event_type") == QUAKE_TYPE) & (F.col("value") > QUAKE_MIN_VALUE)


def is_quake():
    """Is an event a quake? Never NULL: an event without a type or value is not."""
    return F.coalesce(_quake(), F.lit(False))


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, time)``: quake events with their epoch-ms time."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(_quake())  # pushed down to the scan
            .select("event_id", event_ms().alias("time")))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, tweet, published)``: all other events as short messages."""
    ev = table(spark, sf_dir, "events")
    return ev.where(~is_quake()).select(
        "event_id", F.concat_ws(" ", "event_type", "props").alias("tweet"),
        event_ms().alias("published"))


def _iso(ts: str = "ts"):
    suffix = F.when(F.col("event_type") == "view", F.lit("+00:00")).otherwise(F.lit("Z"))
    return F.concat(F.date_format(ts, ISO_FORMAT), suffix)


def _maybe_broken(doc):
    return F.when(F.col("event_type") == QUAKE_TYPE,
                  F.expr("substring(_doc, 1, length(_doc) - 1)")).otherwise(doc)


def json_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ActivityStreams JSON strings in column ``str``."""
    ev = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"),
        _iso().alias("postedTime"),
        F.struct(F.concat_ws(" ", "event_type", "props").alias("summary")).alias("object")))
    return ev.withColumn("_doc", doc).select(_maybe_broken(F.col("_doc")).alias("str"))


def _xml_text(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")),
                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def xml_entries(spark: SparkSession, sf_dir: str,
                where=None,
                keep: tuple = ()) -> DataFrame:
    """``events`` as ActivityStreams XML entries in column ``str``.

    'signup' entries are deletion notices; 'click' entries have no title and
    'purchase' entries no link; 'error' entries are cut short (malformed).
    """
    ev = table(spark, sf_dir, "events")
    if where is not None:
        ev = ev.where(where)
    et = F.col("event_type")
    deleted = et == "signup"
    title = F.when(et == "click", F.lit("")).otherwise(F.concat(
        F.lit("<title>"), _xml_text(F.concat_ws(" ", et, F.lit("by user"),
                                                F.col("user_id").cast("string"))),
        F.lit("</title>")))
    link = F.when(et == "purchase", F.lit("")).otherwise(F.concat(
        F.lit('<link rel="alternate" href="http://feed.example/e/'),
        F.col("event_id").cast("string"), F.lit('"/>')))
    category = F.when(deleted, F.lit('<category term="NoteDeleted" label="Note Deleted"/>')) \
        .otherwise(F.lit('<category term="StatusPosted" label="Status Posted"/>'))
    verb = F.when(deleted, F.lit("http://activitystrea.ms/schema/1.0/delete")) \
        .otherwise(F.lit("http://activitystrea.ms/schema/1.0/post"))
    doc = F.concat(
        F.lit("<entry><id>"), F.col("event_id").cast("string"), F.lit("</id>"),
        F.lit("<published>"), _iso(), F.lit("</published>"), title,
        F.lit("<verb>"), verb, F.lit("</verb>"), category, link,
        F.lit('<object><content type="html">'),
        _xml_text(F.concat_ws(" ", et, "props")), F.lit("</content></object></entry>"))
    return ev.withColumn("_doc", doc).select(
        _maybe_broken(F.col("_doc")).alias("str"), "event_type", *keep)


#: Entries of a feed document, about.
PAGE = 1000


def xml_feed_docs(spark: SparkSession, sf_dir: str, page: int = PAGE) -> DataFrame:
    """Feed documents per user (column ``str``): a root element with about ``page``
    of the user's entries (all, if there are no more) and the address of the next
    request, which is the user's and the same in all. A document never grows with
    its user: entries are dealt to as many as their number asks for, by event_id.
    'error' entries, which are malformed, would spoil the whole document and are no
    part of it."""
    whole = xml_entries(spark, sf_dir, where=F.col("event_type") != QUAKE_TYPE,
                        keep=("user_id", "event_id"))
    users = table(spark, sf_dir, "events").where(F.col("event_type") != QUAKE_TYPE) \
        .groupBy("user_id").agg(F.max("event_id").alias("last"),
                                F.ceil(F.count(F.lit(1)) / F.lit(page)).alias("pages"))
    dealt = whole.join(users, "user_id").withColumn(
        "page", F.pmod(F.xxhash64("event_id"), F.col("pages")))
    # By user and page at once: an aggregate after the join would keep a user in one task.
    docs = dealt.repartition("user_id", "page").groupBy("user_id", "page").agg(
        F.concat_ws("", F.collect_list("str")).alias("body"), F.max("last").alias("last"))
    return docs.select(F.concat(
        F.lit('<results refreshURL="http://feed.example/after/'), F.col("last").cast("string"),
        F.lit('">'), F.col("body"), F.lit("</results>")).alias("str"))


def geojson_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-feature GeoJSON FeatureCollection per event (column
    ``json``): time = epoch ms, mag = value / 100, NULL for 'signup'."""
    ev = table(spark, sf_dir, "events")
    mag = F.when(F.col("event_type") == "signup", F.lit(None).cast("double")) \
        .otherwise(F.col("value") / F.lit(100.0))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(mag.alias("mag"), event_ms().alias("time"),
                 F.col("event_type").alias("place")).alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("value"), F.col("user_id").cast("double")).alias("coordinates"))
        .alias("geometry"),
        F.col("event_id").cast("string").alias("id"))
    doc = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                             F.array(feature).alias("features")),
                    {"ignoreNullFields": "false"})
    return ev.select("event_id", doc.alias("json"))


def rss_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One RSS document per listing, with the city alongside (``city, xml``)."""
    ls = listings(spark, sf_dir)
    doc = F.concat(F.lit("<rss><channel><item><title>"), _xml_text("title"),
                   F.lit("</title><link>http://listings.example/"), F.col("link"),
                   F.lit("</link></item></channel></rss>"))
    return ls.select("city", doc.alias("xml"))


def in_arrival_order(df: DataFrame, ts: str, key: str, batches: int,
                     jitter_s: int) -> tuple[DataFrame, str]:
    """``df`` with the ``batch`` it arrives in, and a ``weight`` of 1.

    A row arrives up to ``jitter_s`` seconds after its time (by a hash of its key);
    the range of arrivals is cut into ``batches``. Batch ``batches`` holds one
    heartbeat of weight 0, a day after everything. Also returns the lateness that
    the batches keep: the jitter and the span of a batch."""
    (out,), delay = sides_in_arrival_order([df], ts, key, batches, jitter_s)
    return out, delay


def sides_in_arrival_order(sides: list[DataFrame], ts: str, key: str, batches: int,
                           jitter_s: int) -> tuple[list[DataFrame], str]:
    """:func:`in_arrival_order` of several tables on one clock."""
    seconds = F.floor(epoch_millis(ts) / 1000)
    arrival = seconds + F.pmod(F.xxhash64(key), F.lit(jitter_s))
    bounds = [s.agg(F.min(arrival).alias("lo"), F.max(arrival).alias("hi")).first() for s in sides]
    known = [b for b in bounds if b["lo"] is not None]
    lo = min((b["lo"] for b in known), default=0)
    hi = max((b["hi"] for b in known), default=0)
    span = (hi - lo) // batches + 1
    beat = F.timestamp_add("SECOND", F.lit(int(hi) + 86_400 + span + jitter_s),
                           F.lit("1970-01-01").cast("timestamp_ntz"))
    out = []
    for side in sides:
        rows = side.where(F.col(ts).isNotNull()).withColumns({
            "weight": F.lit(1).cast("bigint"), "batch": F.floor((arrival - lo) / span).cast("int")})
        last = side.sparkSession.range(1).select(
            *[(beat if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name)
              for f in side.schema.fields],
            F.lit(0).cast("bigint").alias("weight"), F.lit(batches).alias("batch"))
        out.append(rows.unionByName(last))
    return out, f"{int(span) + jitter_s} seconds"
