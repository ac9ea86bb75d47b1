"""Queries over the TPC-H-like tables and ``events``: scans, parsers, joins,
keyed aggregates, rankings and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.functions import records as RC
from rivulet.functions import text as TX
from rivulet.operators import aggregates as AG
from rivulet.operators import joins as JN
from rivulet.operators import topk as TK
from rivulet.operators.reach import reach as reach_op
from rivulet.operators.reach import reach_links
from rivulet.plans.derived import listings, stock_lines
from rivulet.plans.registry import register
from rivulet.sinks import reports as RP
from rivulet.session import scratch_path, table
from rivulet.sources import files as FS

# ---------------------------------------------------------------- sources

def _line_columns(df):
    """Every column as the text a delimited file holds."""
    return [F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if "timestamp" in f.dataType.simpleString()
            else F.col(f.name).cast("string") for f in df.schema.fields]


_CSV_FIELDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_CSV_SQL = [f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c == "l_shipdate" else f"CAST({c} AS VARCHAR)"
            for c in _CSV_FIELDS]
# Malformed records: a surplus field behind one in ten first lines, and of one in
# eleven others the last two fields missing.
_SURPLUS, _SHORT = "l_linenumber = 1 AND l_orderkey % 10 = 3", "l_linenumber = 2 AND l_orderkey % 11 = 5"


def _write_lineitem_csv(spark, sf_dir, header):
    """lineitem, all columns, as ';'-separated text; without a header also some
    malformed records."""
    path = scratch_path(spark, "csv_scan")
    li = table(spark, sf_dir, "lineitem").select(*_CSV_FIELDS)
    cells = _line_columns(li)
    if header:
        (li.select(*[c.alias(n) for c, n in zip(cells, _CSV_FIELDS, strict=True)])
         .write.option("sep", ";").option("header", "true").csv(path))
    else:
        line = (F.when(F.expr(_SURPLUS), F.concat_ws(";", *cells, F.lit("surplus")))
                .when(F.expr(_SHORT), F.concat_ws(";", *cells[:-2])).otherwise(F.concat_ws(";", *cells)))
        li.select(line).write.text(path)
    return path


@register("csv_scan", f"""
SELECT {", ".join(f"{c} AS field_{i}" for i, c in enumerate(_CSV_SQL))}
FROM lineitem WHERE NOT ({_SURPLUS}) AND NOT ({_SHORT})""")
def csv_scan(spark, sf_dir):
    """lineitem as ';'-separated text without header, scanned back; records of the
    wrong width are not rows."""
    path = _write_lineitem_csv(spark, sf_dir, False)
    return FS.csv_scan(spark, path, ";", fields=len(_CSV_FIELDS))


@register("csv_rejects", f"""
SELECT array_to_string([{", ".join(_CSV_SQL)}], ';') || ';surplus' AS line,
       CAST(l_orderkey AS VARCHAR) AS first FROM lineitem WHERE {_SURPLUS}
UNION ALL
SELECT array_to_string([{", ".join(_CSV_SQL[:-2])}], ';'), CAST(l_orderkey AS VARCHAR)
FROM lineitem WHERE {_SHORT}""")
def csv_rejects(spark, sf_dir):
    """The records of the wrong width, from the place the scan puts them."""
    path, rejects = _write_lineitem_csv(spark, sf_dir, False), scratch_path(spark, "csv_rejects")
    FS.csv_scan(spark, path, ";", fields=len(_CSV_FIELDS), rejects=rejects)
    return spark.read.parquet(rejects).select("line", F.col("fields")[0].alias("first"))


@register("csv_scan_header", f"""
SELECT {", ".join(f"{c} AS {n}" for c, n in zip(_CSV_SQL, _CSV_FIELDS, strict=True))}
FROM lineitem""")
def csv_scan_header(spark, sf_dir):
    """Same columns with a header row: names come from it, the row is skipped."""
    return FS.csv_scan(spark, _write_lineitem_csv(spark, sf_dir, True), sep=";", header=True)


@register("lookup_last_wins", """
SELECT CAST(o_custkey AS VARCHAR) AS key, arg_max(o_orderpriority, o_orderkey) AS value
FROM orders GROUP BY o_custkey""")
def lookup_last_wins(spark, sf_dir):
    """orders as a tab-separated lookup file (custkey -> priority, in
    orderkey order); loading it keeps the last line of each key."""
    path = scratch_path(spark, "lookup")
    (table(spark, sf_dir, "orders").orderBy("o_orderkey")
     .select(F.concat_ws("\t", F.col("o_custkey").cast("string"), "o_orderpriority"))
     .write.text(path))
    return FS.load_lookup(spark, path)


# ---------------------------------------------------------------- stock lines

@register("stock_extract", """
SELECT l_returnflag AS exchange, CAST(l_suppkey AS VARCHAR) AS symbol,
       l_extendedprice * l_quantity AS market_cap
FROM lineitem""")
def stock_extract(spark, sf_dir):
    return RC.parse_stock_line(stock_lines(spark, sf_dir))


WATCH_LIST = ["A:1", "N:2", "R:3"]


@register("stock_watchlist", """
SELECT l_returnflag || ':' || CAST(l_suppkey AS VARCHAR) AS symbol,
       strftime(l_shipdate, '%Y-%m-%d') AS date, l_extendedprice AS high, l_tax AS low
FROM lineitem
WHERE l_returnflag || ':' || CAST(l_suppkey AS VARCHAR) IN ('A:1', 'N:2', 'R:3')""")
def stock_watchlist(spark, sf_dir):
    return RC.stock_watch(stock_lines(spark, sf_dir), WATCH_LIST)


@register("max_by_symbol", """
SELECT l_returnflag AS exchange, CAST(l_suppkey AS VARCHAR) AS symbol,
       max(l_extendedprice * l_quantity) AS market_cap
FROM lineitem GROUP BY l_returnflag, l_suppkey""")
def max_by_symbol(spark, sf_dir):
    parsed = RC.parse_stock_line(stock_lines(spark, sf_dir))
    return AG.max_by_key(parsed, ["exchange", "symbol"], "market_cap", "market_cap")


# ---------------------------------------------------------------- listings

_LISTINGS_SQL = r"""
  SELECT p_brand AS city, CAST(p_partkey AS VARCHAR) AS link,
         p_name || ' $' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || ' '
           || CAST(p_size AS VARCHAR) || ' sqft' AS title
  FROM part"""

_PRICED_SQL = rf"""
  SELECT city, link, title,
         TRY_CAST(regexp_extract(title, '\$[\s]*([\d]+)', 1) AS INTEGER) AS price
  FROM ({_LISTINGS_SQL})"""

_LOWEST5_SQL = f"""
  SELECT city, link, title, price, rank FROM (
    SELECT city, link, title, price,
           row_number() OVER (PARTITION BY city ORDER BY price, link) AS rank
    FROM (SELECT city, link, min(price) AS price, arg_min(title, price) AS title
          FROM ({_PRICED_SQL}) WHERE price IS NOT NULL GROUP BY city, link))
  WHERE rank <= 5"""


def _priced(spark, sf_dir):
    ls = listings(spark, sf_dir)
    return (ls.withColumn("price", TX.regex_number("title", TX.PRICE_PATTERN))
            .where(F.col("price").isNotNull()))


def _lowest5(spark, sf_dir):
    return TK.lowest_n_per_group(_priced(spark, sf_dir), "city", "link", "price", 5,
                                 carry=["title"])


@register("regex_number", f"SELECT city, link, price FROM ({_PRICED_SQL}) WHERE price IS NOT NULL")
def regex_number(spark, sf_dir):
    return _priced(spark, sf_dir).select("city", "link", "price")


@register("lowest_n_per_group", f"SELECT city, link, title, price, rank FROM ({_LOWEST5_SQL})")
def lowest_n_per_group(spark, sf_dir):
    return _lowest5(spark, sf_dir).select("city", "link", "title", "price", "rank")


@register("lowest_n_sqft_per_group", rf"""
SELECT city, link, sqft, rank FROM (
  SELECT city, link, sqft, row_number() OVER (PARTITION BY city ORDER BY sqft, link) AS rank
  FROM (SELECT city, link, min(sqft) AS sqft FROM (
          SELECT city, link,
                 TRY_CAST(regexp_extract(title, '([\d]+)[\s]*sqft', 1) AS INTEGER) AS sqft
          FROM ({_LISTINGS_SQL})) WHERE sqft IS NOT NULL GROUP BY city, link))
WHERE rank <= 10""")
def lowest_n_sqft_per_group(spark, sf_dir):
    ls = listings(spark, sf_dir).withColumn("sqft", TX.regex_number("title", TX.SQFT_PATTERN))
    return TK.lowest_n_per_group(ls.where(F.col("sqft").isNotNull()), "city", "link",
                                 "sqft", 10).select("city", "link", "sqft", "rank")


@register("lowest_n_overall", f"""
SELECT city, link, title, price, row_number() OVER (ORDER BY price, link) AS rank
FROM ({_LOWEST5_SQL}) ORDER BY price, link LIMIT 5""")
def lowest_n_overall(spark, sf_dir):
    """Two-level ranking: the overall list is fed only by per-city winners."""
    winners = _lowest5(spark, sf_dir).drop("rank")
    return TK.top_n(winners, 5, ["price", "link"]).select(
        "city", "link", "title", "price", "rank")


@register("topn_report", f"""
SELECT city, rank, part,
       CASE WHEN part = 3 THEN
         printf('[%s], %s: [%d]  with title [%s] and link [%s].', city, 'Top5PriceByCity', price, title, link)
       ELSE ['', '**************************', ' [' || city || '] for Top5PriceByCity'][part + 1]
       END AS line
FROM (SELECT *, unnest(CASE WHEN rank = 1 THEN [0, 1, 2, 3] ELSE [3] END) AS part
      FROM ({_LOWEST5_SQL}))""")
def topn_report(spark, sf_dir):
    """The report's lines, each group under its heading."""
    return RP.topn_report(_lowest5(spark, sf_dir), "Top5PriceByCity")


@register("topn_report_file", f"""
SELECT CAST(row_number() OVER (ORDER BY city, rank, part) AS BIGINT) AS line_no, line FROM (
  SELECT city, rank, part,
         CASE WHEN part = 3 THEN
           printf('[%s], %s: [%d]  with title [%s] and link [%s].', city, 'Top5PriceByCity', price, title, link)
         ELSE ['', '**************************', ' [' || city || '] for Top5PriceByCity'][part + 1]
         END AS line
  FROM (SELECT *, unnest(CASE WHEN rank = 1 THEN [0, 1, 2, 3] ELSE [3] END) AS part
        FROM ({_LOWEST5_SQL})))""")
def topn_report_file(spark, sf_dir):
    """The report as text files in order of the groups, read back in file order."""
    path = scratch_path(spark, "topn_report_file")
    RP.write_report(RP.topn_report(_lowest5(spark, sf_dir), "Top5PriceByCity"),
                    ["city", "rank", "part"], path)
    return FS.numbered_lines(spark, path)


# ---------------------------------------------------------------- dimension counts

_ORDER_COUNTS_SQL = """
  SELECT c_custkey, c_name, CAST(count(o_orderkey) AS BIGINT) AS count
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_name"""


def _order_counts(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    return AG.zero_filled_counts(cust, orders, "c_custkey", "o_custkey")


@register("zero_filled_counts", _ORDER_COUNTS_SQL)
def zero_filled_counts(spark, sf_dir):
    """Every customer with its number of orders, 0 when it has none."""
    return _order_counts(spark, sf_dir).select("c_custkey", "c_name", "count")


@register("count_report", f"""
SELECT CAST(c_custkey AS VARCHAR) AS key,
       printf('[%3d] people said "[%s]" (Hello!) in [%s].', count, c_name,
              CAST(c_custkey AS VARCHAR)) AS line
FROM ({_ORDER_COUNTS_SQL})""")
def count_report(spark, sf_dir):
    counts = _order_counts(spark, sf_dir).withColumn(
        "key", F.col("c_custkey").cast("string"))
    return RP.count_report(counts, key="key", value="c_name", count="count")


# ---------------------------------------------------------------- joins

@register("natural_join_2", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def natural_join_2(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    left = c.select("c_custkey", "c_name", "c_nationkey")
    right = c.select("c_acctbal", "c_mktsegment", "c_custkey")
    return JN.natural_join([left, right], ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"],
                           strict=True)


@register("natural_join_3", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def natural_join_3(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    sides = [c.select("c_custkey", "c_name"), c.select("c_nationkey", "c_custkey"),
             c.select("c_custkey", "c_acctbal", "c_mktsegment")]
    return JN.natural_join(sides, ["c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                   "c_mktsegment"], strict=True)


def _part_suppliers(spark, sf_dir):
    """Tweeters of a part: the distinct suppliers that shipped it."""
    return (table(spark, sf_dir, "lineitem")
            .select(F.col("l_partkey").alias("url"), F.col("l_suppkey").alias("tweeter"))
            .distinct())


def _order_parts(spark, sf_dir):
    """Tweeters of an order: the parts on its lines (reach removes repeats)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("url"), F.col("l_partkey").alias("tweeter"))


def _part_shippers(spark, sf_dir):
    """Followers of a part: the distinct suppliers that shipped it."""
    return (table(spark, sf_dir, "lineitem")
            .select(F.col("l_partkey").alias("tweeter"), F.col("l_suppkey").alias("follower"))
            .distinct())


def _order_requests(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_orderkey").alias("url"))


@register("lookup_join", """
SELECT DISTINCT p_partkey, l_suppkey AS s_suppkey, s_name
FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey""")
def lookup_join(spark, sf_dir):
    req = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("url"))
    members = JN.lookup_join(req, _part_suppliers(spark, sf_dir), "url")
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("tweeter"), "s_name")
    return (members.join(sup, "tweeter")
            .select(F.col("url").alias("p_partkey"), F.col("tweeter").alias("s_suppkey"),
                    "s_name"))


_REACH_SQL = """
WITH t AS (SELECT DISTINCT l_orderkey AS url, l_partkey AS tweeter FROM lineitem),
     f AS (SELECT DISTINCT l_partkey AS tweeter, l_suppkey AS follower FROM lineitem)
SELECT o_orderkey AS request_id, CAST(count(DISTINCT f.follower) AS BIGINT) AS reach
FROM orders LEFT JOIN t ON t.url = o_orderkey LEFT JOIN f ON f.tweeter = t.tweeter
GROUP BY o_orderkey"""


@register("reach", _REACH_SQL)
def reach(spark, sf_dir):
    """Reach of every order: the distinct suppliers that have shipped any
    of its parts (order -> parts -> shippers). Orders without lines reach 0."""
    return reach_op(_order_requests(spark, sf_dir), _order_parts(spark, sf_dir),
                    _part_shippers(spark, sf_dir))


APPROX_RSD = 0.05


@register("reach_approx", """
SELECT o_orderkey AS request_id, true AS within_bound FROM orders""")
def reach_approx(spark, sf_dir):
    """Same with a HyperLogLog++ distinct count: per order, whether it lies
    within four relative standard deviations of the exact reach."""
    edges = (_order_requests(spark, sf_dir), _order_parts(spark, sf_dir),
             _part_shippers(spark, sf_dir))
    links = reach_links(*edges)
    approx = reach_op(*edges, approx=True, rsd=APPROX_RSD, links=links).withColumnRenamed(
        "reach", "about")
    exact = reach_op(*edges, links=links)
    return approx.join(exact, "request_id").select(
        "request_id", (F.abs(F.col("about") - F.col("reach"))
                       <= 4 * APPROX_RSD * F.col("reach")).alias("within_bound"))


# ---------------------------------------------------------------- keyed table

STATUSES = ["F", "O", "P"]

_KV_SQL = """
  SELECT o_custkey, o_orderstatus, arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY o_custkey, o_orderstatus"""


def latest_per_key(orders):
    """The keyed table: latest (by orderkey) total price per (customer, status)."""
    return (orders.groupBy("o_custkey", "o_orderstatus")
            .agg(F.max_by("o_totalprice", "o_orderkey").alias("o_totalprice")))


@register("keyed_lookup", f"""
SELECT c_custkey, status, kv.o_totalprice
FROM customer CROSS JOIN (VALUES ('F'), ('O'), ('P')) s(status)
LEFT JOIN ({_KV_SQL}) kv ON kv.o_custkey = c_custkey AND kv.o_orderstatus = status""")
def keyed_lookup(spark, sf_dir):
    """Batch get of (customer, status) keys; a missing key gives NULL."""
    req = table(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(F.array(*[F.lit(s) for s in STATUSES])).alias("status"))
    kv = latest_per_key(table(spark, sf_dir, "orders")).select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status"),
        "o_totalprice")
    return JN.keyed_lookup(req, kv, ["c_custkey", "status"]).select(
        "c_custkey", "status", "o_totalprice")


@register("composite_key", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || ':' || o_orderstatus AS key FROM orders""")
def composite_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", TX.composite_key("o_custkey", "o_orderstatus").alias("key"))


# ---------------------------------------------------------------- events: counts

def _batched_events(spark, sf_dir):
    """events with the micro-batch each would arrive in (three batches)."""
    return table(spark, sf_dir, "events").withColumn("batch_id", F.col("event_id") % 3)


@register("global_count", "SELECT count(*) AS count FROM events")
def global_count(spark, sf_dir):
    return AG.global_count(table(spark, sf_dir, "events"))


_CWP_SQL = """
  WITH pb AS (SELECT user_id, event_id % 3 AS batch_id, count(*) AS n FROM events GROUP BY 1, 2),
       r AS (SELECT user_id, batch_id,
                    sum(n) OVER (PARTITION BY user_id ORDER BY batch_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS count
             FROM pb)
  SELECT user_id, batch_id, CAST(count AS BIGINT) AS count,
         CAST(lag(count) OVER (PARTITION BY user_id ORDER BY batch_id) AS BIGINT) AS prev_count
  FROM r"""

# Registered outputs carry the nullable previous count as DOUBLE: pandas turns a
# nullable BIGINT into float64/NaN on the Spark side and Int64/NA on DuckDB's, so
# the same values would compare unequal. The operators keep BIGINT.
_CWP_OUT_SQL = f"""
  SELECT user_id, batch_id, count, CAST(prev_count AS DOUBLE) AS prev_count
  FROM ({_CWP_SQL})"""


@register("count_with_prev", _CWP_OUT_SQL)
def count_with_prev(spark, sf_dir):
    out = AG.count_with_prev(_batched_events(spark, sf_dir), "user_id", "batch_id")
    return out.withColumn("prev_count", F.col("prev_count").cast("double"))


@register("count_histogram", """
SELECT n // 10 AS bucket, count(*) AS n_keys
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) GROUP BY 1""")
def count_histogram(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("count"))
    return AG.count_histogram(counts)


HISTOGRAM_DELTAS_SQL = f"""
WITH cwp AS ({_CWP_SQL}),
d AS (SELECT batch_id, count // 10 AS bucket, 1 AS delta FROM cwp
      WHERE prev_count IS NULL OR count // 10 <> prev_count // 10
      UNION ALL
      SELECT batch_id, prev_count // 10 AS bucket, -1 AS delta FROM cwp
      WHERE prev_count IS NOT NULL AND count // 10 <> prev_count // 10),
t AS (SELECT batch_id, bucket, sum(delta) AS delta FROM d GROUP BY 1, 2)
SELECT batch_id, bucket,
       CAST(sum(delta) OVER (PARTITION BY bucket ORDER BY batch_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n_keys
FROM t"""


@register("histogram_deltas", HISTOGRAM_DELTAS_SQL)
def histogram_deltas(spark, sf_dir):
    updates = AG.count_with_prev(_batched_events(spark, sf_dir), "user_id", "batch_id")
    return AG.histogram_deltas(updates)


@register("hour_of_day", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def hour_of_day(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", RC.hour_of_day("ts").alias("hour"))


@register("repartition_checks", """
SELECT event_id, user_id, true AS same_partition FROM events""")
def repartition_checks(spark, sf_dir):
    """Random, then hash redistribution: every row survives, and after the
    hash repartition on user_id all rows of a user sit in one partition.
    (Catalyst collapses the two adjacent repartitions into the hash one.)
    The check is a window on user_id, which reuses that partitioning."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    n = spark.sparkContext.defaultParallelism
    parted = (ev.repartition(n).repartition(n, "user_id")
              .withColumn("_p", F.spark_partition_id()))
    w = Window.partitionBy("user_id")
    return parted.select("event_id", "user_id",
                         (F.min("_p").over(w) == F.max("_p").over(w)).alias("same_partition"))
