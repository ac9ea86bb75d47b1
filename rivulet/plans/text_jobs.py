"""Queries over ``documents``, ``conversations``, ``pages`` and ``part`` text."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions import text as TX
from rivulet.functions.udtf import split_words_batches
from rivulet.operators import aggregates as AG
from rivulet.operators import topk as TK
from rivulet.plans.registry import register
from rivulet.session import table

# Java-rule words of documents.text, as SQL.
_JAVA_WORDS = """
  SELECT doc_id, lang, unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = ''
                                   THEN []::VARCHAR[]
                                   ELSE string_split(rtrim(text, ' '), ' ') END) AS word
  FROM documents"""


@register("split_words", f"SELECT doc_id, word FROM ({_JAVA_WORDS})")
def split_words(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return AG.words(docs, "text", "java", keep=("doc_id",))


@register("word_count", f"""
SELECT word, count(*) AS count FROM ({_JAVA_WORDS}) GROUP BY word""")
def word_count(spark, sf_dir):
    return AG.word_count(table(spark, sf_dir, "documents"), "text", "java")


@register("split_words_udtf", """
SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents""")
def split_words_udtf_q(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_words_batches(docs, "text", mode="python", keep=["doc_id"])


@register("top_words", f"""
SELECT lang, word, count, rank FROM (
  SELECT lang, word, count,
         row_number() OVER (PARTITION BY lang ORDER BY count DESC, word ASC) AS rank
  FROM (SELECT lang, word, count(*) AS count FROM ({_JAVA_WORDS}) GROUP BY lang, word))
WHERE rank <= 10""")
def top_words(spark, sf_dir):
    counts = AG.word_count(table(spark, sf_dir, "documents"), "text", "java", by=("lang",))
    return TK.top_by_count(counts, "word", 10, by=["lang"]).select(
        "lang", "word", "count", "rank")


@register("first_n_per_partition", f"""
SELECT lang, word, count, rank FROM (
  SELECT lang, word, count, row_number() OVER (PARTITION BY lang ORDER BY word ASC) AS rank
  FROM (SELECT lang, word, count(*) AS count FROM ({_JAVA_WORDS}) GROUP BY lang, word))
WHERE rank <= 3""")
def first_n_per_partition(spark, sf_dir):
    counts = AG.word_count(table(spark, sf_dir, "documents"), "text", "java", by=("lang",))
    return TK.first_n_per_partition(counts, "lang", "word", n=3).select(
        "lang", "word", "count", "rank")


@register("word_sum_query", """
WITH wc AS (SELECT word, count(*) AS count FROM (
              SELECT unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = ''
                                 THEN []::VARCHAR[]
                                 ELSE string_split(rtrim(text, ' '), ' ') END) AS word
              FROM documents) GROUP BY word),
     rq AS (SELECT conv_id, turn, unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = ''
                                             THEN []::VARCHAR[]
                                             ELSE string_split(rtrim(text, ' '), ' ') END) AS word
            FROM conversations)
SELECT c.conv_id, c.turn, CAST(coalesce(s.total, 0) AS BIGINT) AS total
FROM (SELECT DISTINCT conv_id, turn FROM conversations) c
LEFT JOIN (SELECT conv_id, turn, sum(wc.count) AS total
           FROM rq JOIN wc ON wc.word = rq.word GROUP BY conv_id, turn) s
  ON s.conv_id = c.conv_id AND s.turn = c.turn""")
def word_sum_query(spark, sf_dir):
    """Requests (every conversation turn) against live word counts: the sum
    of the counts of the request's words; unknown words add nothing and a
    repeated word counts each time."""
    counts = AG.word_count(table(spark, sf_dir, "documents"), "text", "java")
    conv = table(spark, sf_dir, "conversations")
    req_words = AG.words(conv, "text", "java", keep=("conv_id", "turn"))
    summed = (req_words.join(counts, "word", "inner")
              .groupBy("conv_id", "turn").agg(F.sum("count").alias("total")))
    return (conv.select("conv_id", "turn").distinct()
            .join(summed, ["conv_id", "turn"], "left")
            .select("conv_id", "turn",
                    F.coalesce("total", F.lit(0)).cast("bigint").alias("total")))


@register("append_suffix", """
SELECT p_partkey, p_name || '!!!' || '!!!' AS exclaimed FROM part""")
def append_suffix(spark, sf_dir):
    """The exclamation job: the suffix appended by two chained operators."""
    p = table(spark, sf_dir, "part")
    once = p.select("p_partkey", TX.append_suffix("p_name").alias("x"))
    return once.select("p_partkey", TX.append_suffix("x").alias("exclaimed"))


@register("page_title", r"""
SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>(.+?)</title>', 1), ''),
                         '<unknown>') AS title
FROM pages""")
def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", TX.page_title("html").alias("title"))


# The driver's pages carry HTML anchors, not wiki links; the link pattern is
# a parameter of page_links, and this query passes the anchor form.
ANCHOR_PATTERN = r'<a href="(.+?)">'


@register("page_links", r"""
WITH m AS (SELECT page_id,
                  list_slice(list_filter(regexp_extract_all(html, '<a href="(.+?)">', 1),
                                         lambda x: NOT regexp_full_match(x, '\|*')), 1, 10) AS ls
           FROM pages)
SELECT page_id, CAST(unnest(generate_series(1, len(ls))) AS INTEGER) AS link_pos,
       unnest(list_transform(ls, lambda x: split_part(x, '|', 1))) AS link
FROM m""")
def page_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = pages.select("page_id", F.posexplode(TX.page_links("html", ANCHOR_PATTERN)))
    return links.select("page_id", (F.col("pos") + 1).cast("int").alias("link_pos"),
                        F.col("col").alias("link"))


@register("split_words_ruby", r"""
SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '[ \t\n\v\f\r]+'),
                                  lambda w: w <> '')) AS word
FROM documents""")
def split_words_ruby(spark, sf_dir):
    """The whitespace-collapsing tokeniser (JVM expression)."""
    docs = table(spark, sf_dir, "documents")
    return AG.words(docs, "text", "ruby", keep=("doc_id",))
