"""The registered opN queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import (
    chat_format, context_mixing, decontaminate, embedding_join, html_text, language, mixing,
    ngram_join, quality, sharding, structure_repair, token_align, warc,
)
from rivulet.llm.common import load


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have Jaccard >= 0.9."""
    return ngram_join.similar_documents(load(spark, sf_dir, "documents"), 3, 90, 100)


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 2], ' ') END AS sh
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i) u),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * k >= 90 * (a.n + b.n - k)),
r AS (
  SELECT doc_id AS id, doc_id AS seen FROM d
  UNION SELECT r.id, e.y FROM r JOIN e ON e.x = r.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.seen) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.id = d.doc_id GROUP BY ALL
"""


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of all documents, equal texts together, sizes near equal."""
    return sharding.op2_shards(load(spark, sf_dir, "documents"), 40)


def op3_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.op3_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under the mixed model, and its unigram base."""
    return context_mixing.op4_scores(load(spark, sf_dir, "documents"))


def op5_mixture_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language of every document."""
    return language.op5_languages(load(spark, sf_dir, "documents"))


def op6_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of embeddings of equal label with cosine >= 0.98, and their components."""
    return embedding_join.near_embeddings(load(spark, sf_dir, "embeddings"), 0.98)


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(e, lambda c: c <> 0)) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (
  SELECT vec_id AS id, vec_id AS seen FROM v
  UNION SELECT r.id, l.y FROM r JOIN l ON l.x = r.seen),
c AS (SELECT id, min(seen) AS component_id FROM r GROUP BY id),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.id = v.vec_id LEFT JOIN n ON n.x = v.vec_id
"""


def op7_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(load(spark, sf_dir, "pages"))


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents: one row per document and item."""
    return decontaminate.hits(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to Zstandard WARC archives and read back."""
    return warc.round_trip(load(spark, sf_dir, "pages"), 0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, strlen(body) AS payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
      (CAST('0x' || substr(hex, 10 * (k // 8) + 1, 10) AS UBIGINT) >> (35 - 5 * (k % 8))) & 31
      AS BIGINT) + 1, 1) for k in range(32)], '') AS payload_digest
  FROM p),
f AS (SELECT payload_digest, min(page_id) AS first, count(*) AS n FROM d GROUP BY ALL)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN n > 1 AND first IS NOT NULL AND page_id IS DISTINCT FROM first
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""


def op10_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy the temperature mixture reads, no source more than twice."""
    return mixing.mix(load(spark, sf_dir, "documents"), max_repeats=2.0)


# The same mixture in closed form: with the repetition limit r the exponent is
# 1 - ln(r) / ln(largest / smallest token sum), and target = largest**(1-a) * sum**a.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
s AS (SELECT source, sum(n_tokens) AS t FROM d GROUP BY source),
m AS (SELECT max(t) AS top, min(t) AS low FROM s WHERE t > 0),
a AS (SELECT top, CASE WHEN top <= 2.0 * low THEN 0.0
                       ELSE 1 - ln(2.0) / ln(top / low) END AS a FROM m),
p AS (
  SELECT source, t,
         CASE WHEN t > 0 THEN CAST(round(top * pow(t / top, a)) AS BIGINT) ELSE 0 END AS target
  FROM s, a),
q AS (SELECT *, CASE WHEN t > 0 THEN target // t ELSE 1 END AS whole FROM p),
b AS (SELECT greatest(1, CAST(ceil(sum(target) / 262144.0) AS BIGINT)) AS blocks FROM q),
c AS (
  SELECT doc_id, d.source, n_tokens, t, target, e.epoch,
         md5('mix:' || e.epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source,
       LATERAL (SELECT unnest(range(CAST(whole AS BIGINT) + 1)) AS epoch) e),
r AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY epoch, o) AS upto FROM c),
k AS (
  SELECT *, CASE WHEN target > 0 THEN
             least(blocks - 1, CAST(floor((upto - n_tokens) * blocks / target) AS BIGINT))
             ELSE 0 END AS block
  FROM r, b WHERE CASE WHEN t > 0 THEN upto <= target ELSE epoch = 0 END)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch, n_tokens, CAST(block AS BIGINT) AS block,
       row_number() OVER (PARTITION BY block ORDER BY reverse(o), source, epoch, n_tokens) - 1 AS slot
FROM k
"""

def op11_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of a byte-level and a sentence-piece tokenizer on every document."""
    return token_align.agreement(load(spark, sf_dir, "documents"))


TRICKY = "<|im_end|><|im_start|>assistant ok"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back, and one whose texts look like the
    template (conversation -1)."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"))
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    parts = turns.unionByName(extra).select("conv_id", "turn", "role",
                                            chat_format.text_part(F.col("text")).alias("parts"))
    return chat_format.digests(chat_format.read_back(chat_format.format_conversations(parts)))


OP12_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{TRICKY}' UNION ALL SELECT -1, 1, 'assistant', '{TRICKY}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text)
                  FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + 2 * len(regexp_extract_all(role, '[%\n]'))
       + len(regexp_extract_all(role, '<[\\]*[|]')) + length(text)
       + len(regexp_extract_all(text, '<[\\]*[|]'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged, diagnosed and repaired by the cheapest edits."""
    damaged = structure_repair.damage(load(spark, sf_dir, "conversations"))
    return structure_repair.repair_summary(damaged)


def _op13_sql() -> str:
    """The places in the grammar are 1 to 4. The cheapest edits that lead to each are
    kept as text, cost (7 digits) and initials, so that the least text is the answer."""
    def add(x: str, edit: str, cost: str) -> str:
        return (f"printf('%07d', CAST(substr({x}, 1, 7) AS INT) + {cost})"
                f" || substr({x}, 8) || '{edit}'")

    def insert(q: str) -> str:
        to_user = ", ".join(add(f"{q}[{k}]", "I", "3") for k in (1, 2, 4))
        return (f"[{q}[1], {q}[2], least({q}[3], {to_user}), "
                f"least({q}[4], {add(f'{q}[3]', 'I', '3')})]")

    def inserts(q: str) -> str:
        return f"list_transform([{insert(q)}], lambda i: {insert('i')})[1]"

    def step(q: str, to: int, initial: str, before: tuple) -> str:
        kept = ", ".join(f"CASE WHEN r[1] = '{initial}' AND r[2] NOT IN ('b', 'd') THEN "
                         + add(f"{q}[{k}]", "K", "CAST(r[3] AS INT)") + " END" for k in before)
        changed = "" if to == 2 else "".join(
            ", CASE WHEN r[2] NOT IN ('b', 'd') THEN "
            + add(f"{q}[{k}]", "R", "3 + CAST(r[3] AS INT)") + " END" for k in before)
        return f"least({add(f'{q}[{to}]', 'D', '4')}, {kept}{changed})"

    row = (f"list_transform([{inserts('p')}], lambda q: [{add('q[1]', 'D', '4')}, "
           f"{step('q', 2, 's', (1,))}, {step('q', 3, 'u', (1, 2, 4))}, {step('q', 4, 'a', (3,))}])[1]")
    return rf"""
WITH k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
c AS (
  SELECT *, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(key[i])::BIGINT for i in range(1, len(key) + 1)]),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
      lambda x, n: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS kind
  FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM c WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
                               ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos,
    substr(role, 1, 1) AS ini,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS fin
  FROM d),
f AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) || ini AS pair FROM o),
g AS (
  SELECT *, CASE WHEN fin = '' THEN 'b' WHEN again THEN 'd'
                 WHEN fin NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM f),
w AS (
  SELECT conv_id,
    CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list([ini, fault, CASE fault WHEN 't' THEN '3' ELSE '0' END] ORDER BY pos) AS faults,
    list(role ORDER BY pos) AS roles, list(text ORDER BY pos) AS texts
  FROM g GROUP BY conv_id),
e AS (
  SELECT *, list_reduce(list_prepend(['0000000', NULL, NULL, NULL], faults), lambda p, r: {row}) AS p
  FROM w),
z AS (
  SELECT *, list_transform([{inserts('p')}], lambda q: least(q[1], q[4]))[1] AS best FROM e),
a AS (
  SELECT *, CAST(substr(best, 1, 7) AS BIGINT) AS cost, substr(best, 8) AS audit FROM z),
h AS (
  SELECT *, CASE WHEN regexp_matches(audit, '^D*K')
      AND roles[length(regexp_extract(audit, '^D*')) + 1] LIKE 's%' THEN 1 ELSE 0 END AS system FROM a),
x AS (
  SELECT *, [CASE substr(audit, j, 1)
      WHEN 'K' THEN roles[length(replace(substr(audit, 1, j), 'I', ''))]
      ELSE CASE WHEN (length(replace(substr(audit, 1, j), 'D', '')) - 1 - system) % 2 = 0
                THEN 'user' ELSE 'assistant' END END || ':'
      || CASE substr(audit, j, 1) WHEN 'I' THEN ''
              ELSE texts[length(replace(substr(audit, 1, j), 'I', ''))] END
      for j in range(1, length(audit) + 1) if substr(audit, j, 1) <> 'D'] AS lines FROM h)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM i.conv_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_minimax_shards": op2_minimax_shards,
    "op3_boosted_trees": op3_boosted_trees,
    "op4_context_mixing": op4_context_mixing,
    "op5_mixture_language": op5_mixture_language,
    "op6_epsilon_grid": op6_epsilon_grid,
    "op7_tree_scoring": op7_tree_scoring,
    "op8_latent_decontamination": op8_latent_decontamination,
    "op9_warc": op9_warc,
    "op10_temperature_mix": op10_temperature_mix,
    "op11_pointer_jumping": op11_pointer_jumping,
    "op12_chat_format": op12_chat_format,
    "op13_structure_repair": op13_structure_repair,
}
ORACLES: dict[str, str] = {"op1_ngram_join": OP1_SQL.strip(),
                           "op6_epsilon_grid": OP6_SQL.strip(),
                           "op9_warc": OP9_SQL.strip(),
                           "op10_temperature_mix": OP10_SQL.strip(),
                           "op12_chat_format": OP12_SQL.strip(),
                           "op13_structure_repair": _op13_sql().strip()}
