"""Minimax contiguous partition of documents into shards (DataFrame code only).

Atoms are runs of the CRC-32 space of the text (``ATOMS`` equal ranges, at
most 65,536 whatever the input size), so equal texts always share an atom and
the table of atom sizes is bounded. Over the atoms in CRC order the smallest
shard capacity is found by binary search: a capacity is feasible when greedy
filling needs at most ``shards`` shards. The cuts then keep every shard within
that capacity: a shard is closed once it is nearest to the mean of what is
left, if the atoms after it still fit the shards after it, and not before.
The search is one higher-order-function expression over one row.

Slots: rows are numbered inside cells (atom, one of ``SALTS`` salts by doc_id)
and cells are offset by the counts before them in the shard, so neither a hot
group of equal texts nor a whole shard is one task's window.

Defined cases: a null text has size 16 and the CRC of the empty text; repeated
rows and null doc_ids each get a slot of their own; fewer atoms than shards
leaves shards empty; an empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import stored

ATOMS, SALTS = 1 << 16, 16


def _capacity(items: Column, shards: int) -> Column:
    """Smallest capacity under which greedy filling needs at most ``shards``."""
    total = F.aggregate(items, F.lit(0).cast("bigint"), lambda s, x: s + x["bytes"])
    largest = F.aggregate(items, F.lit(0).cast("bigint"), lambda s, x: F.greatest(s, x["bytes"]))

    def used(capacity: Column) -> Column:
        start = F.struct(F.lit(1).alias("n"), F.lit(0).cast("bigint").alias("fill"))
        return F.aggregate(
            items, start,
            lambda s, x: F.when(s["fill"] + x["bytes"] <= capacity,
                                F.struct(s["n"].alias("n"), (s["fill"] + x["bytes"]).alias("fill")))
            .otherwise(F.struct((s["n"] + 1).alias("n"), x["bytes"].alias("fill"))))["n"]

    def halve(b: Column, _: Column) -> Column:
        mid = F.floor((b["lo"] + b["hi"]) / 2).cast("bigint")
        return F.when(b["lo"] >= b["hi"], b).otherwise(
            F.when(used(mid) <= shards, F.struct(b["lo"].alias("lo"), mid.alias("hi")))
            .otherwise(F.struct((mid + 1).alias("lo"), b["hi"].alias("hi"))))

    low = F.greatest(largest, F.ceil(total / F.lit(shards)).cast("bigint"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(62)),
                       F.struct(low.alias("lo"), (low + largest).alias("hi")), halve)["hi"]


def _tails(capacity: Column) -> Column:
    """tails[j]: the first place whose suffix fits ``j`` shards, filled from the right."""
    start = F.struct(F.lit(0).cast("bigint").alias("fill"), F.lit(0).alias("first"),
                     F.array().cast("array<int>").alias("tails"))
    end = F.aggregate(
        F.reverse(F.col("items")), start,
        lambda s, x: F.when(s["fill"] + x["bytes"] <= capacity,
                            F.struct((s["fill"] + x["bytes"]).alias("fill"),
                                     x["pos"].alias("first"), s["tails"].alias("tails")))
        .otherwise(F.struct(x["bytes"].alias("fill"), x["pos"].alias("first"),
                            F.array_append(s["tails"], s["first"]).alias("tails"))))
    return F.concat(F.array(F.lit(ATOMS)), F.array_append(end["tails"], end["first"]))


def _cuts(shards: int) -> Column:
    """First places of shards 1, 2, ... (from ``items``, ``capacity``, ``tails``, ``mean``)."""
    start = F.struct(F.lit(0).cast("bigint").alias("fill"), F.lit(0.0).alias("even"),
                     F.col("level").alias("left"), F.array().cast("array<int>").alias("cuts"))

    def step(s: Column, x: Column) -> Column:
        size, even = x["bytes"], F.least(x["bytes"].cast("double"), F.col("mean"))
        rest = F.lit(shards - 1) - F.size(s["cuts"])  # shards after the open one
        # From this atom on, do the shards after the open one suffice?
        fits = x["pos"] >= F.element_at(F.col("tails"), F.least(rest + 1, F.size("tails")))
        full = (s["fill"] + size > F.col("capacity")) | (
            s["even"] + even / 2 > s["left"] / (rest + 1))
        keep = F.struct((s["fill"] + size).alias("fill"), (s["even"] + even).alias("even"),
                        s["left"].alias("left"), s["cuts"].alias("cuts"))
        cut = F.struct(size.alias("fill"), even.alias("even"),
                       (s["left"] - s["even"]).alias("left"),
                       F.array_append(s["cuts"], x["pos"]).alias("cuts"))
        return F.when((s["fill"] > 0) & (rest > 0) & fits & full, cut).otherwise(keep)

    return F.aggregate("items", start, step)["cuts"]


def place(atoms: DataFrame, shards: int) -> DataFrame:
    """``atom, shard`` of all ``atoms(atom, bytes)``, at most ``ATOMS`` rows."""
    row = atoms.agg(F.collect_list(F.struct("atom", "bytes")).alias("items"),
                    (F.sum("bytes") / F.lit(float(shards))).alias("mean"))
    ranked = F.sort_array(F.transform("items", lambda x: F.struct(
        F.when(x["bytes"] >= F.col("mean"), -x["bytes"]).otherwise(0).alias("rank"),
        x["atom"].alias("atom"), x["bytes"].alias("bytes"))))
    row = row.withColumn("items", F.transform(ranked, lambda x, i: F.struct(
        i.alias("pos"), x["atom"].alias("atom"), x["bytes"].alias("bytes"))))
    row = (row.withColumn("capacity", _capacity(F.col("items"), shards))
           .withColumn("tails", _tails(F.col("capacity")))
           .withColumn("level", F.aggregate("items", F.lit(0.0), lambda s, x: s + F.least(
               x["bytes"].cast("double"), F.col("mean")))))
    row = row.select("items", _cuts(shards).alias("cuts"))
    return row.select("cuts", F.explode("items").alias("x")).select(
        "x.atom", F.size(F.filter("cuts", lambda c: c <= F.col("x.pos"))).alias("shard"))


def shard(docs: DataFrame, shards: int = 40, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, size, text_crc32, shard, slot`` for every row of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 16).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32")), "shard-rows")
    rows = rows.withColumns({
        "atom": F.floor(F.col("text_crc32") / F.lit((1 << 32) // ATOMS)).cast("int"),
        "salt": F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")})
    cells = rows.groupBy("atom", "salt").agg(F.count(F.lit(1)).alias("n"),
                                             F.sum("size").alias("bytes"))
    atoms = cells.groupBy("atom").agg(F.sum("bytes").alias("bytes"))
    cells = cells.join(stored(place(atoms, shards), "shard-atoms"), "atom")
    before = (Window.partitionBy("shard").orderBy("atom", "salt")
              .rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("atom", "salt", "shard",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("atom", "salt").orderBy("text_crc32", "doc_id")
    numbered = rows.withColumn("at", F.row_number().over(inside))
    return numbered.join(cells, ["atom", "salt"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("offset") + F.col("at") - 1).cast("bigint").alias("slot"))


def op2_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    return shard(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
