"""Temperature mixing of sources (DataFrame code only).

A source with token share p gets weight p**a / sum(p**a). The exponent ``a`` in
[0, 1] is bisected: with ``target_entropy`` (nats) it is the largest one whose
weights reach that entropy; with ``max_repeats`` no source may be read more
often than that, and the exponent is raised to the smallest that respects it.
The token budget is ``budget_tokens``, or, when that is None, the budget at
which the most down-weighted source is read exactly once, so that no document
is left out and small sources repeat.

Weights are realised as permutations: each source is read in epochs, every
epoch in its own hash order, up to the source's whole number of tokens; a
document that would exceed it is not read again. Every copy lies in one of the
blocks of about ``block_tokens`` tokens, in which each source has its weight's
share, and has a slot, a permutation of the block.

Running sums are two-level (cells of a source's hash order, then rows inside a
cell), so a source holding a third of all rows is spread over 4,096 cells. The
exponent search runs over one row holding one token sum per source.

Defined cases: null is a source of its own; documents without words are read
in each epoch and cost nothing; a source without words is read once; repeated
rows (equal source and doc_id) are accepted or left out together; an empty
table gives an empty result. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import stored

WORD = "[^\\x20\\x09-\\x0D]+"
STEPS = 60


def stratum(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def order_key(epoch: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def _exponent(target_entropy: float | None, max_repeats: float | None,
              budget: float | None) -> Column:
    """Bisected exponent over ``tokens`` (array of positive token sums)."""
    tokens = F.col("tokens")
    top = F.array_max(tokens).cast("double")
    total = F.aggregate(tokens, F.lit(0.0), lambda s, x: s + x)

    def norm(a: Column) -> Column:
        return F.aggregate(tokens, F.lit(0.0), lambda s, x: s + F.pow(x / top, a))

    def entropy(a: Column) -> Column:  # of w = (x/top)**a / z
        return F.log(norm(a)) - F.aggregate(tokens, F.lit(0.0), lambda s, x: s + F.pow(
            x / top, a) * a * F.log(x / top)) / norm(a)

    def repeats(a: Column) -> Column:  # of the smallest source
        low = F.array_min(tokens)
        if budget is None:
            return F.pow(top / low, 1 - a)
        return F.lit(budget) * F.pow(low / top, a) / norm(a) / low

    def bisect(good_low: bool, good) -> Column:
        """Largest good exponent (good_low: the low end is good) or smallest."""
        def step(b: Column, _: Column) -> Column:
            mid = (b["lo"] + b["hi"]) / 2
            up, down = (F.struct(mid.alias("lo"), b["hi"].alias("hi")),
                        F.struct(b["lo"].alias("lo"), mid.alias("hi")))
            return F.when(good(mid), up if good_low else down).otherwise(down if good_low else up)
        end = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)),
                          F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), step)
        return end["lo"] if good_low else end["hi"]

    a = F.lit(1.0) if target_entropy is not None or max_repeats is None else F.lit(0.0)
    if target_entropy is not None:
        a = F.when(entropy(F.lit(1.0)) >= target_entropy, F.lit(1.0)).otherwise(
            bisect(True, lambda m: entropy(m) >= target_entropy))
    if max_repeats is not None:
        a = F.greatest(a, F.when(repeats(F.lit(0.0)) <= max_repeats, F.lit(0.0)).otherwise(
            bisect(False, lambda m: repeats(m) <= max_repeats)))
    return F.when(total > 0, a).otherwise(F.lit(1.0))


def weights(sources: DataFrame, *, target_entropy: float | None = None,
            max_repeats: float | None = None, budget_tokens: int | None = None) -> DataFrame:
    """``stratum, tokens, weight, target, full`` from ``sources(stratum, tokens)``:
    target tokens and the number of whole epochs in them."""
    row = sources.where("tokens > 0").agg(F.sort_array(F.collect_list("tokens")).alias("tokens"))
    budget = None if budget_tokens is None else float(budget_tokens)
    row = row.select(
        F.array_max("tokens").alias("top"),
        _exponent(target_entropy, max_repeats, budget).alias("exponent"), "tokens")
    row = row.select(F.struct("top", "exponent", F.aggregate(
        "tokens", F.lit(0.0),
        lambda s, x: s + F.pow(x / F.col("top"), F.col("exponent"))).alias("z")).alias("r"))
    share = F.pow(F.col("tokens") / F.col("r.top"), F.col("r.exponent"))
    whole = F.col("r.top") if budget is None else F.lit(budget) / F.col("r.z")
    out = sources.withColumn("r", row.scalar()).withColumns({
        "weight": F.when(F.col("tokens") > 0, share / F.col("r.z")).otherwise(0.0),
        "target": F.when(F.col("tokens") > 0, F.round(whole * share)).otherwise(0)
        .cast("bigint")})
    return out.select("stratum", "tokens", "weight", "target", F.when(
        F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens"))).otherwise(1)
        .cast("int").alias("full"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.col("source"), stratum(F.col("source")).alias("stratum"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("bigint")
        .alias("n_tokens"))


def _copies(rows: DataFrame, plan: DataFrame, seed: str, first: Column) -> DataFrame:
    """One row per (document, epoch), with the running token sum ``upto`` of its
    source's permutations from epoch ``first`` (peers have the same sum)."""
    copies = (rows.join(plan.drop("weight"), "stratum")
              .withColumn("epoch", F.explode(F.sequence(first, F.col("full"))))
              .withColumn("order", order_key(F.col("epoch"), seed))
              .withColumn("cell", F.substring("order", 1, 3)))
    keys = ["stratum", "epoch", "cell"]
    cells = copies.groupBy(*keys).agg(F.sum("n_tokens").alias("sum"))
    before = (Window.partitionBy("stratum").orderBy("epoch", "cell")
              .rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select(*keys, F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*keys).orderBy("order")
    return (copies.withColumn("run", F.sum("n_tokens").over(inside)).join(cells, keys)
            .withColumn("upto", F.col("offset") + F.col("run")))


def _kept() -> Column:
    return F.when(F.col("tokens") > 0, F.col("upto") <= F.col("target")).otherwise(
        F.col("epoch") == 0)


def mix(docs: DataFrame, *, target_entropy: float | None = None,
        max_repeats: float | None = 2.0, budget_tokens: int | None = None,
        block_tokens: int = 1 << 18, seed: str = "mix") -> DataFrame:
    """The mixture: ``doc_id, source, epoch, n_tokens, block, slot`` per copy."""
    rows = stored(_rows(docs), "mix-rows")
    plan = stored(weights(rows.groupBy("stratum").agg(F.sum("n_tokens").alias("tokens")),
                          target_entropy=target_entropy, max_repeats=max_repeats,
                          budget_tokens=budget_tokens), "mix-plan")
    blocks = plan.agg(F.greatest(F.lit(1), F.ceil(F.sum("target") / F.lit(block_tokens)))
                      .cast("bigint")).scalar()
    out = _copies(rows, plan, seed, F.lit(0)).where(_kept())
    begin = F.col("upto") - F.col("n_tokens")  # the copy's place in its source's stream
    out = out.withColumn("blocks", blocks).withColumn("block", F.when(
        F.col("target") > 0, F.least(F.col("blocks") - 1, F.floor(
            begin * F.col("blocks") / F.col("target")))).otherwise(0).cast("bigint"))
    order = Window.partitionBy("block").orderBy(F.reverse("order"), "source", "epoch", "n_tokens")
    return out.select("doc_id", "source", "epoch", "n_tokens", "block",
                      (F.row_number().over(order) - 1).cast("bigint").alias("slot"))


def mix_documents(docs: DataFrame, *, target_entropy: float | None = None,
                  max_repeats: float | None = 2.0, budget_tokens: int | None = None,
                  seed: str = "mix") -> DataFrame:
    """``docs`` with each row as often as the mixture reads it; all columns kept.

    Only keys and token counts are shuffled: the last, partial epoch of a
    source ends at one hash value, found from the running sums, and each
    document compares its own hash with it.
    """
    rows = stored(_rows(docs), "mix-rows")
    plan = stored(weights(rows.groupBy("stratum").agg(F.sum("n_tokens").alias("tokens")),
                          target_entropy=target_entropy, max_repeats=max_repeats,
                          budget_tokens=budget_tokens), "mix-plan")
    rest = F.col("target") - F.col("full") * F.col("tokens")
    last = (_copies(rows, plan, seed, F.col("full")).where((F.col("tokens") > 0)
                                                          & (F.col("upto") <= rest))
            .groupBy("stratum").agg(F.max("order").alias("end")))
    ends = stored(plan.select("stratum", "full").join(last, "stratum", "left"), "mix-ends")
    names = docs.columns
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id",
                         stratum(F.col("source")).alias("stratum"))
    times = F.col("full") + F.coalesce(
        (order_key(F.col("full"), seed) <= F.col("end")).cast("int"), F.lit(0))
    return (tagged.join(ends, "stratum")
            .withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).select("row.*"))
