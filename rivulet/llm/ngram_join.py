"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct ``size``-word shingles (64-bit hashes).
Two sets link when ``den * |intersection| >= num * |union|``.

Index. Tokens are ordered rare before frequent, then by frequency. A linked
pair differs in at most ``tau = n - ceil(num * n / den)`` tokens of either set,
so a prefix is extended token by token until ``tau`` differences leave at least
``least_shared`` of its signatures in common. A rare token is a signature by
itself. Frequent tokens are dealt into sub-classes by hash, and a signature is
a pair of tokens of one sub-class: a difference destroys one of the tokens
that a sub-class has beyond its first, which is what the extension counts. The
number of sub-classes and ``least_shared`` depend on the size bucket (powers of
two); a set that can reach a partner in the bucket below is indexed there too.
A linked pair therefore always shares ``least_shared`` signatures, whatever the
frequencies are; they only steer the cost. A set that has fewer signatures
in common with all others together is left out before any text is read again.

Frequencies. A token is frequent when its count, summed over the tasks that
saw it at least four times in a stretch of their input, is at least
1/2**17 of all tokens: that table has at most 131,072 rows at any input size.

Candidates and verification. Equal sets are one class, so copies are never
paired. Within a signature of many classes the candidates are tried as stars
first, at any input size: every class against one leader, linear in the index.
Classes already connected need
no further test, and the pairs of unconnected classes that are left are counted.
As long as a star at least halves them (a large group of near copies) another
one follows, with other leaders; then, or when they are few against the index,
all of them are tried, as pairs of blocks compared inside a task; the pairs of
signatures of few classes are tried once, as rows, with the first of these. Blocks return, first within blocks and then
across them, only pairs enough to connect what may link; what these connect needs
no further test, and the few pairs left between components come last. Every pair
that shares a signature is in the end either tried or already connected, so
components are exact.
Verification first compares sizes and parity words, which bound the number of
tokens that differ from below, and then intersects the full sets.

Defined cases: null or word-less text has the empty set and links with
nothing; a null doc_id links with nothing and has a null component; repeated
rows are kept and belong to one class; ties do not arise (ids and hashes are
ordered); an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import connected_components, discard, in_few_tasks, stored
from rivulet.llm.textcore import Words, chunks, mix, row_sums, shingles, text_bytes

FREQUENT_SHARE = 1 << 17   # a frequent token holds at least 1/this of all tokens
STRETCH = 1 << 21          # shingles counted together in a task
FEW = 1 << 19              # ids that may be broadcast
SETS_A_TASK = 1 << 13      # rows with whole sets that are worth a task
WORDS = 32                 # parity words of a set
SMALL, BLOCK = 32, 256     # classes of a signature that are joined as rows; in a block
_STEPS = ("same", "cross", "all")  # the steps behind the stars
STARS = 12                 # star rounds before all remaining pairs are verified
_NODE, _CELL = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def _sets(batch: pa.RecordBatch, size: int):
    """doc, shingle (sorted), size and node (64-bit hash of the set) per row."""
    doc, s = shingles(Words(*text_bytes(batch.column("text"))), size)
    n = np.bincount(doc, minlength=batch.num_rows)
    node = mix(row_sums(mix(s ^ _NODE), doc, batch.num_rows)
               + n.astype(np.uint64) * _CELL).view(np.int64)
    return doc, s, n, node


def _scan(size: int):
    """Per row ``doc_id, n, node``; per stretch the shingles seen often in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "node", "token", "seen"]
        held, total = [], 0

        def often() -> pa.RecordBatch:
            token, seen = np.unique(np.concatenate(held), return_counts=True)
            token, seen = token[seen >= 4], seen[seen >= 4]
            none = pa.nulls(len(token), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, none, pa.array(token.view(np.int64)), pa.array(seen)], names)

        for b in chunks(batches, "text"):
            _, s, n, node = _sets(b, size)
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(node), none, none], names)
            held.append(s)
            total += len(s)
            if total >= STRETCH:
                yield often()
                held, total = [], 0
        if held:
            yield often()
    return run


def least_shared(bucket):
    """Signatures that a linked pair of the size bucket has in common."""
    return np.maximum(1, (1 << np.maximum(bucket, 0)) >> 4)


def signatures(doc, s, n, level, num: int, den: int):
    """``(row, signature, bucket)`` of sets given as sorted ``(doc, s)`` with sizes
    ``n`` and token levels (0: rare)."""
    order = np.lexsort((s, level, doc))
    doc, s, level = doc[order], s[order], level[order]
    need = -(-num * n // den)
    tau = n - need
    bucket = np.where(n > 0, np.frexp(n.astype(np.float64))[1] - 1, 0)
    rows, sigs, buckets = [], [], []
    for down in (0, 1):
        at = bucket - down
        member = (n > 0) & (at >= 0) & ((down == 0) | (need < (1 << bucket)))
        keep = member[doc]
        d, t, lv = doc[keep], s[keep], level[keep]
        if not len(d):
            continue
        cells = np.maximum(1, (1 << np.maximum(at, 0)) >> 2).astype(np.uint64)[d]
        cell = mix(t ^ _CELL) % cells
        rare = lv == 0
        # A frequent token counts unless it is the first of its sub-class.
        counts = rare.copy()
        freq = np.flatnonzero(~rare)
        o = freq[np.lexsort((freq, cell[freq], d[freq]))]
        later = np.zeros(len(o), bool)
        later[1:] = (d[o][1:] == d[o][:-1]) & (cell[o][1:] == cell[o][:-1])
        counts[o[later]] = True
        run = np.cumsum(counts) - counts
        first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        run -= np.repeat(run[first], np.diff(np.append(first, len(d))))
        prefix = run < (tau + least_shared(at))[d]
        salt = mix((at[d] + 1).astype(np.uint64))
        one = rare & prefix
        rows.append(d[one])
        sigs.append(mix(t[one] ^ salt[one]))
        buckets.append(at[d[one]])
        o = np.flatnonzero(~rare & prefix)
        o = o[np.lexsort((t[o], cell[o], d[o]))]
        step = 1
        while len(o) > step:
            a, b = o[:-step], o[step:]
            same = (d[a] == d[b]) & (cell[a] == cell[b])
            if not same.any():
                break
            a, b = a[same], b[same]
            rows.append(d[a])
            sigs.append(mix(mix(t[a] + _NODE) + t[b] ^ salt[a]))
            buckets.append(at[d[a]])
            step += 1
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(sigs), np.concatenate(buckets)


def _index(size: int, num: int, den: int, frequent):
    """Index rows ``sig, node, bucket``; a set is indexed once by each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, levels = frequent.value
        seen: set[int] = set()
        for b in chunks(batches, "text"):
            doc, s, n, node = _sets(b, size)
            fresh = np.zeros(len(node), bool)
            for k, x in enumerate(node.tolist()):
                if x not in seen:
                    seen.add(x)
                    fresh[k] = True
            doc, s, n = doc[fresh[doc]], s[fresh[doc]], np.where(fresh, n, 0)
            level = np.zeros(len(s), np.int64)
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                level = np.where(tokens[at] == s, levels[at], 0)
            row, sig, bucket = signatures(doc, s, n, level, num, den)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig.view(np.int64)), pa.array(node[row]),
                 pa.array(bucket.astype(np.int32))], ["sig", "node", "bucket"])
    return run


def _whole_sets(size: int):
    """``node, n, parity, tokens`` of every row: the full set, its size, and for
    ``64 * WORDS`` hash classes whether it has an odd number of tokens in each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            doc, s, n, node = _sets(b, size)
            off = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            place = doc * (64 * WORDS) + (s % np.uint64(64 * WORDS)).astype(np.int64)
            odd = np.bincount(place, minlength=b.num_rows * 64 * WORDS).astype(np.uint8) & 1
            parity = np.packbits(odd, bitorder="little").view(np.int64)
            steps = np.arange(0, (b.num_rows + 1) * WORDS, WORDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(n), pa.ListArray.from_arrays(steps, pa.array(parity)),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(s.view(np.int64)))],
                ["node", "n", "parity", "tokens"])
    return run


def _frequent(scan: DataFrame):
    """Broadcast (sorted tokens, levels) of the frequent tokens; the number of texts."""
    total, texts = scan.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    least = max(8, -(-total // FREQUENT_SHARE))
    rows = (scan.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
            .where(F.col("seen") >= least).collect())
    rows = sorted((r["token"] % (1 << 64), r["seen"]) for r in rows)
    tokens = np.array([t for t, _ in rows], np.uint64)
    seen = np.array([c for _, c in rows], np.float64)
    levels = 1 + np.floor(np.log2(np.maximum(seen / least, 1))).astype(np.int64)
    return scan.sparkSession.sparkContext.broadcast((tokens, levels)), texts


def _least_shared() -> F.Column:
    return F.greatest(F.lit(1), F.floor(F.pow(F.lit(2), F.col("bucket") - 4)))


def _few_pairs(members: DataFrame) -> DataFrame:
    """Pairs of unconnected classes in signatures of up to ``SMALL`` classes, which are
    joined with themselves, at most ``SMALL`` rows for each."""
    x = members.where(F.col("size") <= SMALL)
    y = x.select("sig", F.col("node").alias("b"), F.col("comp").alias("other"))
    few = x.join(y, "sig").where((F.col("node") < F.col("b")) & (F.col("comp") != F.col("other")))
    return few.select(F.col("node").alias("a"), "b")


def _block_pairs(members: DataFrame, sets: DataFrame, num: int, den: int, step: str):
    """Pairs of unconnected classes in signatures of more than ``SMALL`` classes, from
    ``members(sig, size, node, comp)``. The classes are packed into blocks; a task
    compares the sizes and parities of two blocks (``same``: of one with itself,
    ``cross``: of different ones, ``all``: both). The first two steps return no more
    pairs than connect what may link, fewer than classes; the last returns the rest.
    Also returns the stored tables that the pairs are made of."""
    blocks = F.ceil(F.col("size") / F.lit(BLOCK))
    big = (members.where(F.col("size") > SMALL)
           .withColumn("block", F.pmod(F.xxhash64("node"), blocks))
           .join(sets.select("node", "n", "parity"), "node")
           .groupBy("sig", "block").agg(F.collect_list(
               F.struct("node", "comp", "n", "parity")).alias("x")))
    made = []
    if step == "same":
        both = big.select(F.lit(True).alias("same"), "x", F.col("x").alias("y"))
    else:
        big = stored(in_few_tasks(big, members.count(), SETS_A_TASK), "ngram-blocks")
        made = [big]
        two = big.select("sig", F.col("block").alias("block2"), F.col("x").alias("y"))
        both = big.join(two, "sig").where("block < block2" if step == "cross" else "block <= block2")
        both = both.select((F.col("block") == F.col("block2")).alias("same"), "x", "y")
    return both.mapInArrow(_compare(num, den, step != "all"), "a bigint, b bigint"), made


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Marks pairs that connect what all of them connect, and no more."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep[k] = True
    return keep


def _compare(num: int, den: int, forest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(block):
            parity = np.asarray(pc.list_flatten(block.field("parity"))).view(np.uint64)
            return (*(np.asarray(block.field(c)) for c in ("node", "comp", "n")),
                    parity.reshape(-1, WORDS))

        for batch in batches:
            for i in range(batch.num_rows):
                node, comp, n, odd = columns(batch.column("x")[i].values)
                node2, comp2, n2, odd2 = columns(batch.column("y")[i].values)
                differ = np.zeros((len(node), len(node2)), np.int64)
                for k in range(WORDS):
                    differ += np.bitwise_count(odd[:, k, None] ^ odd2[None, :, k])
                total = n[:, None] + n2[None, :]
                near = ((comp[:, None] != comp2[None, :])
                        & (den * np.minimum(n[:, None], n2) >= num * np.maximum(n[:, None], n2))
                        & ((total - differ) * den >= (total + differ) * num))
                if batch.column("same")[i].as_py():
                    near &= node[:, None] < node2[None, :]
                a, b = np.nonzero(near)
                if forest:
                    keep = _forest(comp[a], comp2[b])
                    a, b = a[keep], b[keep]
                a, b = node[a], node2[b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
    return run


def _near(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that their parities do not exclude. Every token of one set only turns
    one class, so the classes that differ are at most the tokens that differ."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda s, x: s + x)
    total = F.col("na") + F.col("nb")
    return (pairs.join(one, "a").join(two, "b")
            .where(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
            .withColumn("differ", differ)
            .where((total - F.col("differ")) * den >= (total + F.col("differ")) * num)
            .select("a", "b"))


def _verified(pairs: DataFrame, count: int, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``count`` pairs that link, by their full sets."""
    if 2 * count <= FEW:  # else every set is shuffled, needed or not
        ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = sets.join(F.broadcast(ids), "node", "left_semi")
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("bigint")
    union = F.size("x") + F.size("y") - F.col("both")
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .where(F.col("both") * den >= union * num).select("a", "b"))


def _in_components(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    """``members`` with the component ``comp`` of each node, at first itself."""
    if comps is None:
        return members.withColumn("comp", F.col("node"))
    return members.join(comps, F.col("node") == comps["id"], "left").select(
        *members.columns, F.coalesce("root", "node").alias("comp"))


def _linked(post: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame | None:
    """``(id, root)`` of the classes of ``post(sig, node)`` that link, None if no two share a
    signature; ``post`` is removed. Components only grow: a signature whose classes are
    in one is left out of the later rounds. Stars are for signatures of many classes;
    those of few are all tried once, in the step behind the stars."""
    size = post.count()
    comps = before = few = None
    step, waits = "star", False  # waits: those of few classes are still to be tried
    for r in range(STARS + len(_STEPS) + 1):
        members = stored(in_few_tasks(_in_components(post.select("sig", "node"), comps), size),
                         "ngram-members")
        if not waits or post._stored_at != few._stored_at:
            discard(post)
        parts = members.groupBy("sig", "comp").agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by("node", F.xxhash64("node", F.lit(r))).alias("lead"))
        open_sigs = parts.groupBy("sig").agg(
            F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("nn"),
            F.max_by(F.struct("lead", "comp"), F.struct("n", "comp")).alias("best"),
            F.count(F.lit(1)).alias("comps"))
        open_sigs = stored(in_few_tasks(open_sigs.where(
            (F.col("comps") > 1) & (F.col("size") > (SMALL if r else 0))), size), "ngram-open")
        free = (F.col("size") * F.col("size") - F.col("nn")) / 2
        left, some = open_sigs.agg(F.coalesce(F.sum(F.when(F.col("size") > SMALL, free)), F.lit(0)),
                                   F.count(F.lit(1))).first()
        if not some and not waits:
            discard(members, open_sigs)
            break
        if step != "star":
            step = _STEPS[_STEPS.index(step) + 1]
        elif not left or r and (r >= STARS or left <= 4 * size
                                or before is not None and 2 * left > before):
            step = "same"
        before, used = left, [members, open_sigs]
        x = members.join(open_sigs.select("sig", "size", *(["best"] if step == "star" else [])), "sig")
        x = stored(in_few_tasks(x, size), "ngram-open-members")
        if step == "star":
            if not r:
                few, waits = x, True
            cand = x.where((F.col("size") > SMALL) & (F.col("comp") != F.col("best.comp")))
            pairs = cand.select(F.least("node", "best.lead").alias("a"),
                                F.greatest("node", "best.lead").alias("b"))
        else:
            pairs, made = _block_pairs(x, sets, num, den, step)
            used += made
            if waits:
                tried = _in_components(few.where(F.col("size") <= SMALL)
                                       .select("sig", "node", "size"), comps)
                tried = stored(in_few_tasks(tried, size), "ngram-few-members")
                used += [tried, few]
                pairs, waits = pairs.unionByName(_few_pairs(tried)), False
            elif step == "same":
                pairs = pairs.unionByName(_few_pairs(x))
        pairs = stored(in_few_tasks(pairs.distinct(), size), "ngram-pairs")
        count = pairs.count()
        near = stored(in_few_tasks(_near(pairs, sets, num, den), count), "ngram-near")
        count = near.count()
        found = stored(in_few_tasks(_verified(near, count, sets, num, den), count, SETS_A_TASK),
                       "ngram-links")
        discard(*used, pairs, near)
        if comps is None:
            comps = stored(connected_components(found, count), "ngram-comps")
        elif found.count():
            links = found.unionByName(comps.select(F.col("id").alias("a"), F.col("root").alias("b")))
            comps = stored(connected_components(links, links.count()), "ngram-comps")
        if step == _STEPS[-1]:
            discard(x)
            break
        post = x.where(F.col("size") > SMALL)
        post._stored_at = x._stored_at
    return comps


def similar_documents(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs(doc_id, text)``. The
    least similarity ``num / den`` is at least one half: the index looks for a set's
    partners in its own size bucket and the one below."""
    return _components(docs, size, num, den).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """:func:`similar_documents` with the row's set (``node``) and its component as one
    of its sets (``cluster``)."""
    if not 2 * num >= den >= num > 0:
        raise ValueError("the least similarity must be from one half to one")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scan = stored(docs.mapInArrow(
        _scan(size), "doc_id bigint, n bigint, node bigint, token bigint, seen bigint"),
        "ngram-scan")
    rows = scan.where("n IS NOT NULL").select("doc_id", "n", "node")
    frequent, texts = _frequent(scan)
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first"))
    classes = stored(in_few_tasks(classes, texts), "ngram-classes")
    index = stored(docs.where("doc_id IS NOT NULL")
                   .mapInArrow(_index(size, num, den, frequent), "sig bigint, node bigint, bucket int"),
                   "ngram-index")
    shared = (index.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
              .where("lo <> hi").select("sig"))
    entries = index.count()
    shared = stored(in_few_tasks(shared, entries), "ngram-shared")
    common = post = stored(in_few_tasks(index.join(shared, "sig").distinct(), entries),
                           "ngram-shared-index")
    discard(index, shared)
    strong = post.groupBy("node", "bucket").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= _least_shared())
    entries = post.count()
    strong = stored(in_few_tasks(strong.select("node", "bucket", "n"), entries), "ngram-strong")
    # Of the signatures that a set shares, the least_shared - 1 most frequent may
    # go: the rarest one that two linked sets have in common stays in both.
    sizes = post.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    sizes = stored(in_few_tasks(sizes, entries), "ngram-sizes")
    rarest = Window.partitionBy("node", "bucket").orderBy("size", "sig")
    post = (post.join(strong, ["node", "bucket"]).join(sizes, "sig")
            .withColumn("place", F.row_number().over(rarest))
            .where(F.col("place") <= F.col("n") - _least_shared() + 1))
    post = stored(in_few_tasks(post.select("sig", "node"), entries), "ngram-post")
    discard(common, strong, sizes)
    needed = post.select("node").distinct().join(classes, "node")
    needed = stored(in_few_tasks(needed, texts), "ngram-needed")
    ids = needed.select(F.col("first").alias("doc_id")).distinct()
    if (count := needed.count()) <= FEW:  # at most 8 bytes each; beyond it the join shuffles the texts
        ids = F.broadcast(ids)
    sets = (docs.join(ids, "doc_id", "left_semi")
            .mapInArrow(_whole_sets(size), "node bigint, n bigint, "
                        "parity array<bigint>, tokens array<bigint>"))
    sets = sets.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = stored(in_few_tasks(sets, count, SETS_A_TASK), "ngram-sets")
    comps = _linked(post, sets, num, den)
    if comps is None:  # no two sets share a signature
        named = classes.select("node", F.col("first").alias("component_id"),
                               F.col("node").alias("cluster"))
    else:
        ids = comps.withColumnRenamed("id", "node").join(classes, "node")
        ids = stored(in_few_tasks(ids, texts), "ngram-ids")
        low = ids.groupBy("root").agg(F.min("first").alias("low"))
        low = stored(in_few_tasks(low, texts), "ngram-low")
        low = ids.join(low, "root").select("node", "low", "root")
        named = classes.join(low, "node", "left").select(
            "node", F.coalesce("low", "first").alias("component_id"),
            F.coalesce("root", "node").alias("cluster"))
    named = stored(in_few_tasks(named.withColumnRenamed("node", "class"), texts), "ngram-named")
    discard(needed, sets, classes)
    # Rows without a set or an id stand alone.
    linked = (F.col("node") == F.col("class")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return rows.join(named, linked, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "node",
        F.coalesce("cluster", "node").alias("cluster"))


def _with_node(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` with the hash of each row's set as ``node`` (columns by place)."""
    names = [f"k{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text):
            node = _sets(b.select([text]).rename_columns(["text"]), size)[3]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(node)], [*names, "node"])

    schema = ", ".join(f"{n} {f.dataType.simpleString()}"
                       for n, f in zip(names, docs.schema.fields, strict=True))
    return docs.toDF(*names).mapInArrow(run, f"{schema}, node bigint")


def first_of_each(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of ``docs`` per component: one with the smallest doc_id. Rows with a
    null doc_id are all kept. Where a doc_id stands on several rows, they are told
    apart by their sets: each component that has it as its smallest keeps a row."""
    rows = stored(_components(docs, size, num, den).where("doc_id IS NOT NULL"), "ngram-rows")
    keep = (rows.where("doc_id = component_id").groupBy("doc_id", "cluster")
            .agg(F.min("node").alias("node")).select("doc_id", "node"))
    twice = stored(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("doc_id"), "ngram-twice")
    keep = stored(keep, "ngram-keep")
    plain = docs.where("doc_id IS NULL").unionByName(docs.join(
        keep.join(twice, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi")
        .select(*docs.columns))
    again = _with_node(docs.join(twice, "doc_id", "left_semi").select(*docs.columns), size)
    key = f"k{docs.columns.index('doc_id')}"
    again = (again.join(keep.select(F.col("doc_id").alias(key), "node"), [key, "node"], "left_semi")
             .dropDuplicates([key, "node"]))
    places = [F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)]
    return plain.unionByName(again.select(*places))
