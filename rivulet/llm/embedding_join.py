"""Near-duplicate embeddings by an epsilon grid order join.

Vectors are scaled to unit length, so a cosine of at least ``least`` means a
distance of at most ``eps = sqrt(2 - 2 * least)``. They are projected on the
leading principal directions of all vectors (second moments summed over all
rows, at most dims**2 numbers), put into grid cells of side ``eps`` there and
sorted by label and cell, the epsilon grid order. The sorted sequence is cut
into blocks of ``BLOCK`` vectors, each with its bounding box. Projection never
lengthens a distance, so two blocks whose boxes are more than ``eps`` apart
hold no link; the others are joined block by block, splitting both intervals
in halves recursively and skipping distant halves, down to ``LEAF`` vectors,
whose cosines are computed in double precision.

Equal vectors of one label are one class that is joined once, with its number
of copies. A block pair gives the number of links of each vector and a
spanning forest of its links, so its output is linear in the block. Block
pairs are matched on label and first grid cell, never across labels.

Defined cases: a null label or vector, a zero vector, and null or non-finite
components link with nothing; vectors of another length never equal or link
(each length is joined apart); repeated rows count as vectors of their own; a null
vec_id counts as a link of others, has a null component and is not kept; an
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import connected_components, stored

BLOCK, LEAF, AXES = 1024, 64, 4


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(pc.list_flatten(col), np.float64).reshape(-1, dims)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed outer products of the unit vectors, one row per vector length."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        sizes = np.asarray(pc.list_value_length(b.column("v")))
        for dims in np.unique(sizes):
            x = _matrix(b.column("v").filter(pa.array(sizes == dims)), int(dims))
            x = x / np.sqrt((x * x).sum(1))[:, None]
            sums[int(dims)] = sums.get(int(dims), 0) + x.T @ x
    for dims, m in sums.items():
        at = np.arange(dims * dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dims * dims, dims)), pa.array(at), pa.array(m.ravel())],
            ["dims", "at", "sum"])


def _cells(axes, eps: float):
    """Adds the grid cells ``c0 ..`` of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros((b.num_rows, AXES), np.int64)
            sizes = np.asarray(pc.list_value_length(b.column("v")))
            for dims in np.unique(sizes):
                rows = sizes == dims
                x = _matrix(b.column("v").filter(pa.array(rows)), int(dims))
                p = (x / np.sqrt((x * x).sum(1))[:, None]) @ axes.value[int(dims)]
                out[rows, :p.shape[1]] = np.floor(p / eps).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(out[:, k]) for k in range(AXES)]],
                [*b.schema.names, *[f"c{k}" for k in range(AXES)]])
    return run


def _blocks(axes):
    """Blocks of one label and length, in grid order, with their boxes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: pa.Table) -> pa.RecordBatch:
            dims = len(rows["v"][0])
            x = _matrix(rows["v"].combine_chunks(), dims)
            p = (x / np.sqrt((x * x).sum(1))[:, None]) @ axes.value[dims]
            first = np.asarray(rows["c0"])
            ids, n = np.asarray(rows["id"]), np.asarray(rows["n"])
            return pa.RecordBatch.from_pydict({
                "label": [rows["label"][0].as_py()], "dims": [dims], "block": [int(ids[0])],
                "low": [p.min(0).tolist()], "high": [p.max(0).tolist()],
                "from": [int(first.min())], "to": [int(first.max())],
                "ids": [ids.tobytes()], "copies": [n.astype(np.int64).tobytes()],
                "vectors": [x.tobytes()]}, schema=schema)

        schema = pa.schema([
            ("label", pa.int64()), ("dims", pa.int64()), ("block", pa.int64()),
            ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
            ("from", pa.int64()), ("to", pa.int64()),
            ("ids", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary())])
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            label = np.asarray(held["label"])
            dims = np.asarray(held["dims"])
            edge = np.flatnonzero((label[1:] != label[:-1]) | (dims[1:] != dims[:-1])) + 1
            begin = 0
            for end in [*edge, len(label)]:
                while end - begin >= BLOCK or (end < len(label) and end > begin):
                    size = min(BLOCK, end - begin)
                    yield block(held.slice(begin, size))
                    begin += size
            held = held.slice(begin).combine_chunks()
        if held is not None and held.num_rows:
            yield block(held)
    return run


def _join_blocks(axes, least: float, eps: float):
    """Per block pair: link counts per class and a spanning forest of the links.

    ``a, b`` is a link of the forest; or ``b`` is null and ``links`` is the
    number of vectors linked with class ``a`` through this block pair.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = (eps * (1 + 1e-9)) ** 2

        def load(b, i, side):
            dims = b.column("dims")[i].as_py()
            x = np.frombuffer(b.column(f"vectors{side}")[i].as_py(), np.float64)
            x = x.reshape(-1, dims)
            norm = np.sqrt((x * x).sum(1))
            u = x / norm[:, None]
            return (np.frombuffer(b.column(f"ids{side}")[i].as_py(), np.int64),
                    np.frombuffer(b.column(f"copies{side}")[i].as_py(), np.int64),
                    x, norm, u, u @ axes.value[dims])

        for batch in batches:
            for i in range(batch.num_rows):
                ids, copies, x, nx, u, p = load(batch, i, "")
                ids2, copies2, y, ny, v, q = load(batch, i, "2")
                self_join = ids[0] == ids2[0]
                links, links2 = np.zeros(len(ids), np.int64), np.zeros(len(ids2), np.int64)
                parent = np.arange(len(ids) + (0 if self_join else len(ids2)))
                shift = 0 if self_join else len(ids)
                forest = []

                def root(k):
                    while parent[k] != k:
                        parent[k] = parent[parent[k]]
                        k = parent[k]
                    return k

                todo = [(0, len(ids), 0, len(ids2))]
                while todo:
                    a, b, c, d = todo.pop()
                    if self_join and c < a:  # the mirrored pair of intervals
                        continue
                    gap = np.maximum(0, np.maximum(p[a:b].min(0) - q[c:d].max(0),
                                                   q[c:d].min(0) - p[a:b].max(0)))
                    if (gap * gap).sum() > far:
                        continue
                    if b - a > LEAF or d - c > LEAF:
                        m, o = (a + b) // 2 if b - a > LEAF else b, (c + d) // 2 \
                            if d - c > LEAF else d
                        for s in {(a, m), (m, b)}:
                            for t in {(c, o), (o, d)}:
                                if s[0] < s[1] and t[0] < t[1]:
                                    todo.append((*s, *t))
                        continue
                    cos = u[a:b] @ v[c:d].T
                    hit = cos >= least - 1e-9
                    for k, m in np.argwhere(hit & (cos < least + 1e-9)):
                        hit[k, m] = math.fsum(x[a + k] * y[c + m]) / (
                            nx[a + k] * ny[c + m]) >= least
                    if self_join and a == c:
                        hit = np.triu(hit, 1)
                    if not hit.any():
                        continue
                    links[a:b] += hit @ copies2[c:d]
                    links2[c:d] += copies[a:b] @ hit
                    for k, m in np.argwhere(hit):
                        s, t = root(a + k), root(shift + c + m)
                        if s != t:
                            parent[max(s, t)] = min(s, t)
                            forest.append((ids[a + k], ids2[c + m]))
                if self_join:
                    links, links2 = links + links2, links2[:0]
                if not forest:
                    continue
                f = np.array(forest, np.int64)
                one, two = links > 0, links2 > 0
                who = np.concatenate([ids[one], ids2[:len(links2)][two]])
                count = np.concatenate([links[one], links2[two]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([f[:, 0], who])),
                     pa.array(np.concatenate([f[:, 1], np.zeros(len(who), np.int64)]),
                              mask=np.arange(len(f) + len(who)) >= len(f)),
                     pa.array(np.concatenate([np.zeros(len(f), np.int64), count]))],
                    ["a", "b", "links"])
    return run


def near_embeddings(vectors: DataFrame, least: float = 0.98, vector: str = "embedding",
                    key: str = "vec_id", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``."""
    spark = vectors.sparkSession
    eps = math.sqrt(2 - 2 * least)
    v = F.col(vector).cast("array<double>")
    good = (F.col(label).isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
            & F.exists(v, lambda c: c != 0))
    # One class per (label, vector); -0.0 and 0.0 are one value.
    same = F.transform(v, lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c))
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"),
                          F.col(label).cast("bigint").alias("label"), same.alias("v"),
                          F.coalesce(good, F.lit(False)).alias("good"))
    rows = stored(rows.select(
        "vec_id", "good", "label", F.when(F.col("good"), F.col("v")).alias("v"),
        F.when(F.col("good"), F.xxhash64("label", "v")).alias("id")), "vec-rows")
    classes = rows.where("good").groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"),
        F.first("label").alias("label"), F.first("v").alias("v"))
    classes = stored(classes.withColumn("dims", F.size("v").cast("bigint")), "vec-classes")

    moments = classes.select("v").mapInArrow(_moments, "dims bigint, at bigint, sum double")
    axes: dict[int, np.ndarray] = {}
    sums: dict[int, np.ndarray] = {}
    for r in moments.groupBy("dims", "at").agg(F.sum("sum").alias("sum")).collect():
        sums.setdefault(r["dims"], np.zeros(r["dims"] ** 2))[r["at"]] = r["sum"]
    for dims, m in sums.items():
        axes[dims] = np.linalg.eigh(m.reshape(dims, dims))[1][:, ::-1][:, :AXES].copy()
    shared = spark.sparkContext.broadcast(axes)

    grid = [f"c{k}" for k in range(AXES)]
    schema = ("id bigint, n bigint, label bigint, dims bigint, v array<double>, "
              + ", ".join(f"{c} bigint" for c in grid))
    cells = classes.select("id", "n", "label", "dims", "v").mapInArrow(_cells(shared, eps), schema)
    order = ["label", "dims", *grid, "id"]
    blocks = stored(
        cells.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _blocks(shared), "label bigint, dims bigint, block bigint, low array<double>, "
            "high array<double>, from bigint, to bigint, ids binary, copies binary, "
            "vectors binary"), "vec-blocks")
    box = blocks.select("label", "dims", "block", "low", "high", "from", "to")
    left = box.withColumn("cell", F.explode(F.expr("sequence(`from` - 1, `to` + 1)")))
    right = box.select("label", "dims", F.col("block").alias("block2"), F.col("low").alias("low2"),
                       F.col("high").alias("high2"),
                       F.explode(F.expr("sequence(`from`, `to`)")).alias("cell"))
    gap = F.aggregate(
        F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("low2", "high2"),
                   lambda p, q: F.pow(F.greatest(F.lit(0.0), p["low"] - q["high2"],
                                                 q["low2"] - p["high"]), 2)),
        F.lit(0.0), lambda s, d: s + d)
    pairs = (left.join(right, ["label", "dims", "cell"])
             .where((F.col("block") <= F.col("block2")) & (gap <= (eps * (1 + 1e-9)) ** 2))
             .select("dims", "block", "block2").distinct())
    one = blocks.select("block", "ids", "copies", "vectors")
    two = blocks.select(F.col("block").alias("block2"), F.col("ids").alias("ids2"),
                        F.col("copies").alias("copies2"), F.col("vectors").alias("vectors2"))
    joined = pairs.join(one, "block").join(two, "block2").select(
        "dims", "ids", "copies", "vectors", "ids2", "copies2", "vectors2")
    found = stored(joined.mapInArrow(_join_blocks(shared, least, eps),
                                     "a bigint, b bigint, links bigint"), "vec-found")

    counts = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(
        F.sum("links").alias("links"))
    comps = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    ids = stored(comps.join(classes.select("id", "first"), "id"), "vec-ids")
    low = stored(ids.groupBy("root").agg(F.min("first").alias("low")), "vec-low")
    named = classes.select("id", "n", "first").join(counts, "id", "left").join(
        ids.join(low, "root").select("id", "low"), "id", "left")
    named = stored(named.select(
        F.col("id").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1)
        .alias("n_links"), F.coalesce("low", "first").alias("component_id")), "vec-named")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return rows.join(named, rows["id"] == named["class"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
