"""Sharding and mixing against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from rivulet.llm import mixing, sharding

SCHEMA = "doc_id long, text string, source string, slot string, atom int, target int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def smallest_capacity(sizes, shards):
    """Brute force: the least maximum over all contiguous partitions."""
    best = sum(sizes)
    for cuts in itertools.combinations_with_replacement(range(len(sizes) + 1), shards - 1):
        edges = [0, *cuts, len(sizes)]
        best = min(best, max(sum(sizes[a:b]) for a, b in itertools.pairwise(edges)))
    return best


@pytest.mark.parametrize("seed", range(3))
def test_shards_are_minimax(spark, seed):
    texts = [f"{seed}-{k}" * (1 + (k * 7919 + seed) % 23) for k in range(11)]
    texts += [texts[0]] * 6 + [texts[3]] * 2
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    got = sharding.op2_shards(frame(spark, rows), 4).collect()
    atoms = defaultdict(int)
    for t in texts:
        atoms[zlib.crc32(t.encode()) >> 16] += len(t) + 16
    loads = Counter()
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]]) + 16
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        loads[r["shard"]] += r["size"]
    mean = sum(atoms.values()) / 4
    order = sorted(atoms, key=lambda a: (-atoms[a] if atoms[a] >= mean else 0, a))
    assert max(loads.values()) == smallest_capacity([atoms[a] for a in order], 4)
    of_text = defaultdict(set)
    slots = defaultdict(list)
    for r in got:
        of_text[texts[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shard_sizes_are_near_equal_beside_a_large_group(spark):
    rows = [(k, "copy" * 20, "s") for k in range(400)] + [
        (k, f"text {k} " * (5 + k % 9), "s") for k in range(400, 3000)]
    got = sharding.op2_shards(frame(spark, rows), 10).collect()
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    mean = sum(loads.values()) / 10
    assert len(loads) == 10 and max(loads.values()) < 1.3 * mean and min(
        loads.values()) > 0.93 * mean


def test_shard_edge_cases(spark):
    rows = [(1, None, "s"), (2, "", "s"), (None, "é", "s"), (None, "é", "s"), (4, "x" * 300000, "s"),
            (4, "x" * 300000, "s")]
    got = sharding.op2_shards(frame(spark, rows), 40).collect()
    assert sorted(r["size"] for r in got) == [16, 16, 18, 18, 300016, 300016]
    assert {r["text_crc32"] for r in got if r["size"] == 16} == {0}
    assert len({(r["shard"], r["slot"]) for r in got}) == 6
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    assert sharding.op2_shards(frame(spark, []), 40).count() == 0


def brute_mix(rows, repeats, budget=None, entropy=None, seed="mix"):
    """Copies (doc_id, epoch) by plain Python, the exponent found by scanning."""
    n = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    total = defaultdict(int)
    for i, _, s in rows:
        total[s] += n[i]
    real = {s: t for s, t in total.items() if t}
    top = max(real.values())

    def weights(a):
        z = sum((t / top) ** a for t in real.values())
        return {s: (t / top) ** a / z for s, t in real.items()}

    def times(a):
        w = weights(a)
        b = budget if budget else max(t / w[s] for s, t in real.items())
        return max(b * w[s] / t for s, t in real.items())

    def h(a):
        return -sum(x * math.log(x) for x in weights(a).values())

    a = 1.0 if entropy is not None or repeats is None else 0.0
    grid = [k / 200000 for k in range(200001)]
    if entropy is not None:
        a = max([x for x in grid if h(x) >= entropy], default=0.0)
    if repeats is not None:
        a = max(a, min([x for x in grid if times(x) <= repeats], default=1.0))
    w = weights(a)
    b = budget if budget else max(t / w[s] for s, t in real.items())
    out = Counter()
    for s, t in total.items():
        docs = [i for i, _, x in rows if x == s]
        if not t:
            out.update((i, 0) for i in docs)
            continue
        target, upto, epoch = b * w[s], 0, 0
        while upto <= target + 1:
            order = sorted(docs, key=lambda i, e=epoch: hashlib.md5(
                f"{seed}:{e}:{i}".encode()).hexdigest())
            for i in order:
                upto += n[i]
                if upto <= round(target) + 2:  # the grid's exponent is coarse
                    out[(i, epoch)] += 1
            epoch += 1
    return out, {s: b * w[s] for s in w}


ROWS = [(k, "w " * (3 + k * 31 % 17), s) for k, s in enumerate(
    ["a"] * 70 + ["b"] * 12 + ["c"] * 25 + [None] * 9)]


@pytest.mark.parametrize("kind", [{"max_repeats": 2.0}, {"max_repeats": 3.5},
                                  {"max_repeats": None, "target_entropy": 1.25},
                                  {"max_repeats": 1.5, "budget_tokens": 500}])
def test_mixture_matches_brute_force(spark, kind):
    got = mixing.mix(frame(spark, ROWS), block_tokens=200, **kind).collect()
    want, targets = brute_mix(ROWS, kind.get("max_repeats"), kind.get("budget_tokens"),
                              kind.get("target_entropy"))
    mine = Counter((r["doc_id"], r["epoch"]) for r in got)
    assert max(mine.values()) == 1
    # The last document of a source may differ: the scanned exponent is coarse.
    assert sum(((mine - want) + (want - mine)).values()) <= 4
    tokens = Counter()
    for r in got:
        tokens[r["source"]] += r["n_tokens"]
    for s, t in targets.items():
        assert t - 20 <= tokens[s] <= t + 1
    slots = defaultdict(list)
    for r in got:
        slots[r["block"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    whole = mixing.mix_documents(frame(spark, ROWS), **kind)
    assert whole.columns == frame(spark, []).columns
    assert Counter(r["doc_id"] for r in whole.collect()) == Counter(r["doc_id"] for r in got)


def test_no_document_is_left_out_without_a_budget(spark):
    got = mixing.mix(frame(spark, ROWS), max_repeats=2.0)
    assert {r["doc_id"] for r in got.collect()} == {i for i, _, _ in ROWS}


def test_blocks_have_each_sources_share(spark):
    rows = [(k, "w " * 10, "a" if k % 4 else "b") for k in range(4000)]
    got = mixing.mix(frame(spark, rows), max_repeats=2.0, block_tokens=5000).collect()
    share = defaultdict(Counter)
    for r in got:
        share[r["block"]][r["source"]] += r["n_tokens"]
    whole = Counter(r["source"] for r in got)
    for c in share.values():
        assert abs(c["a"] / sum(c.values()) - whole["a"] / len(got)) < 0.03


def test_mix_edge_cases(spark):
    rows = [(1, None, "e"), (2, "", "e"), (3, "x y", None), (None, "z", "s"), (None, "z", "s"),
            (4, "w " * 50000, "s"), (5, "q", "s"), (5, "q", "s")]
    got = Counter(r["doc_id"] for r in mixing.mix(frame(spark, rows), max_repeats=1.0).collect())
    assert got[1] == got[2] == got[4] == 1 and got[5] == 2 and got[None] == 2
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix_documents(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, rows[:2])).count() == 2
