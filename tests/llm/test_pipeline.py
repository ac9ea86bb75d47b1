"""The pipeline stage by stage against plain Python, and the SQL oracles."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from rivulet.llm import quality, queries
from tests.conftest import SF_SMALL
from tests.llm.test_native import brute_mix
from tests.llm.test_text_joins import brute
from tests.test_queries import _canon, duck  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, duck, name):  # noqa: F811
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert got == _canon(names, res.fetchall())


def test_every_operator_is_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


def stages(spark, docs, root):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = f"{root}/{len(out)}"
        stage(spark, out[-1], SF_SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_match_brute_force(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first, kept, alone, clean, mixed, sharded = stages(spark, docs, tmp_dir)
    for df in (kept, alone, clean, mixed):
        assert sorted(df.columns) == sorted(docs.columns)

    model = quality.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"),
                          quality.remainder(5) != 0)

    def good(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return quality.predict(model, quality.features(raw, np.array([0, len(raw)])))[0] >= 0.3

    rows = {r["doc_id"]: r for r in first.collect()}
    want = {i for i, r in rows.items() if good(r["text"])}
    assert {r["doc_id"] for r in kept.collect()} == want and len(want) < len(rows)

    classes = brute([(i, rows[i]["text"]) for i in want], 5, 80, 100)
    want = {i for i, _, c in classes if i == c}
    assert {r["doc_id"] for r in alone.collect()} == want

    def words(t):
        return re.findall(r"[^\W_]+", t.lower())

    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    runs = {tuple(w[k:k + 4]) for w in items for k in range(len(w) - 3)}
    left = {r["doc_id"] for r in clean.collect()}
    for i in want:
        w = words(rows[i]["text"])
        if any(f" {' '.join(x)} " in f" {' '.join(w)} " for x in items):
            assert i not in left
        elif not any(tuple(w[k:k + 4]) in runs for k in range(len(w) - 3)):
            assert i in left

    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert set(copies) == left
    expected, _ = brute_mix([(i, rows[i]["text"], rows[i]["source"]) for i in left], 2.0)
    plain = Counter(i for i, _ in expected)
    # Each source's last document may differ: the brute force scans for the exponent.
    assert sum(((copies - plain) + (plain - copies)).values()) <= 2 * len(
        {rows[i]["source"] for i in left})

    got = sharded.collect()
    assert Counter(r["doc_id"] for r in got) == copies
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)
    assert all(r["text_crc32"] == zlib.crc32(rows[r["doc_id"]]["text"].encode()) for r in got)
    assert sorted(map(str, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(str, got))


def test_pipeline_edge_cases(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = [(None, None, None, None, None), (9001, None, "en", "src1", 0), (9002, "", None, None, 0),
           (9003, "Only one.", "en", "src1", 9), (9003, "Only one.", "en", "src1", 9)]
    more = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    assert stages(spark, more, tmp_dir)[-1].count() > 0
    assert stages(spark, docs.limit(0), f"{tmp_dir}/none")[-1].count() == 0
