"""Tokenizer alignment against plain Python over token byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from rivulet.llm import token_align

TEXTS = [
    "The quick brown fox, it's 1234567 times!", "", None, " ", "  two  spaces \n\n\t x", "naïve Ünïcødé 漢字 🙂",
    "piece ▁ marker", "<|endoftext|> and <s> </s> <0x41> <unk>", "a\x00b", "'s 'll don't we've", "aaaa" * 400,
    "The quick brown fox, it's 1234567 times!", "\r\n", "x", "The fox " * 300, "  　 \x1c y",
]


@pytest.fixture(scope="module")
def libraries():
    """The two libraries as a user would call them, without the operator's code."""
    import os

    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(os.path.join(token_align.TOKENIZER_DIR, token_align.BYTE_LEVEL))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(
        model_file=os.path.join(token_align.TOKENIZER_DIR, token_align.PIECES))
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet, n = {chr(k): k for k in keep}, 256
    for k in range(256):
        if k not in keep:
            alphabet[chr(n)] = k
            n += 1

    def tokens(text):
        enc = a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i)
                          else piece.replace("▁", " ").encode()))
        return left, right

    return tokens


def brute(libraries, texts):
    """Union-find over overlapping ranges; links counted by comparing ranges."""
    docs, corpus = [], Counter()
    for text in texts:
        left, right = libraries(text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or any(b"".join(t for _, t in s) != want for s in (left, right)):
            docs.append((0, 0, [], []))
            continue
        spans = []
        for side, toks in enumerate((left, right)):
            at = 0
            for i, t in toks:
                spans.append((side, i, at, at + len(t)))
                at += len(t)
        parent = list(range(len(spans)))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        links = []
        n = len(left)
        for x in range(n):
            for y in range(n, len(spans)):
                if spans[x][2] < spans[y][3] and spans[y][2] < spans[x][3]:
                    links.append((spans[x][1], spans[y][1]))
                    parent[root(y)] = root(x)
        groups = defaultdict(lambda: ([], []))
        for x, s in enumerate(spans):
            groups[root(x)][s[0]].append(s[1])
        corpus.update(links)
        docs.append((n, len(right), list(groups.values()), links))
    best = {}
    for (_, y), c in corpus.items():
        best[y] = max(best.get(y, 0), c)
    out = []
    for n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((n_a, n_b, len(groups), len(links),
                    sum(corpus[p] == best[p[1]] for p in links), sum(corpus[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def frame(spark, texts):
    rows = [(k, t, k, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, key long, pair string")


@pytest.mark.parametrize(("common", "chars"), [(1 << 20, 1 << 19), (4, 64), (50, 7)])
def test_agreement_matches_brute_force(spark, libraries, common, chars):
    got = token_align.agreement(frame(spark, TEXTS).repartition(3), common_pairs=common,
                                block_chars=chars).collect()
    want = brute(libraries, TEXTS)
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == dict(enumerate(want))


def test_groups_cover_equal_bytes(spark, libraries):
    got = token_align.align(frame(spark, TEXTS), block_chars=40).collect()
    want = brute(libraries, TEXTS)
    for r in got:
        w = want[r["doc_id"]]
        assert (len(r["a_ids"]), len(r["b_ids"]), len(r["group_end"])) == w[:3]
        a, b, parts = iter(r["a_ids"]), iter(r["b_ids"]), []
        for n, m in zip(r["a_per_group"], r["b_per_group"], strict=True):
            parts.append(",".join(str(next(a)) for _ in range(n)) + "|"
                         + ",".join(str(next(b)) for _ in range(m)))
        if parts:
            assert hashlib.sha256(";".join(parts).encode()).hexdigest() == w[6]
            assert r["group_end"][-1] == len((" " + TEXTS[r["doc_id"]]).encode())
            assert r["group_end"] == sorted(set(r["group_end"]))


def test_cut_texts_are_tokenized_as_whole_ones():
    both = token_align.Tokenizers(token_align.vocabulary_files())
    rng = random.Random(5)
    words = ["word", "'s", "12", "3a", "…", "ä", "\n", "  ", ".", "漢", "<|endoftext|>", "\t", "'", "é!"]
    for _ in range(60):
        text = "".join(rng.choice(words) + rng.choice(["", " ", " "]) for _ in range(80))
        cut = list(token_align.pieces(text, 11))
        assert "".join(cut) == text and len(cut) > 3
        whole = both.encode([text], [True])
        parts = both.encode(cut, [k == 0 for k in range(len(cut))])
        assert whole[0].tolist() == parts[0].tolist() and whole[2].tolist() == parts[2].tolist()


def test_pointer_jumping_reaches_the_end_of_long_chains():
    import numpy as np
    succ = np.minimum(np.arange(1, 5001), 4999)
    assert (token_align._pointer_jump(succ) == 4999).all()


def test_long_text_without_a_place_to_cut(spark):
    got = token_align.agreement(frame(spark, ["ab" * 200_000, "w " * 200_000])).collect()
    for r in got:
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] > 0


def test_empty_table_and_null_ids(spark):
    assert token_align.agreement(frame(spark, [])).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    got = sorted(map(tuple, token_align.agreement(rows).collect()), key=str)
    assert len(got) == 3 and got[1] == got[2] and got[0][1:] == (0, 0, 0, 0, 0, 0, "")
