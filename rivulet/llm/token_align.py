"""Alignment of two tokenizers over the same texts.

Both tokenizations of a text cover the same bytes. Tokens of the two sides whose
byte ranges overlap belong together; the connected components are the smallest
groups of tokens that cover equal byte ranges. They are found by pointer
jumping: every token points to the farthest-right token of the other side that
overlaps it, and the successor array is squared until every pointer stands on
its component's terminal token, which labels the group. One round serves all
documents of a block at once, and the number of rounds is the logarithm of the
longest chain.

``align`` returns the groups themselves, ``agreement`` counts and digests of
them together with how often the linked id pairs occur in the whole corpus.

Long texts are cut in front of a single space between two non-space characters.
Neither tokenizer joins anything across such a place (``Tokenizers`` checks the
vocabulary), so both end a token there, groups never cross it, and everything
is summed over the pieces: memory does not grow with the length of a text.

Texts that are null or empty, or whose joined token bytes on either side differ
from a space and the text, have no tokens: zero counts, no groups, ``''`` as
digest. Repeated rows and equal or null ids are rows of their own, an empty
table gives an empty result, and no column but ``doc_id`` and ``text`` is read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored

TOKENIZER_DIR = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Characters of a block, and the length from which a text is cut.
BLOCK_CHARS = 1 << 19
# At most so many id pairs are sent to all tasks; the others are joined.
COMMON_PAIRS = 1 << 20
# Distinct pairs that a task holds while it counts.
HELD_PAIRS = 1 << 22

# Fixed value: how byte-level vocabularies part a text before merging.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                      r"|\s+(?!\S)|\s+")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_files(folder: str = TOKENIZER_DIR, byte_level: str = BYTE_LEVEL,
                     pieces: str = PIECES) -> dict:
    """The contents of the two vocabulary files, read on the driver."""
    out = {}
    for key, name in (("byte_level", byte_level), ("pieces", pieces)):
        with open(os.path.join(folder, name), "rb") as f:
            out[key] = f.read()
    return out


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 characters as themselves
    and the other bytes, in order, as the characters from U+0100."""
    out = {chr(b): b for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
    rest = sorted(set(range(256)) - set(out.values()))
    return out | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Bytes and decimal digits of every token id, as flat arrays."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        width = len(str(self.size - 1))
        names = [str(k).encode() for k in range(self.size)]
        self.digits = np.frombuffer(b"".join(n.ljust(width, b"\0") for n in names),
                                    np.uint8).reshape(self.size, width)
        self.n_digits = np.array([len(n) for n in names], np.int64)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(length) - length), length)
        return self.flat[at + np.arange(len(at))]


class Tokenizers:
    """Side A is a byte-level BPE, side B a sentence-piece model."""

    def __init__(self, files: dict):
        import sentencepiece
        spec = json.loads(files["byte_level"])
        alphabet = _byte_alphabet()
        special = {t["content"] for t in spec.get("added_tokens", ())}
        vocab = spec["model"]["vocab"]
        by_id = {i: k.encode() if k in special else bytes(alphabet[c] for c in k)
                 for k, i in vocab.items()}
        by_id |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", ())}
        self.a = Vocabulary([by_id.get(i, b"") for i in range(max(by_id) + 1)])
        self._bpe = self._byte_level(spec, {by_id[i]: i for k, i in vocab.items()
                                            if k not in special}, files["byte_level"])
        self._pieces = p = sentencepiece.SentencePieceProcessor(model_proto=files["pieces"])
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a piece holds a space behind a character: texts cannot be cut")
        self.b = Vocabulary([
            bytes([int(n[3:5], 16)]) if p.is_byte(i) else
            b"" if p.is_control(i) or p.is_unknown(i) else n.replace("▁", " ").encode()
            for i, n in enumerate(names)])

    @staticmethod
    def _byte_level(spec: dict, ranks: dict[bytes, int], raw: bytes):
        """Encoder of one text. Where ids follow the merge order, as checked here,
        ranks alone give the same ids as the merges."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [model["vocab"]["".join(m)] for m in merges]
        plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and not spec.get("normalizer")
                 and not model.get("ignore_merges"))
        if plain and order == sorted(order) and len(ranks) == 256 + len(order):
            import tiktoken
            bpe = tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_PATTERN,
                                    mergeable_ranks=ranks, special_tokens={})
            return lambda text: bpe.encode_to_numpy(text, disallowed_special=())
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(raw.decode())
        tokenizer.encode_special_tokens = True
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[str], first: list[bool]):
        """Ids of both sides with their counts per text. The first piece of a text
        gets a space in front; later ones start with one, which side B adds itself."""
        a = [self._bpe(f" {t}" if f else t) for t, f in zip(texts, first, strict=True)]
        b = self._pieces.encode([t if f else t[1:] for t, f in zip(texts, first, strict=True)],
                                num_threads=1)
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        return (np.concatenate(a).astype(np.int64), n_a,
                np.fromiter((i for x in b for i in x), np.int64, int(n_b.sum())), n_b)


def tokenizers(files) -> Tokenizers:
    """The loaded tokenizers of broadcast file contents, once per worker."""
    contents = files.value
    if "loaded" not in contents:
        contents["loaded"] = Tokenizers(contents)
    return contents["loaded"]


def _pointer_jump(succ: np.ndarray) -> np.ndarray:
    """Terminal of every node: the successor array squared until it stands still."""
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            return succ
        succ = further


def _equal_bytes(vocab: Vocabulary, ids: np.ndarray, count: np.ndarray, data: np.ndarray,
                 size: np.ndarray) -> np.ndarray:
    """Per text: do its tokens spell its bytes?"""
    text = np.repeat(np.arange(len(count)), count)
    good = np.bincount(text, vocab.length[ids], len(count)).astype(np.int64) == size
    if good.all():
        wrong = vocab.joined(ids) != data
    else:
        data = data[np.repeat(good, size)]
        wrong = vocab.joined(ids[good[text]]) != data
    if wrong.any():
        owner = np.repeat(np.flatnonzero(good), size[good])
        good[owner[wrong]] = False
    return good


@dataclass
class Alignment:
    """Aligned texts of a block. ``a``, ``b``: token ids; ``n_a``, ``n_b``: tokens per
    text; ``group_a``, ``group_b``: group of each token (gapless over the block);
    ``link_a``, ``link_b``: token indices of every overlapping pair, left to right;
    ``end``: last byte of each group, counted over the block; ``size``: bytes per
    text (with the space in front); ``ok``: False where a text has no tokens."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    end: np.ndarray
    size: np.ndarray
    ok: np.ndarray


def align_block(both: Tokenizers, texts: list[str], first: list[bool]) -> Alignment:
    """Groups of all ``texts`` at once."""
    a, n_a, b, n_b = both.encode(texts, first)
    raw = [(f" {t}" if f else t).encode()
           for t, f in zip(texts, first, strict=True)]
    size = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    ok = (_equal_bytes(both.a, a, n_a, data, size) & _equal_bytes(both.b, b, n_b, data, size))
    if not ok.all():
        a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
        n_a, n_b, size = n_a * ok, n_b * ok, size * ok
    end_a, end_b = np.cumsum(both.a.length[a]), np.cumsum(both.b.length[b])
    mark = np.zeros(int(size.sum()) + 1, np.uint8)
    mark[end_a] = 1
    mark[end_b] |= 2
    # Between two neighbouring ends lies one link: an A and a B token share those bytes.
    ends = np.flatnonzero(mark)
    at_a, at_b = mark[ends] & 1, mark[ends] >> 1
    link_a, link_b = np.cumsum(at_a, dtype=np.int64) - at_a, np.cumsum(at_b, dtype=np.int64) - at_b
    both_end = (at_a & at_b).astype(bool)
    # Farthest-right partner of a token: the one that holds its last byte. An A token
    # that ends with its partner is terminal, the partner points to it.
    n = len(a)
    last_a, last_b = at_a.astype(bool), at_b.astype(bool)
    succ = np.concatenate([
        np.where(both_end[last_a], link_a[last_a], n + link_b[last_a]), link_a[last_b]])
    succ = _pointer_jump(succ)
    terminal = np.zeros(n, bool)
    terminal[succ] = True
    number = np.cumsum(terminal) - 1
    group = number[succ]
    return Alignment(a, b, n_a, n_b, group[:n], group[n:], link_a, link_b, end_a[terminal],
                     size, ok)


def _bounds(count: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(count)))


def group_texts(both: Tokenizers, al: Alignment) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3;`` of every text, decimal ids."""
    n_groups = len(al.end)
    per_a, per_b = np.bincount(al.group_a, minlength=n_groups), np.bincount(
        al.group_b, minlength=n_groups)
    at_a = np.arange(len(al.a)) + (np.cumsum(per_b) - per_b)[al.group_a]
    at_b = np.arange(len(al.b)) + np.cumsum(per_a)[al.group_b]
    width = max(both.a.digits.shape[1], both.b.digits.shape[1])
    out = np.zeros((len(al.a) + len(al.b), width + 1), np.uint8)
    for vocab, ids, at, group, stop in ((both.a, al.a, at_a, al.group_a, b"|"),
                                        (both.b, al.b, at_b, al.group_b, b";")):
        cells = np.zeros((len(ids), width + 1), np.uint8)
        cells[:, :vocab.digits.shape[1]] = vocab.digits[ids]
        last = np.ones(len(ids), bool)
        last[:-1] = group[1:] != group[:-1]
        cells[:, width] = np.where(last, ord(stop), ord(","))
        out[at] = cells
    flat = out.ravel()
    flat = flat[flat != 0].tobytes()
    length_a = _bounds(both.a.n_digits[al.a] + 1)[_bounds(al.n_a)]
    length_b = _bounds(both.b.n_digits[al.b] + 1)[_bounds(al.n_b)]
    cut = length_a + length_b
    return [flat[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]


def pair_counts(both: Tokenizers, al: Alignment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs of every text: ``(cuts, pair, count)``, the pairs of text
    ``k`` at ``cuts[k]:cuts[k + 1]``, ascending. A pair is ``a * size of B + b``."""
    n = len(al.n_a)
    text = np.repeat(np.arange(n), al.n_a)[al.link_a]
    pair = al.a[al.link_a] * both.b.size + al.b[al.link_b]
    bits = (both.a.size * both.b.size).bit_length()
    key = np.sort((text << bits) | pair)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at]
    return (np.searchsorted(key >> bits, np.arange(n + 1)), key & ((1 << bits) - 1),
            np.diff(at, append=len(new)))


def pieces(text: str, limit: int) -> Iterator[str]:
    """``text`` in pieces of ``limit`` characters or more, cut where both
    tokenizers end a token; later pieces start with the space at the cut."""
    start = 0
    while len(text) - start > limit:
        m = _CUT.search(text, start + limit)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def _blocks(batches, limit: int) -> Iterator[tuple[list, list[str], list[bool]]]:
    """Blocks of pieces: ``(rows, texts, first)``; a row is ``(key, doc_id, last)``.
    Rows without text come along with an empty piece."""
    rows, texts, first, held = [], [], [], 0
    for batch in batches:
        for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for k, (piece, last) in enumerate(_ahead(pieces(text or "", limit))):
                rows.append((key, doc_id, last))
                texts.append(piece)
                first.append(k == 0)
                held += len(piece) + 64
                if held >= limit:
                    yield rows, texts, first
                    rows, texts, first, held = [], [], [], 0
    if rows:
        yield rows, texts, first


def _ahead(items) -> Iterator[tuple[object, bool]]:
    """Every item with whether it is the last."""
    items = iter(items)
    item = next(items)
    for following in items:
        yield item, False
        item = following
    yield item, True


def _pack(pair: np.ndarray, count: np.ndarray) -> bytes:
    """Ascending pairs as differences, and counts, byte plane by byte plane."""
    planes = [np.diff(pair, prepend=0).view(np.uint8).reshape(-1, 8).T,
              count.astype(np.int32).view(np.uint8).reshape(-1, 4).T]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(raw) // 12
    pair = np.ascontiguousarray(raw[:8 * n].reshape(8, n).T).view(np.int64).ravel()
    count = np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view(np.int32).ravel()
    return np.cumsum(pair), count.astype(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("key"), "doc_id",
                       F.col("text").cast("string").alias("text"))


ALIGNED = ("doc_id long, a_ids array<int>, b_ids array<int>, a_per_group array<int>, "
           "b_per_group array<int>, group_end array<long>")


def align(docs: DataFrame, files: dict | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Groups of every document: the ids of both sides, how many of each a group
    takes (in order), and the byte of space + text behind each group."""
    shared = docs.sparkSession.sparkContext.broadcast(files or vocabulary_files())

    def run(batches):
        both = tokenizers(shared)
        held = None
        for rows, texts, first in _blocks(batches, block_chars):
            al = align_block(both, texts, first)
            n_groups = len(al.end)
            per_a = np.bincount(al.group_a, minlength=n_groups)
            per_b = np.bincount(al.group_b, minlength=n_groups)
            cut_a, cut_b, cut = _bounds(al.n_a), _bounds(al.n_b), _bounds(al.size)
            cut_g = np.searchsorted(al.end, cut, "right")
            out = []
            for k, (_, doc_id, last) in enumerate(rows):
                a, b, g = (slice(c[k], c[k + 1]) for c in (cut_a, cut_b, cut_g))
                part = (al.a[a], al.b[b], per_a[g], per_b[g], al.end[g] - cut[k])
                good = bool(al.ok[k])
                if held is None:
                    held = [[], True, 0]
                held[0].append((*part[:4], part[4] + held[2]))
                held[1] &= good
                held[2] += int(al.size[k])
                if last:
                    columns = zip(*held[0], strict=True)
                    out.append((doc_id, *(np.concatenate(c) if held[1] else [] for c in columns)))
                    held = None
            if out:
                types = [pa.int64(), *[pa.list_(pa.int32())] * 4, pa.list_(pa.int64())]
                names = [f.split()[0] for f in ALIGNED.split(", ")]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), types, strict=True)], names)

    return _keyed(docs).mapInArrow(run, ALIGNED)


_MEASURED = ("key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
             "groups_sha256 string, pairs array<binary>")


def _measured(docs: DataFrame, shared, block_chars: int) -> DataFrame:
    """Counts, digest and packed id pairs of every document."""

    def run(batches):
        both = tokenizers(shared)
        held = None
        names = [f.split()[0] for f in _MEASURED.split(", ")]
        for rows, texts, first in _blocks(batches, block_chars):
            al = align_block(both, texts, first)
            groups = group_texts(both, al)
            cuts, pair, count = pair_counts(both, al)
            n_groups = np.diff(np.searchsorted(al.end, _bounds(al.size), "right"))
            n_links = np.bincount(np.repeat(np.arange(len(rows)), al.n_a)[al.link_a],
                                  minlength=len(rows))
            out = []
            for k, (key, doc_id, last) in enumerate(rows):
                if held is None:
                    held = [True, np.zeros(4, np.int64), hashlib.sha256(), []]
                elif groups[k]:
                    held[2].update(b";")
                held[0] &= bool(al.ok[k])
                held[1] += (al.n_a[k], al.n_b[k], n_groups[k], n_links[k])
                held[2].update(groups[k][:-1])
                if cuts[k] < cuts[k + 1]:
                    held[3].append(_pack(pair[cuts[k]:cuts[k + 1]], count[cuts[k]:cuts[k + 1]]))
                if last:
                    if held[0] and held[1][0]:
                        out.append((key, doc_id, *held[1].tolist(), held[2].hexdigest(), held[3]))
                    else:
                        out.append((key, doc_id, 0, 0, 0, 0, "", []))
                    held = None
            if out:
                types = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.binary())]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), types, strict=True)], names)

    return _keyed(docs).mapInArrow(run, _MEASURED)


def _summed(pair: list[np.ndarray], count: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pair, count = np.concatenate(pair), np.concatenate(count)
    order = np.argsort(pair, kind="stable")
    pair, count = pair[order], count[order]
    at = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    return pair[at], np.add.reduceat(count, at)


def _corpus_counts(measured: DataFrame) -> DataFrame:
    """``(pair, n)``: links of every id pair in the whole corpus. Tasks add up what
    they hold and send it on whenever it reaches ``HELD_PAIRS`` distinct pairs."""

    def run(batches):
        pair, count, fresh, base = [], [], 0, 0
        for batch in batches:
            for blobs in batch.column(0):
                for blob in blobs:
                    p, c = _unpack(blob.as_py())
                    pair.append(p)
                    count.append(c)
                    fresh += len(p)
                if fresh > max(base, HELD_PAIRS // 4):
                    p, c = _summed(pair, count)
                    pair, count, fresh, base = [p], [c], 0, len(p)
                    if base >= HELD_PAIRS:
                        yield from _pair_batches(p, c)
                        pair, count, base = [], [], 0
        if pair:
            yield from _pair_batches(*_summed(pair, count))

    return (measured.select("pairs").mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def _pair_batches(pair: np.ndarray, count: np.ndarray, size: int = 1 << 16):
    for k in range(0, len(pair), size):
        yield pa.record_batch([pair[k:k + size], count[k:k + size]], ["pair", "n"])


_SUMS = "key long, pair long, times long, n_best long, count_sum long"


def _with_common(measured: DataFrame, shared) -> DataFrame:
    """Per document the sums over its common pairs (``pair`` null), and a row for
    each of its other pairs."""

    def run(batches):
        known, n, best = shared.value
        names = [f.split()[0] for f in _SUMS.split(", ")]
        for batch in batches:
            keys, blobs = (c.to_pylist() for c in batch.columns)
            totals = np.zeros((len(keys), 2), np.int64)
            for k, parts in enumerate(blobs):
                for blob in parts:
                    pair, times = _unpack(blob)
                    at = np.searchsorted(known, pair)
                    at[at == len(known)] = 0
                    hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                    at = at[hit]
                    totals[k] += ((times[hit] * best[at]).sum(), (times[hit] * n[at]).sum())
                    rare = int((~hit).sum())
                    if rare:
                        none = pa.nulls(rare, pa.int64())
                        yield pa.record_batch([np.full(rare, keys[k]), pair[~hit], times[~hit],
                                               none, none], names)
            none = pa.nulls(len(keys), pa.int64())
            yield pa.record_batch([np.array(keys, np.int64), none, none, totals[:, 0],
                                   totals[:, 1]], names)

    return measured.select("key", "pairs").mapInArrow(run, _SUMS)


def agreement(docs: DataFrame, files: dict | None = None, common_pairs: int = COMMON_PAIRS,
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """How the two tokenizations of every document agree.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links``: tokens, groups and overlapping
    token pairs; ``count_sum``: the sum over links of how many links in the corpus
    join the same two ids; ``n_best``: links whose ids are joined as often as any
    pair of that B id; ``groups_sha256``: digest of the groups.

    Pairs with more than 1 / ``common_pairs`` of all links - at most that many -
    are sent to the tasks as sorted arrays; the other pairs of a document, none of
    them hot, are joined to the counted table.
    """
    sc = docs.sparkSession.sparkContext
    files = files or vocabulary_files()
    shared = sc.broadcast(files)
    measured = stored(_measured(docs, shared, block_chars), "align-documents")
    shared.destroy()
    counted = stored(_corpus_counts(measured), "align-pairs")
    n_b = Tokenizers(files).b.size
    top = (counted.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("top")))
    ranked = (counted.withColumn("b", F.col("pair") % n_b)
              .join(F.broadcast(top), "b")  # at most one row per id of side B
              .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    limit = total // common_pairs
    common = ranked.where(F.col("n") > limit).toArrow().sort_by("pair")
    known = sc.broadcast((common["pair"].to_numpy(), common["n"].to_numpy(),
                          common["best"].to_numpy().astype(np.int64)))
    sums = stored(_with_common(measured, known), "align-sums")
    known.destroy()
    rare = (sums.where(F.col("pair").isNotNull()).select("key", "pair", "times")
            .join(ranked.where(F.col("n") <= limit), "pair")
            .select("key", (F.col("times") * F.col("best").cast("long")).alias("n_best"),
                    (F.col("times") * F.col("n")).alias("count_sum")))
    per_key = (sums.where(F.col("pair").isNull()).select("key", "n_best", "count_sum")
               .unionByName(rare).groupBy("key")
               .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return (measured.drop("pairs").join(per_key, "key")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                    "groups_sha256"))
