"""Near-duplicate texts with small edits, found by filters under several global token orders.

A text is the set of its word shingles. Texts with equal sets form one class and go on as one; of a collection
with many equal texts only one of each is shingled. A pair of similar sets
must share a token among the first ``n - ceil(t n) + 1`` tokens of each, whatever global order sorts the tokens, so
candidates are the pairs that share a prefix token under every one of several orders; they are intersected before any
pair is verified on its whole sets. Where texts are made of few phrases the pairs that share a prefix token grow as the
square of the texts, so a pair is written only if the parity bitmaps of both sets allow it to be similar: each token flips
one bit, and the bits in which two bitmaps differ are never more than the tokens that only one set has. Large sets have
longer bitmaps, up to ``MOST_BITS``, which are folded for a comparison with shorter ones.

All orders put rare tokens first. Their frequency class comes from two tables of fixed size that all tasks read: exact
document counts of tokens are aggregated (partial sums first), and the classes of those that occur more than once are
folded into ``CELLS`` cells of each table under independent hashes, the largest in a cell counting. A token's class is the
smaller of its two cells', so a rare token is taken for a frequent one only if it meets frequent ones in both, however
many tokens the tables hold. The class is a function of the token alone, so the orders are global. A token that is not in
the filter of all shared tokens, whose bits grow with their number up to ``FILTER_BITS``, occurs once and can never be
shared: such tokens keep their places in the order but are neither indexed nor compared. Full tables and a full filter
cost speed and disk, never pairs. They are packed by block on the executors, so that the driver passes on 2 x ``CELLS`` +
``FILTER_BITS`` / 8 bytes at most and no rows.

Defined results: null texts and texts with fewer than ``least`` shingles are in no pair; repeated rows of a key count
once; equal sets have similarity 1; other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint, release

#: Cells of each of the two tables of frequency classes, one byte each; a power of two.
CELLS = 1 << 24
_BLOCK, _MERGES = 1 << 16, 32
#: Most bits of the filter of shared tokens, and its bits a token and probes; a power of two.
FILTER_BITS, _BITS_TOKEN, _PROBES = 1 << 30, 8, 3
#: Bits of the parity bitmap of a set: twice its tokens or a little more, within these; powers of two.
LEAST_BITS, MOST_BITS = 512, 4096
ORDERS = 3
_TOKEN_MASK = np.uint64((1 << 48) - 1)
_WORD = re.compile(r"[a-z0-9_]+")
_CACHE = 500_000
_FOUND = 200_000
#: Share of different texts up to which copies are set aside first.
_ONCE = 0.75
_BATCH_CHARS = 4 << 20


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct 48-bit shingle hashes of texts, for batches of texts at once."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.words: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(tokens, offsets)``: the sorted distinct tokens of each text, concatenated."""
        found = [_WORD.findall(t.lower()) if t else [] for t in texts]
        known = self.words
        if len(known) > _CACHE:
            known.clear()
        for w in set().union(*found):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        ids = np.fromiter((known[w] for f in found for w in f), dtype=np.uint64, count=int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        count = np.maximum(sizes - self.width + 1, 0)
        doc = np.repeat(np.arange(len(texts)), count)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + starts[doc]
        h = np.zeros(len(doc), dtype=np.uint64)
        for k in range(self.width):
            h = _mix(h ^ ids[at + k], k)
        h &= _TOKEN_MASK
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[keep], doc[keep]
        return h, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        texts = b.column("text").to_pylist()
        sizes = np.cumsum([len(t or "") for t in texts]) // _BATCH_CHARS
        cut = (np.flatnonzero(np.diff(sizes)) + 1).tolist()
        for i, j in zip([0, *cut], [*cut, b.num_rows]):
            if j > i:
                yield b.slice(i, j - i)


def prefix_length(n: int, threshold: float) -> int:
    """Tokens that must be looked at in a set of ``n`` so that no set at least ``threshold`` similar is missed."""
    return n - math.ceil(threshold * n - 1e-9) + 1


def _hashed(src: DataFrame, *more: str) -> DataFrame:
    return src.select("key", F.xxhash64("text").alias("text_hash"), *more)


def _heads(src: DataFrame) -> DataFrame:
    """``(text_hash, head)``: the smallest key that has each text."""
    return checkpoint(_hashed(src).groupBy("text_hash").agg(F.min("key").alias("head")))


def _counts(src: DataFrame, width: int, least: int) -> DataFrame:
    """``(token, df)`` of tokens that more than one row has; copies inside a task count once."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen = Shingler(width), set()
        for b in _batches(it):
            tok, off = shingle(b.column("text").to_pylist())
            parts = []
            for i, j in zip(off[:-1].tolist(), off[1:].tolist()):
                if j - i >= least:
                    sig = xxhash.xxh3_64_intdigest(tok[i:j].tobytes())
                    if sig not in seen:
                        seen.add(sig)
                        parts.append(tok[i:j])
            if parts:
                u, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    return src.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("df")).filter("df > 1")


def frequency_classes(counts: DataFrame, cells: int | None = None) -> np.ndarray:
    """Both tables, one after the other: for each cell the largest ceil(log2 df) of its tokens, 0 where no shared token lies.

    Every task fills tables of its own, and what is shuffled and sent on are their compressed blocks.
    """
    cells = cells or CELLS

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(max(2 * cells, _BLOCK), dtype=np.uint8)
        for pdf in batches:
            if len(pdf):
                cls = np.ceil(np.log2(pdf["df"].to_numpy(dtype=np.float64))).astype(np.uint8)
                order = np.argsort(cls, kind="stable")  # of equal cells the last written, the largest, stays
                for at in _cells(pdf["token"].to_numpy().astype(np.uint64)[order], cells):
                    own[at] = np.maximum(own[at], cls[order])
        blocks = np.flatnonzero(own.reshape(-1, min(_BLOCK, len(own))).any(axis=1))
        yield pd.DataFrame({"block": blocks, "bytes": [zlib.compress(own[b * _BLOCK : (b + 1) * _BLOCK].tobytes(), 1) for b in blocks]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got: dict[int, np.ndarray] = {}
        for pdf in batches:
            for b, raw in zip(pdf["block"].tolist(), pdf["bytes"]):
                x = np.frombuffer(zlib.decompress(raw), dtype=np.uint8)
                got[b] = np.maximum(got[b], x) if b in got else x
        yield pd.DataFrame({"block": list(got), "bytes": [zlib.compress(x.tobytes(), 1) for x in got.values()]})

    out = np.zeros(max(2 * cells, _BLOCK), dtype=np.uint8)
    schema = "block long, bytes binary"
    for r in counts.mapInPandas(fill, schema).repartition(_MERGES, "block").mapInPandas(merge, schema).collect():
        out[r.block * _BLOCK : (r.block + 1) * _BLOCK] = np.frombuffer(zlib.decompress(r.bytes), dtype=np.uint8)
    return out[: 2 * cells]


def _cells(tokens: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of each token's two cells."""
    h = _mix(tokens, 7)
    mask = np.uint64(cells - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64) + cells


def classes_of(tokens: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Frequency class of each token, 0 for tokens that occur once."""
    low, high = _cells(tokens, len(table) // 2)
    return np.minimum(table[low], table[high]).astype(np.int64)


def _probes(tokens: np.ndarray, bits: int) -> list[np.ndarray]:
    """Positions of each token's bits in a filter of ``bits`` bits."""
    h = _mix(tokens, 9)
    step = (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((h + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64) for k in range(_PROBES)]


def shared_filter(counts: DataFrame, n_tokens: int, most: int | None = None) -> np.ndarray:
    """Packed bits of a filter that holds all tokens of ``counts``; tasks send on the places of their bits only."""
    most = most or FILTER_BITS
    bits = min(most, max(1 << 16, 1 << (_BITS_TOKEN * n_tokens - 1).bit_length()))
    block = min(bits, 1 << 16)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [np.concatenate(_probes(pdf["token"].to_numpy().astype(np.uint64), bits)) for pdf in batches if len(pdf)]
        if got:
            at = np.unique(np.concatenate(got))
            blocks, first = np.unique(at // block, return_index=True)
            yield pd.DataFrame({"block": blocks, "bytes": [x.tobytes() for x in np.split((at % block).astype(np.uint16), first[1:])]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got: dict[int, np.ndarray] = {}
        for pdf in batches:
            for b, raw in zip(pdf["block"].tolist(), pdf["bytes"]):
                got.setdefault(b, np.zeros(block, dtype=np.bool_))[np.frombuffer(raw, dtype=np.uint16)] = True
        yield pd.DataFrame({"block": list(got), "bytes": [np.packbits(x, bitorder="little").tobytes() for x in got.values()]})

    out = np.zeros(bits // 8, dtype=np.uint8)
    schema = "block long, bytes binary"
    for r in counts.mapInPandas(places, schema).repartition(_MERGES, "block").mapInPandas(merge, schema).toLocalIterator():
        out[r.block * block // 8 : (r.block + 1) * block // 8] = np.frombuffer(r.bytes, dtype=np.uint8)
    return out


def in_filter(tokens: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Which tokens the filter may hold."""
    held = np.ones(len(tokens), dtype=bool)
    for at in _probes(tokens, 8 * len(packed)):
        held &= (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return held


def parity_bitmaps(tokens: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The parity of each set's tokens at each bit of its bitmap."""
    sizes = np.diff(offsets)
    bits = 1 << np.ceil(np.log2(np.clip(2 * sizes, LEAST_BITS, MOST_BITS))).astype(np.int64)
    ends = np.cumsum(bits)
    cell = (_mix(tokens, 11) & np.repeat(bits - 1, sizes).astype(np.uint64)).astype(np.int64) + np.repeat(ends - bits, sizes)
    flat = np.packbits((np.bincount(cell, minlength=int(bits.sum())) & 1).astype(np.uint8)).tobytes()
    return [flat[i:j] for i, j in zip(((ends - bits) // 8).tolist(), (ends // 8).tolist())]


class Bitmaps:
    """Bitmaps of several lengths: for each length those that have it or are folded to it, by row."""

    def __init__(self, raw: list[bytes]) -> None:
        size = np.array([len(x) for x in raw], dtype=np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        above, wide = np.zeros(0, dtype=np.int64), np.zeros((0, MOST_BITS // 32), dtype=np.uint64)
        bits = MOST_BITS
        while bits >= LEAST_BITS:
            folded = wide[:, : bits // 64] ^ wide[:, bits // 64 :]
            own = np.flatnonzero(size == bits // 8)
            at = np.full(len(raw), -1, dtype=np.int64)
            above = np.concatenate([above, own])
            wide = np.concatenate([folded, np.frombuffer(b"".join(raw[i] for i in own.tolist()), dtype=np.uint64).reshape(len(own), bits // 64)])
            at[above] = np.arange(len(above))
            self.levels.insert(0, (at, wide))
            bits //= 2

    def within(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Places of the pairs whose bitmaps differ in ``most`` bits at most, at the longest length that both have."""
        k = np.arange(len(i))
        for at, words in self.levels:
            a, b = at[i[k]], at[j[k]]
            both = (a >= 0) & (b >= 0)
            if not both.any():
                break
            apart = np.zeros(len(k), dtype=np.int64)
            apart[both] = np.bitwise_count(words[a[both]] ^ words[b[both]]).sum(axis=1, dtype=np.int64)
            k = k[apart <= most[k]]
        return k


_DOC_SCHEMA = [
    T.StructField("sig", T.LongType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("bitmap", T.BinaryType()),
    T.StructField("tokens", T.ArrayType(T.LongType())),
    T.StructField("pre_token", T.ArrayType(T.LongType())),
    T.StructField("pre_mask", T.ArrayType(T.IntegerType())),
    T.StructField("pre_pos", T.ArrayType(T.IntegerType())),
]


def _documents(src: DataFrame, classes, width: int, threshold: float, least: int, orders: int) -> DataFrame:
    """Each row's class (``sig``) and size; for texts that can have partners also the shared tokens and the prefixes."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, (table, packed) = Shingler(width), classes.value
        for b in _batches(it):
            tok, off = shingle(b.column("text").to_pylist())
            cls = np.where(in_filter(tok, packed), classes_of(tok, table), 0)
            bitmaps = parity_bitmaps(tok, off)
            rows: list[int] = []
            out: list[list] = [[], [], [], [], [], [], []]
            for r, (i, j) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                n = j - i
                if n < least:
                    continue
                rows.append(r)
                out[0].append(xxhash.xxh3_64_intdigest(tok[i:j].tobytes()))
                out[1].append(n)
                live = np.flatnonzero(cls[i:j] > 0)
                first, p = n - len(live), prefix_length(n, threshold)
                if first >= p:
                    for k in range(2, 7):
                        out[k].append(None)
                    continue
                t, c = tok[i:j][live], cls[i:j][live]
                mask, pos = np.zeros(len(t), dtype=np.int32), np.zeros(len(t), dtype=np.int32)
                for k in range(orders):
                    o = np.lexsort((_mix(t, 100 + k), c // (k + 1)))
                    mask[o[: p - first]] |= 1 << k
                    if k == 0:
                        pos[o] = first + np.arange(len(t))
                keep = mask > 0
                out[2].append(bitmaps[r])
                out[3].append(t.astype(np.int64))
                out[4].append(t[keep].astype(np.int64))
                out[5].append(mask[keep])
                out[6].append(pos[keep])
            if rows:
                types = [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                cols = [pa.array(np.array(out[0], dtype=np.uint64).view(np.int64)), pa.array(out[1], pa.int32())]
                cols += [pa.array(v, ty) for v, ty in zip(out[2:], types)]
                yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(rows)), *cols], names=["key", *(f.name for f in _DOC_SCHEMA)])

    return src.mapInArrow(run, T.StructType([T.StructField("key", src.schema["key"].dataType), *_DOC_SCHEMA]))


def _candidates(docs: DataFrame, threshold: float, orders: int) -> DataFrame:
    """``(a, b)`` pairs of classes that share a prefix token under every order and whose bitmaps allow them to be similar."""
    e = docs.select("sig", "n", "bitmap", F.explode(F.arrays_zip("pre_token", "pre_mask", "pre_pos")).alias("e")).select(
        F.col("e.pre_token").alias("token"), "sig", "n", F.col("e.pre_mask").alias("mask"), F.col("e.pre_pos").alias("pos"), "bitmap"
    )

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in it if b.num_rows]
        if not batches:
            return
        token, sig, n, mask, pos = (np.concatenate([b.column(k).to_numpy() for b in batches]).astype(np.int64) for k in range(5))
        raw = [x for b in batches for x in b.column(5).to_pylist()]
        order = np.lexsort((n, token))
        bitmaps = Bitmaps([raw[k] for k in order.tolist()])
        del batches, raw
        token, sig, n, mask, pos = (x[order] for x in (token, sig, n, mask, pos))
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        end = np.repeat(np.append(first[1:], len(token)), np.diff(np.append(first, len(token))))
        i, gap, held, found = np.arange(len(token)), 0, 0, []
        while len(i):  # rows ``gap`` places apart; a token's rows are sorted by size, so a row that has met one too large is done
            gap += 1
            i = i[i + gap < end[i]]
            i = i[n[i] >= threshold * n[i + gap] - 1e-9]
            j = i + gap
            need = np.ceil(threshold / (1 + threshold) * (n[i] + n[j]) - 1e-9).astype(np.int64)
            bits = mask[i] & mask[j]
            bits = np.where(np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need, bits, bits & ~1)
            k = np.flatnonzero((bits != 0) & (sig[i] != sig[j]))
            k = k[bitmaps.within(i[k], j[k], n[i[k]] + n[j[k]] - 2 * need[k])]
            if len(k):
                a, b = sig[i[k]], sig[j[k]]
                found.append((np.minimum(a, b), np.maximum(a, b), bits[k]))
                held += len(k)
            if found and (held > _FOUND or not len(i)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["a", "b", "bits"])
                held, found = 0, []

    seen = e.repartition("token").mapInArrow(run, "a long, b long, bits long").groupBy("a", "b").agg(F.bit_or("bits").alias("bits"))
    return seen.filter(F.col("bits") == (1 << orders) - 1).select("a", "b")


class NearDuplicates:
    """Classes, their similar pairs, and groups of one collection."""

    def __init__(self, df: DataFrame, key: str, text: str, *, width: int = 5, threshold: float = 0.8, least: int = 1, orders: int = ORDERS) -> None:
        if not 0 < threshold <= 1 or width < 1 or orders < 1:
            raise ValueError("threshold must lie in (0, 1], width and orders must be positive")
        src = df.select(df[key].alias("key"), df[text].alias("text")).filter("key IS NOT NULL AND text IS NOT NULL")
        least = max(1, least)
        heads, texts = _heads(src), src
        once = heads.count() < _ONCE * src.count()
        if once:  # many copies: only the heads are shingled
            texts = checkpoint(_hashed(src, "text").join(heads.withColumnRenamed("head", "key"), ["text_hash", "key"], "left_semi").select("key", "text"))
        counts = checkpoint(_counts(texts, width, least))
        tables = frequency_classes(counts), shared_filter(counts, counts.count())
        release(counts)
        rows = checkpoint(_documents(texts, df.sparkSession.sparkContext.broadcast(tables), width, threshold, least, orders))
        #: ``(key, sig)``: the class of each text that has enough shingles.
        self.members = rows.select("key", "sig").distinct()
        if once:
            release(texts)
            of = rows.select(F.col("key").alias("head"), "sig").join(heads, "head").select("text_hash", "sig")
            self.members = checkpoint(_hashed(src).join(of, "text_hash").select("key", "sig").distinct())
        release(heads)
        docs = rows.filter("tokens IS NOT NULL").drop("key").dropDuplicates(["sig"])
        whole = docs.select("sig", "n", "tokens")
        cand = _candidates(docs, threshold, orders)
        a = whole.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
        b = whole.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
        both = cand.join(a, "a").join(b, "b")
        shared = F.size(F.array_intersect("ta", "tb"))
        scored = both.select("a", "b", (shared / (F.col("na") + F.col("nb") - shared)).alias("similarity"))
        #: ``(a, b, similarity)``: pairs of different classes at least ``threshold`` similar.
        self.pairs = checkpoint(scored.filter(F.col("similarity") >= threshold - 1e-12))

    def key_pairs(self) -> DataFrame:
        """``(key_a, key_b, similarity)`` for all pairs of keys, key_a < key_b; its size is that of the result asked for."""
        m = self.members
        ma, mb = m.select(F.col("key").alias("ka"), F.col("sig").alias("a")), m.select(F.col("key").alias("kb"), F.col("sig").alias("b"))
        across = self.pairs.join(ma, "a").join(mb, "b").select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"), "similarity")
        within = ma.join(mb, (F.col("a") == F.col("b")) & (F.col("ka") < F.col("kb"))).select(F.col("ka").alias("key_a"), F.col("kb").alias("key_b"), F.lit(1.0).alias("similarity"))
        return across.unionByName(within)

    def groups(self) -> DataFrame:
        """``(key, class_id, class_size, group_id, group_size, n_links)``: one row a text that has enough shingles.

        ``class_id`` and ``group_id`` are the smallest keys of the class and of the connected group, ``n_links`` the number
        of similar classes plus the number of other texts in the own class.
        """
        heads = self.members.groupBy("sig").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
        ends = self.pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(self.pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
        links = ends.groupBy(F.col("x").alias("sig")).agg(F.count(F.lit(1)).alias("links"))
        comp = connected(ends).select(F.col("x").alias("sig"), "component")
        c = heads.join(links, "sig", "left").join(comp, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
        of = c.groupBy("component").agg(F.min("class_id").alias("group_id"), F.sum("class_size").alias("group_size"))
        c = c.join(of, "component")
        n_links = F.coalesce("links", F.lit(0)) + F.col("class_size") - 1
        return self.members.join(c, "sig").select("key", "class_id", "class_size", "group_id", "group_size", n_links.alias("n_links"))


def connected(ends: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """``(x, component)`` for an undirected graph given by both directions of its edges ``(x, y)``.

    Each round a node takes the smallest label around it and then that label's own label, so paths halve.
    """
    edges = checkpoint(ends.distinct())
    label = checkpoint(edges.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("component")))
    for _ in range(max_rounds):
        seen = edges.join(label.select(F.col("x").alias("y"), F.col("component").alias("other")), "y").groupBy("x").agg(F.min("other").alias("other"))
        near = label.join(seen, "x").select("x", F.least("component", "other").alias("near"), F.col("component").alias("old"))
        jump = near.join(label.select(F.col("x").alias("near"), F.col("component").alias("far")), "near", "left")
        nxt = checkpoint(jump.select("x", "old", F.least("near", F.coalesce("far", "near")).alias("component")))
        changed = nxt.filter("component <> old").limit(1).count()
        label = nxt.select("x", "component")
        if not changed:
            return label
    raise RuntimeError("the labels did not settle")
