"""Byte-level BPE over whole corpora with a public vocabulary.

Texts are cut into pieces by the vocabulary's split pattern. The distinct pieces of a batch are
sorted by length and laid out as padded integer matrices; in each round every row merges its leftmost
pair of minimum rank, pair ranks come from an open-addressing hash table, and since each live row
loses exactly one symbol per round the matrix is compacted by one column. Rows without a known pair
leave the matrix.

Defined results: a null and an empty text both give an empty list; strings that look like special
tokens are ordinary text; lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the split pattern of the public vocabulary.
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_NONE = np.int32(2**31 - 1)
#: Cells of one padded matrix, and the piece length from which a row is merged on its own.
_CELLS = 1 << 19
_LONG = 1024
#: Distinct pieces remembered by one Python worker; only a cache, so the bound never changes a result.
_CACHE = 400_000


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + i)] = b
    return out


class PairTable:
    """Open-addressing hash table from a pair of ids to its merge rank and merged id."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        self.bits = max(4, int(len(left) * 3).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, dtype=np.int32)
        self.merged = merged.astype(np.int32)
        keys = (left.astype(np.int64) << 20) | right.astype(np.int64)
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slots[todo]] == -1
            cand = todo[free]
            _, first = np.unique(slots[cand], return_index=True)
            won = cand[first]
            self.keys[slots[won]] = keys[won]
            self.ranks[slots[won]] = won
            left_over = np.ones(len(keys), dtype=bool)
            left_over[won] = False
            todo = todo[left_over[todo]]
            taken = self.keys[slots[todo]] != keys[todo]
            slots[todo[taken]] = (slots[todo[taken]] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, the largest int32 where there is none or an id is padding (-1)."""
        keys = (left.astype(np.int64) << 20) | right.astype(np.int64)
        out = np.full(keys.shape, _NONE, dtype=np.int32)
        live = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[live]
        slots = self._slot(keys)
        flat = out.ravel()
        while len(live):
            there = self.keys[slots]
            hit = there == keys
            flat[live[hit]] = self.ranks[slots[hit]]
            more = ~hit & (there != -1)
            live, keys, slots = live[more], keys[more], (slots[more] + 1) & self.mask
        return flat.reshape(out.shape)


class MatrixBPE:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet, vocab = _byte_alphabet(), model["vocab"]
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        for ch, b in alphabet.items():
            self.byte_ids[b] = vocab[ch]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], dtype=np.int64)
        self.table = PairTable(ids[:, 0], ids[:, 1], ids[:, 2])
        self.text_of = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items() if all(c in alphabet for c in s)}
        self.split = regex.compile(SPLIT_PATTERN).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.text_of[int(i)] for i in ids).decode("utf-8")

    def _merge_matrix(self, m: np.ndarray, where: np.ndarray, out: list) -> None:
        """Merge all rows of ``m`` (padded with -1) to the end; results go to ``out`` at ``where``."""
        r = self.table.rank(m[:, :-1], m[:, 1:])
        while len(m):
            width = m.shape[1]
            if width > 1:
                pos = r.argmin(axis=1)
                best = r[np.arange(len(m)), pos]
                done = best == _NONE
            else:
                done = np.ones(len(m), dtype=bool)
            if done.any():
                for i, row in zip(where[done].tolist(), m[done].tolist()):
                    out[i] = tuple(x for x in row if x >= 0)
                live = ~done
                m, where = m[live], where[live]
                if not len(m):
                    return
                r, pos, best = r[live], pos[live], best[live]
            n, rows = len(m), np.arange(len(m))
            m[rows, pos] = self.table.merged[best]
            keep = np.ones(m.shape, dtype=bool)
            keep[rows, pos + 1] = False
            m = m[keep].reshape(n, width - 1)
            keep = np.ones(r.shape, dtype=bool)
            keep[rows, pos] = False
            r = r[keep].reshape(n, width - 2)
            new = m[rows, pos]
            inner = pos > 0
            if inner.any():
                r[rows[inner], pos[inner] - 1] = self.table.rank(m[rows[inner], pos[inner] - 1], new[inner])
            inner = pos < width - 2
            if inner.any():
                r[rows[inner], pos[inner]] = self.table.rank(new[inner], m[rows[inner], pos[inner] + 1])

    def _merge_long(self, row: np.ndarray) -> tuple[int, ...]:
        """One very long row: each round merges, left to right, all places of the minimum-rank pair.

        A merged id only takes part in pairs of higher rank, so this equals one leftmost merge a round.
        """
        while len(row) > 1:
            r = self.table.rank(row[:-1], row[1:])
            best = r.min()
            if best == _NONE:
                break
            at = np.flatnonzero(r == best)
            if len(at) > 1:
                run = np.cumsum(np.concatenate([[True], np.diff(at) != 1]))
                start = at[np.concatenate([[True], run[1:] != run[:-1]])]
                at = at[(at - start[run - 1]) % 2 == 0]
            row[at] = self.table.merged[best]
            keep = np.ones(len(row), dtype=bool)
            keep[at + 1] = False
            row = row[keep]
        return tuple(row.tolist())

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of each piece, by length buckets."""
        raw = [p.encode("utf-8") for p in pieces]
        sizes = np.array([len(b) for b in raw], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        out: list = [()] * len(raw)
        flat = self.byte_ids[np.frombuffer(b"".join(raw[i] for i in order), dtype=np.uint8)]
        sizes = sizes[order]
        ends = np.cumsum(sizes)
        i, n = int(np.searchsorted(sizes, 1)), len(order)
        while i < n:
            if sizes[i] > _LONG:
                out[order[i]] = self._merge_long(flat[ends[i] - sizes[i] : ends[i]].copy())
                i += 1
                continue
            width = min(_LONG, int(sizes[i]) + int(sizes[i]) // 4)
            j = min(int(np.searchsorted(sizes, width, side="right")), i + max(1, _CELLS // width))
            width = int(sizes[j - 1])
            m = np.full((j - i, width), -1, dtype=np.int32)
            m[np.arange(width) < sizes[i:j, None]] = flat[ends[i] - sizes[i] : ends[j - 1]]
            self._merge_matrix(m, order[i:j], out)
            i = j
        return out

    def encode_batch(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Ids of each text; empty for null and empty texts."""
        if len(self.cache) > _CACHE:
            self.cache.clear()
        words = [self.split(t) if t else [] for t in texts]
        fresh = list(set(chain.from_iterable(words)).difference(self.cache))
        if fresh:
            self.cache.update(zip(fresh, self.encode_pieces(fresh)))
        of = self.cache.__getitem__
        return [list(chain.from_iterable(map(of, w))) for w in words]

    def count_batch(self, texts: Iterable[str | None]) -> list[int]:
        return [len(x) for x in self.encode_batch(texts)]


@lru_cache(maxsize=2)
def encoder(path: str) -> MatrixBPE:
    return MatrixBPE(path)


def _slices(batches: Iterator[pa.RecordBatch], text: str, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``budget`` bytes of text (a single row may exceed it)."""
    for b in batches:
        sizes = np.array(pc.binary_length(b.column(text)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cut = np.flatnonzero(np.diff(np.cumsum(sizes) // budget)) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
            if j > i:
                yield b.slice(i, j - i)


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", *, path: str = f"{TOKENIZER_DIR}/{VOCABULARY}") -> DataFrame:
    """``(key, ids)`` for every row of ``df``: the ids of its text, without special tokens.

    Null and empty texts give an empty list; a null key is kept; repeated rows each give a row; other
    columns of ``df`` are not read. Work is per partition, nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        kind = pa.list_(pa.field("element", pa.int32(), nullable=True))
        for b in _slices(batches, "text"):
            ids = bpe.encode_batch(b.column("text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(offsets[-1]))
            arr = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)).cast(kind)
            yield pa.RecordBatch.from_arrays([b.column("key"), arr], names=["key", "ids"])

    src = df.select(df[key].alias("key"), df[text].alias("text"))
    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return src.mapInArrow(run, schema).withColumnRenamed("key", key)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", *, path: str = f"{TOKENIZER_DIR}/{VOCABULARY}") -> DataFrame:
    """``(key, n_tokens)`` for every row of ``df``; 0 for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in _slices(batches, "text"):
            n = pa.array(bpe.count_batch(b.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("key"), n], names=["key", "n_tokens"])

    src = df.select(df[key].alias("key"), df[text].alias("text"))
    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), T.StructField("n_tokens", T.LongType())])
    return src.mapInArrow(run, schema).withColumnRenamed("key", key)
