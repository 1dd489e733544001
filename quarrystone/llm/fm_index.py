"""Benchmark decontamination by an FM-index over each training shard.

A shard is a stretch of documents of bounded size. All its words are symbols over
its own alphabet. A suffix array of the whole shard is built by prefix doubling;
its Burrows-Wheeler transform is kept as a wavelet tree of bit vectors with ranks.
All windows of the benchmark are searched backwards at once; occurrences are
located by walking to sampled suffix positions, and their spans are merged.

A window is 10 consecutive words of an item; an item with fewer words, but some,
is one window. The benchmark reaches the tasks as a broadcast only in slices whose
size is checked. One slice is searched as soon as a shard is indexed; for more, the
indexes are written once, each slice is searched in all of them, and the spans are
merged by row.

Defined cases: null and empty texts have no words; an item without words has no
window; repeated item ids count once; repeated documents give repeated rows; a
very long text is a shard of its own; further columns are ignored; empty tables
give empty results, an empty benchmark marks nothing.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, ship

WINDOW = 10
SHARD_BYTES = 8 << 20  # bytes of text in a shard
SLICE_BYTES = 32 << 20  # bytes of benchmark text in a pass
SAMPLED = 8  # every so many text positions is kept in the index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes outside of words become spaces, A-Z small letters.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling; suffixes that are told apart already are left alone.

    The first round sorts by as many symbols as fit into 63 bits.
    """
    n = len(symbols)
    width = max(1, int(symbols.max(initial=0) + 1).bit_length())
    k = max(1, 63 // width)
    packed = np.zeros(n, np.int64)
    for d in range(k):  # 0 stands behind the end, below all symbols
        packed <<= width
        packed[: n - d] |= symbols[d:] + 1
    order = np.argsort(packed, kind="stable")
    packed = packed[order]
    new = np.empty(n, bool)
    new[:1] = True
    np.not_equal(packed[1:], packed[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, sizes)
    wide = sizes > 1
    at = np.flatnonzero(np.repeat(wide, sizes))  # places in the order that aren't settled
    while len(at):
        here = order[at]
        behind = here + k
        first = rank[here]
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        by = np.lexsort((second, first))
        here, first, second = here[by], first[by], second[by]
        order[at] = here
        fresh = np.empty(len(here), bool)
        fresh[:1] = True
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        edges = np.flatnonzero(fresh)
        sizes = np.diff(np.append(edges, len(here)))
        rank[here] = np.repeat(at[edges], sizes)
        at = at[np.repeat(sizes > 1, sizes)]
        k *= 2
    return order


class BitVector:
    """Bits with ranks: counts before each word of 64 bits, and the bits within."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Ranks and symbols of a sequence, level by level from the highest bit (the levels lie flat)."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.levels: list[tuple[int, BitVector, int]] = []
        now = symbols
        for shift in range(max(1, int(symbols.max(initial=0)).bit_length()) - 1, -1, -1):
            bits = (now >> shift) & 1
            zeros = len(bits) - int(bits.sum())
            self.levels.append((shift, BitVector(bits.astype(np.uint8)), zeros))
            one = bits == 1
            now = np.concatenate((now[~one], now[one]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        lo, hi = np.zeros_like(i), i
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift) & 1 == 1
            lo1, hi1 = bits.rank1(lo), bits.rank1(hi)
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return hi - lo

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        lo, at, symbol = np.zeros_like(i), i, np.zeros_like(i)
        for _, bits, zeros in self.levels:
            one = bits.get(at) == 1
            symbol = symbol << 1 | one
            lo1, at1 = bits.rank1(lo), bits.rank1(at)
            lo, at = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + at1, at - at1)
        return symbol, at - lo


class FMIndex:
    """Full-text index of a sequence of positive symbols."""

    def __init__(self, symbols: np.ndarray, sampled: int = SAMPLED) -> None:
        text = np.append(symbols.astype(np.int64), 0)  # 0 ends the text
        self.n = len(text)
        order = suffix_array(text)
        bwt = text[order - 1]
        self.tree = WaveletTree(bwt)
        self.below = np.zeros(int(text.max()) + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=len(self.below) - 1), out=self.below[1:])
        marked = order % sampled == 0
        self.marked = BitVector(marked.astype(np.uint8))
        self.samples = order[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each row of patterns (of equal length), by backward search."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, k]
            known = c < len(self.below) - 1
            c = np.where(known, c, 0)
            lo = np.where(known, self.below[c] + self.tree.rank(c, lo), 0)
            hi = np.where(known, self.below[c] + self.tree.rank(c, hi), 0)
            hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps to the left until a sampled one is met."""
        found = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            hit = self.marked.get(at) == 1
            found[todo[hit]] = self.samples[self.marked.rank1(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                symbol, before = self.tree.symbol_and_rank(at)
                at = self.below[symbol] + before
            steps += 1
        return found


class Phrases:
    """The windows of a benchmark, by their number of words."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW) -> None:
        windows: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            w = words_of(text)
            size = min(window, len(w))
            for i in range(len(w) - size + 1 if size else 0):
                windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
        self.alphabet = {x: i for i, x in enumerate(dict.fromkeys(x for w in windows for x in w))}
        self.by_length: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for size in sorted({len(w) for w in windows}):
            own = [w for w in windows if len(w) == size]
            self.by_length[size] = (np.array([[self.alphabet[x] for x in w] for w in own], np.int64), [windows[w] for w in own])


class Shard:
    """All words of some texts, and the FM-index over them."""

    def __init__(self, texts: list[str | None]) -> None:
        self.symbol: dict[bytes, int] = {}
        counts, coded = [], []
        name = self.symbol.setdefault
        for t in texts:
            w = words_of(t)
            counts.append(len(w))
            coded.append(np.fromiter((name(x, len(self.symbol) + 2) for x in w), np.int64, len(w)))  # 0 ends the shard, 1 a text
            coded.append(np.ones(1, np.int64))
        self.counts = np.array(counts, np.int64)
        self.starts = np.cumsum(np.append(0, self.counts + 1))[:-1]
        self.index = FMIndex(np.concatenate(coded) if coded else np.zeros(0, np.int64))

    def search(self, phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """For each text: merged spans of hit words, and the items that hit."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.counts]
        items: list[set[str]] = [set() for _ in self.counts]
        own = np.fromiter((self.symbol.get(x, 0) for x in phrases.alphabet), np.int64, len(phrases.alphabet))
        marks = np.zeros(self.index.n + 1, np.int32)
        for size, (patterns, owners) in phrases.by_length.items():
            symbols = own[patterns]
            held = np.flatnonzero((symbols > 0).all(1))  # the others have a word that the shard lacks
            lo, hi = self.index.search(symbols[held])
            met = np.flatnonzero(hi > lo)
            if not len(met):
                continue
            each = (hi - lo)[met]
            rows = np.repeat(lo[met] - np.concatenate(([0], np.cumsum(each)[:-1])), each) + np.arange(each.sum())
            where = self.index.locate(rows)
            np.add.at(marks, where, 1)
            np.add.at(marks, where + size, -1)
            docs = np.searchsorted(self.starts, where, side="right") - 1
            for d, p in set(zip(docs.tolist(), np.repeat(held[met], each).tolist(), strict=True)):
                items[d] |= owners[p]
        hit = np.diff(np.concatenate(([0], (np.cumsum(marks[:-1]) > 0).astype(np.int8), [0])))
        for s, e in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist(), strict=True):
            d = int(np.searchsorted(self.starts, s, side="right")) - 1
            spans[d].append((s - int(self.starts[d]), e - int(self.starts[d])))
        return spans, items


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the stretches from the first to the last word of each span."""
    if not spans:
        return text
    places = [m.span() for m in WORD.finditer(text.translate(ASCII_LOWER))]
    out, at = [], 0
    for s, e in spans:
        out.append(text[at : places[s][0]])
        at = places[e - 1][1]
    return "".join([*out, text[at:]])


_SPANS = "array<struct<start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[tuple[pa.DataType, list, list]]:
    """(type of ids, ids, texts) of stretches of rows whose texts reach shard_bytes."""
    ids, texts, held, kind = [], [], 0, None
    for b in batches:
        kind = b.schema.field(0).type
        for i, t in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True):
            ids.append(i)
            texts.append(t)
            held += len(t or "")
            if held >= shard_bytes:
                yield kind, ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield kind, ids, texts


def _found(kind: pa.DataType, names: list[str], ids: list, counts: list, spans: list, items: list, texts: list) -> pa.RecordBatch:
    clean = [remove_spans(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
    rows = [[{"start": a, "end": b} for a, b in s] for s in spans]
    return pa.record_batch([pa.array(ids, kind), pa.array(counts, pa.int64()), pa.array(rows, _SPAN_TYPE), pa.array(items, pa.list_(pa.string())), pa.array(clean, pa.string())], names)


def _one_slice(docs: DataFrame, id_col: str, text_col: str, items: list[tuple[object, str | None]], shard_bytes: int) -> DataFrame:
    """Index each shard and search the whole benchmark in it."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    names = [id_col, "n_words", "spans", "items", "clean_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(shared.value)
        for kind, ids, texts in _shards(batches, shard_bytes):
            shard = Shard(texts)
            spans, hits = shard.search(phrases)
            yield _found(kind, names, ids, shard.counts.tolist(), spans, [sorted(h) for h in hits], texts)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words long, spans {_SPANS}, items array<string>, clean_text string")


def _indexes(keyed: DataFrame, shard_bytes: int) -> DataFrame:
    """(rows, index): the index of each shard of (row, text), and the rows of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, texts in _shards(batches, shard_bytes):
            yield pa.record_batch([pa.array([rows], pa.list_(pa.int64())), pa.array([pickle.dumps(Shard(texts), 5)], pa.large_binary())], ["rows", "index"])

    return keyed.select("row", "text").mapInArrow(run, "rows array<long>, index binary")


def _searched(indexes: DataFrame, items: list[tuple[object, str | None]]) -> DataFrame:
    """(row, spans, items) of the texts that a slice of the benchmark hits."""
    shared = indexes.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(shared.value)
        for b in batches:
            for k in range(b.num_rows):
                spans, hits = pickle.loads(b[1][k].as_py()).search(phrases)  # written by _indexes
                rows = b[0][k].as_py()
                met = [d for d, s in enumerate(spans) if s]
                yield pa.record_batch([
                    pa.array([rows[d] for d in met], pa.int64()),
                    pa.array([[{"start": x, "end": y} for x, y in spans[d]] for d in met], _SPAN_TYPE),
                    pa.array([sorted(hits[d]) for d in met], pa.list_(pa.string())),
                ], ["row", "spans", "items"])

    return indexes.mapInArrow(run, f"row long, spans {_SPANS}, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(id, n_words, spans, items, clean_text) for each row: merged spans of hit words [start, end), item ids, the text without the spans."""
    ship(docs.sparkSession)
    size = benchmark.agg(F.sum(F.coalesce(F.octet_length(item_text_col), F.lit(0)) + 32)).first()[0] or 0
    slices = max(1, -(-size // slice_bytes))
    part = F.pmod(F.xxhash64(item_col, item_text_col), F.lit(slices))
    take = lambda k: [(r[0], r[1]) for r in benchmark.where(part == k).select(item_col, item_text_col).collect()]  # noqa: E731  one slice, of checked size
    if slices == 1:
        return _one_slice(docs, id_col, text_col, take(0), shard_bytes)
    keyed = materialize(docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text")), "fm-rows")
    indexes = materialize(_indexes(keyed, shard_bytes), "fm-indexes")
    found = None
    for k in range(slices):
        one = materialize(_searched(indexes, take(k)), "fm-found")
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))  # a row for each slice at most
    names = [id_col, "n_words", "spans", "items", "clean_text"]

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = b[1].to_pylist(), []
            for s in b[2].to_pylist():
                own: list[tuple[int, int]] = []
                for x, y in sorted((x["start"], x["end"]) for x in s or []):
                    if own and x <= own[-1][1]:
                        own[-1] = (own[-1][0], max(y, own[-1][1]))
                    else:
                        own.append((x, y))
                spans.append(own)
            yield _found(b.schema.field(0).type, names, b[0].to_pylist(), [len(words_of(t)) for t in texts], spans, [x or [] for x in b[3].to_pylist()], texts)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = keyed.join(merged, "row", "left").select(F.col("id").alias(id_col), "text", "spans", "items")
    return rows.mapInArrow(close, f"`{id_col}` {kind}, n_words long, spans {_SPANS}, items array<string>, clean_text string")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with all columns, their texts without the spans of benchmark phrases."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    found = decontaminate(docs.select(others.alias("doc"), F.col(text_col).alias("text")), benchmark, "doc", "text")
    return found.select(*(F.col("clean_text").alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns))
