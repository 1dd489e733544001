"""Substring dedup by recompression.

Documents are packed in chunks of bounded size: word codes over the chunk's own
vocabulary. Rounds of recompression rename each chunk's word sequence: maximal
runs of a symbol, then pairs of a symbol from one half of the alphabet and a
symbol from the other. A name is a function of the names that it stands for, so
equal substrings get equal interior symbols in every chunk. With each symbol goes
its context, the words on which its making depends: a symbol whose context lies
within a window is the same in every occurrence of the window.

After each round Spark exchanges the names of its new symbols, which tells for the
whole corpus the ones that more than one document holds. A pair or run is sent only
if all its parts are held so, for else it cannot be; so a round costs less than the
one before. There are as many rounds as have contexts that fit into a window. A
window that covers a symbol which one document alone holds, context and all, stands
in no other document. The windows that are left, whose symbols of all levels are
shared, are verified by 96 bits of all their words, and the smallest document id of
each is found.

What comes back to a chunk is a bit for each of its names and windows; all counting
is done on sorted arrays, and a chunk sends each name once, so a passage that a
third of all documents share costs a name for each chunk. Chunks are dealt out once
and stay where they are; only names and bits travel after that.

Defined cases: null and empty texts have no words; texts of fewer words than a
window lose nothing; null ids count as larger than any other; rows with equal ids
never remove each other's words; ids that aren't whole numbers are taken by their
order; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from ..storage import keep, materialize, replayable, ship

WINDOW = 13
ROUNDS = 2  # a symbol of the third depends on more words than a window has, but for few
CHUNK_BYTES = 4 << 20  # bytes of text in a chunk
BUCKET_BYTES = 32 << 20  # bytes of text for which there is a bucket of names
NO_ID = np.iinfo(np.int64).max

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64's constants
_RUN, _LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


class Level:
    """A sequence of symbols: names, first words, ends, contexts and the document of each."""

    def __init__(self, name: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> None:
        self.name, self.start, self.end, self.left, self.right, self.doc = name, start, end, left, right, doc

    def runs(self) -> Level:
        """Each maximal run becomes a symbol. It depends on the symbols on both sides of it."""
        n = len(self.name)
        new = np.ones(n, bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, n))
        tail = head + size - 1
        before, after = np.maximum(head - 1, 0), np.minimum(tail + 1, n - 1)
        own_before = (head > 0) & (self.doc[before] == self.doc[head])
        own_after = (tail < n - 1) & (self.doc[after] == self.doc[tail])
        start, end = self.start[head], self.end[tail]
        left = np.where(own_before, np.minimum(self.left[before], self.left[head]), start - 1)
        right = np.where(own_after, np.maximum(self.right[after], self.right[tail]), end + 1)
        name = np.where(size > 1, mix(self.name[head] ^ (size.astype(np.uint64) * _RUN)), self.name[head])
        return Level(name, start, end, left, right, self.doc[head])

    def pairs(self, salt: int) -> Level:
        """Each pair of a symbol of the one half and a symbol of the other becomes a symbol."""
        n = len(self.name)
        half = (mix(self.name + np.uint64(salt * int(_LEFT) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(63)).astype(bool)
        joined = np.zeros(n, bool)  # with the next
        joined[:-1] = ~half[:-1] & half[1:] & (self.doc[:-1] == self.doc[1:])
        second = np.zeros(n, bool)
        second[1:] = joined[:-1]
        head = np.flatnonzero(~second)
        is_pair = joined[head]
        nxt, prev = np.minimum(head + 1, n - 1), np.maximum(head - 1, 0)
        tail = np.where(is_pair, nxt, head)
        start, end = self.start[head], self.end[tail]
        has_next = (head < n - 1) & (self.doc[nxt] == self.doc[head])
        has_prev = (head > 0) & (self.doc[prev] == self.doc[head])
        low = ~half[head]  # depends on the next symbol, others on the one before
        left, right = self.left[head], self.right[tail]
        right = np.where(~is_pair & low, np.where(has_next, np.maximum(right, self.right[nxt]), end + 1), right)
        left = np.where(is_pair, np.minimum(left, self.left[tail]), np.where(low, left, np.where(has_prev, np.minimum(left, self.left[prev]), start - 1)))
        right = np.where(is_pair, np.maximum(right, self.right[head]), right)
        left = np.where(~is_pair & low & has_next, np.minimum(left, self.left[nxt]), left)
        right = np.where(~is_pair & ~low & has_prev, np.maximum(right, self.right[prev]), right)
        name = np.where(is_pair, mix(self.name[head] * _LEFT + mix(self.name[tail] + _RIGHT)), self.name[head])
        return Level(name, start, end, left, right, self.doc[head])


def distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, in order; whether two documents hold it; the place of each key among them."""
    order = np.argsort(keys, kind="stable")
    s, d = keys[order], docs[order]
    if not len(s):
        return s, np.zeros(0, bool), np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    place = np.empty(len(s), np.int64)
    place[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(s))))
    return s[head], np.minimum.reduceat(d, head) != np.maximum.reduceat(d, head), place


def window_names(words: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of the window at each word (of no meaning near the end)."""
    n = len(words)
    out = []
    for base, salt in zip(_BASES, (0, 1), strict=True):
        w = mix(words + np.uint64(salt) * _RIGHT)
        h = np.zeros(n, np.uint64)
        power = np.uint64(1)
        for d in range(window - 1, -1, -1):
            h[: n - d] += w[d:] * power
            power = np.uint64(int(power) * base & 0xFFFFFFFFFFFFFFFF)
        out.append(mix(h))
    return out[0], out[1]


def _planes(codes: np.ndarray) -> bytes:
    """The bytes of the codes by significance: common words have small codes, so the higher ones are mostly zero."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """ids, word counts, codes, vocabulary and the vocabulary's names of a chunk."""
    import xxhash
    import zstandard

    unzip = zstandard.ZstdDecompressor().decompress
    vocabulary = unzip(row["vocabulary"]).split()
    names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
    planes = np.frombuffer(unzip(row["codes"]), np.uint8).reshape(4, -1)
    codes = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int32).astype(np.int64), codes, vocabulary, names


def _pack_ids(ids: np.ndarray) -> bytes:
    """The least id, then 32-bit distances from it, or 64-bit ones if they need it."""
    base = int(ids.min(initial=NO_ID))
    wide = len(ids) and int(ids.max()) - base >= 1 << 32
    return np.array([base, 8 if wide else 4], np.int64).tobytes() + (ids - base).astype(np.int64 if wide else np.uint32).tobytes()


def _unpack_ids(data: bytes) -> np.ndarray:
    base, width = np.frombuffer(data[:16], np.int64)
    return np.frombuffer(data[16:], np.int64 if width == 8 else np.uint32).astype(np.int64) + base


class ChunkWindows:
    """The windows of a chunk: those that lie within one document, and their anchors."""

    def __init__(self, row: dict, window: int) -> None:
        self.ids, self.counts, self.codes, self.vocabulary, names = _unpacked(row)
        self.words = names[self.codes] if len(self.codes) else np.zeros(0, np.uint64)
        self.sizes = np.fromiter(map(len, self.vocabulary), np.int64, len(self.vocabulary))[self.codes] if len(self.codes) else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        ends = np.cumsum(self.counts)
        at = np.arange(len(self.words))
        self.start = at[at + window <= np.repeat(ends, self.counts)]

    def copies(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that hold a window, in the order of two names of their whole word sequence."""
        import xxhash

        docs = np.flatnonzero(self.counts >= window)
        heads = np.cumsum(self.counts) - self.counts
        digests = b"".join(xxhash.xxh3_128_digest(self.words[heads[d] : heads[d] + self.counts[d]].tobytes()) for d in docs)
        h = np.frombuffer(digests, "<u8").reshape(-1, 2)
        order = np.lexsort((h[:, 1], h[:, 0]))
        return h[order, 0], h[order, 1], docs[order]

    def levels(self, window: int, shared: list[np.ndarray]) -> Iterator[tuple[Level, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each round: its level, the symbols whose names are sent, those names in order, whether two documents of the chunk hold them, and each symbol's place among them.

        shared: of the rounds that have come back, which of the names sent stand
        in several documents; one round more than these is given.
        """
        at = np.arange(len(self.words), dtype=np.int64)
        level = Level(self.words, at, at + 1, at, at + 1, self.doc)
        lonely = np.zeros(len(self.words) + 1, np.int64)  # by first word: symbols that one document alone holds
        before: np.ndarray | None = None
        for k in range(len(shared) + 1):
            level = level.runs().pairs(k + 1)
            fit = (level.right - level.left <= window) if len(level.name) else np.zeros(0, bool)
            if before is None:
                sent = np.arange(len(level.name))
            else:
                alone = np.concatenate(([0], np.cumsum(lonely[:-1])))
                new = np.diff(np.searchsorted(before, np.append(level.start, len(self.words)))) > 1  # made of several symbols of the last round
                sent = np.flatnonzero(new & fit & (alone[level.end] == alone[level.start]))
            keys, several, place = distinct(mix(level.name[sent]), level.doc[sent])
            if k < len(shared):
                lost = sent[~shared[k][place]] if len(sent) else sent
                lonely[level.start[lost]] = 1
            yield level, sent, keys, several, place
            before = level.start

    def open_windows(self, window: int, shared: list[np.ndarray]) -> np.ndarray:
        """Which windows cover no symbol, context and all, that one document alone holds."""
        closed = np.zeros(len(self.words) + 1, np.int32)
        for k, (level, sent, _, _, place) in enumerate(self.levels(window, shared[:-1])):
            lost = sent[~shared[k][place]] if len(sent) else sent
            left, right = level.left[lost], level.right[lost]
            fit = (right - left <= window) & (left >= 0)
            first, last = np.maximum(right[fit] - window, 0), left[fit]  # windows that start so cover it
            np.add.at(closed, first, 1)
            np.add.at(closed, last + 1, -1)
        return np.cumsum(closed[:-1])[self.start] == 0

    def candidates(self, window: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each chosen window's content once: two names, its smallest id in the chunk; and the place of each chosen window."""
        h1, h2 = window_names(self.words, window)
        at = self.start[chosen]
        h1, h2, ids = h1[at], h2[at] >> np.uint64(32), self.ids[self.doc[at]]
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        head = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
        place = np.zeros(len(at), np.int64)
        if len(head):
            place[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(a))))
            least = np.minimum.reduceat(ids[order], head)
        else:
            least = np.zeros(0, np.int64)
        return a[head], b[head], least, place


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each bucket's stretch of sorted keys (buckets are ranges of keys)."""
    edges = [(k << 64) // buckets for k in range(1, buckets)]
    cut = np.searchsorted(keys, np.array(edges, np.uint64), side="left")
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(keys)]))


def _gather(parts: list[dict], buckets: range) -> np.ndarray:
    """The bits that came back to a chunk, in the order of its sorted keys."""
    by = {p["bucket"]: p for p in parts or []}
    got = [np.unpackbits(np.frombuffer(by[k]["bits"], np.uint8), count=by[k]["n"]) for k in buckets if k in by]
    return np.concatenate(got).astype(bool) if got else np.zeros(0, bool)


def pack(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """One row for each chunk of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=3).compress
        part, number = TaskContext.get().partitionId(), 0

        def done(ids: list, texts: list[bytes]) -> pa.RecordBatch:
            codes: dict[bytes, int] = {}
            each, counts = [np.zeros(0, np.uint32)], []
            for t in texts:
                w = t.split()
                counts.append(len(w))
                for x in w:
                    if x not in codes:
                        codes[x] = len(codes)
                each.append(np.fromiter(map(codes.__getitem__, w), np.uint32, len(w)))
            own = np.array([NO_ID if i is None else i for i in ids], np.int64)
            every, vocabulary = np.concatenate(each), [*codes]
            order = np.argsort(-np.bincount(every, minlength=len(codes)), kind="stable")  # the commonest first
            place = np.empty(len(codes), np.uint32)
            place[order] = np.arange(len(codes), dtype=np.uint32)
            row = [(part << 40) + number, own.tobytes(), np.array(counts, np.int32).tobytes(), squeeze(_planes(place[every])), squeeze(b" ".join([vocabulary[k] for k in order.tolist()]))]
            return pa.record_batch([pa.array([row[0]], pa.int64()), *(pa.array([x], pa.binary()) for x in row[1:])], ["chunk", "ids", "counts", "codes", "vocabulary"])

        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True):
                ids.append(i)
                texts.append((t or "").encode())
                held += len(texts[-1])
                if held >= chunk_bytes:
                    yield done(ids, texts)
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield done(ids, texts)

    return docs.select(id_col, text_col).mapInArrow(run, "chunk long, ids binary, counts binary, codes binary, vocabulary binary")


_SENT = "bucket long, chunk long, a binary, b binary, c binary"
_BACK = "chunk long, bucket long, n int, bits binary"


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["bucket", "chunk", "a", "b", "c"])


def _back(table: pa.Table, flags: list[np.ndarray]) -> pa.Table:
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "n": pa.array([len(f) for f in flags], pa.int32()), "bits": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary())})


def _first_exchange(buckets: int):  # noqa: ANN202
    """Buckets of names, then as many of whole documents."""
    return lambda table: (_shared_names if table["bucket"][0].as_py() < buckets else _earlier)(table)


def _second_exchange(table: pa.Table) -> pa.Table:
    """Buckets of windows; a negative one hands a chunk's choice of windows on."""
    if table["bucket"][0].as_py() >= 0:
        return _earlier(table)
    return _back(table, [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table["a"].to_pylist(), (int.from_bytes(y, "little") for y in table["b"].to_pylist()), strict=True)])


def _shared_names(table: pa.Table) -> pa.Table:
    """Which of the names of a bucket more than one document holds."""
    keys = [np.frombuffer(x, np.uint64) for x in table["a"].to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool) for x, k in zip(table["b"].to_pylist(), keys, strict=True)]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    s = every[order]
    again = np.zeros(len(s), bool)
    if len(s):
        same = s[1:] == s[:-1]
        again[1:] |= same
        again[:-1] |= same
    flag = np.empty(len(s), bool)
    flag[order] = again
    flag |= np.concatenate(several)
    return _back(table, np.split(flag, np.cumsum([len(k) for k in keys])[:-1]))


def _earlier(table: pa.Table) -> pa.Table:
    """Which of the windows (or whole documents) of a bucket a document with a smaller id has, too."""
    h1 = [np.frombuffer(x, np.uint64) for x in table["a"].to_pylist()]
    a, b = np.concatenate(h1), np.concatenate([np.frombuffer(x, np.uint32) for x in table["b"].to_pylist()])
    ids = np.concatenate([_unpack_ids(x) for x in table["c"].to_pylist()])
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    flag = np.zeros(len(a), bool)
    if len(a):
        head = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))
        least = np.repeat(np.minimum.reduceat(ids[order], head), np.diff(np.append(head, len(a))))
        flag[order] = least < ids[order]
    return _back(table, np.split(flag, np.cumsum([len(k) for k in h1])[:-1]))


def _numbered(docs: DataFrame, id_col: str) -> DataFrame:
    """(id, rank): the ids in their order, numbered by range, not in one task."""
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    laid = materialize(ids.repartitionByRange(n, "id").select("id", F.spark_partition_id().alias("part")), "ids")
    counts = {r.part: r.n for r in laid.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each partition
    before, at = F.lit(0).cast("long"), 0
    for part in sorted(counts):
        before = F.when(F.col("part") == part, F.lit(at).cast("long")).otherwise(before)
        at += counts[part]
    return materialize(laid.select("id", (F.row_number().over(Window.partitionBy("part").orderBy("id")) + before).alias("rank")), "ranks")


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """(id, n_words, n_removed, kept_text) for each row: without words of windows that a document with a smaller id also has."""
    spark = docs.sparkSession
    ship(spark)
    if not isinstance(docs.schema[id_col].dataType, ByteType | ShortType | IntegerType | LongType):
        ranks = _numbered(docs, id_col)
        placed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ranks, "id", "left").select("rank", "text")
        left = dedup(placed, window, "rank", "text", chunk_bytes, bucket_bytes, rounds)
        return left.join(ranks, "rank", "left").select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_text")
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = pack(replayable(docs.select(F.col(id_col).cast("long").alias(id_col), text_col)), id_col, text_col, chunk_bytes)
    chunks = keep(packed.repartition(spread, "chunk"))  # dealt out once
    buckets = max(1, -(-chunks.count() * chunk_bytes // bucket_bytes))
    windows = 2 * buckets  # windows take more bytes than names
    parts = lambda df, name: df.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias(name))  # noqa: E731  a row for each bucket at most
    back: list[DataFrame] = []

    def met() -> DataFrame:
        """Chunks with the bits that have come back in each exchange."""
        out = chunks
        for k, bits in enumerate(back):
            out = out.join(parts(bits, f"p{k}"), "chunk", "left")
        return out

    def send_names(number: int):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    c = ChunkWindows(row, window)
                    shared = [_gather(row[f"p{k}"], range(buckets)) for k in range(number)]
                    *_, (_, _, keys, several, _) = c.levels(window, shared)
                    rows = [(k, row["chunk"], keys[x:y].tobytes(), np.packbits(several[x:y]).tobytes(), b"") for k, (x, y) in enumerate(zip(*_by_bucket(keys, buckets), strict=True)) if y > x]
                    if not number:  # whole documents go with the first round
                        h1, h2, held = c.copies(window)
                        h2, ids = (h2 >> np.uint64(32)).astype(np.uint32), c.ids[held]
                        rows += [(buckets + k, row["chunk"], h1[x:y].tobytes(), h2[x:y].tobytes(), _pack_ids(ids[x:y])) for k, (x, y) in enumerate(zip(*_by_bucket(h1, buckets), strict=True)) if y > x]
                    if rows:
                        yield _sent(rows)

        return run

    for number in range(rounds):
        named = met().mapInArrow(send_names(number), _SENT).groupBy("bucket").applyInArrow(_first_exchange(buckets), _BACK)
        back.append(materialize(named, "name-bits", compact=True))

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = ChunkWindows(row, window)
                _, _, held = c.copies(window)
                copied = np.zeros(len(c.counts), bool)  # of a document with a smaller id: all words go
                copied[held] = _gather(row["p0"], range(buckets, 2 * buckets))
                chosen = c.open_windows(window, [_gather(row[f"p{k}"], range(buckets)) for k in range(rounds)]) & ~copied[c.doc[c.start]]
                h1, h2, least, _ = c.candidates(window, np.flatnonzero(chosen))
                h2 = h2.astype(np.uint32)
                rows = [(k, row["chunk"], h1[x:y].tobytes(), h2[x:y].tobytes(), _pack_ids(least[x:y])) for k, (x, y) in enumerate(zip(*_by_bucket(h1, windows), strict=True)) if y > x]
                for mark, bits in ((0, chosen), (1, copied)):
                    rows.append((-1 - 2 * row["chunk"] - mark, row["chunk"], np.packbits(bits).tobytes(), len(bits).to_bytes(8, "little"), b""))
                yield _sent(rows)

    verified = materialize(met().mapInArrow(send_windows, _SENT).groupBy("bucket").applyInArrow(_second_exchange, _BACK), "window-bits", compact=True)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = ChunkWindows(row, window)
                mine = lambda mark, r=row: _gather(r["parts"], range(-1 - 2 * r["chunk"] - mark, -2 * r["chunk"] - mark))
                chosen, copied = np.flatnonzero(mine(0)), mine(1)
                _, _, least, place = c.candidates(window, chosen)
                before = _gather(row["parts"], range(windows))
                at = c.start[chosen]
                if len(at):
                    at = at[before[place] | (least[place] < c.ids[c.doc[at]])]
                marks = np.zeros(len(c.words) + 1, np.int32)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + window, -1)
                gone = (np.cumsum(marks[:-1]) > 0) | copied[c.doc]
                texts, removed, x = [], [], 0
                word = c.vocabulary.__getitem__
                for n in c.counts.tolist():
                    own, out = c.codes[x : x + n], gone[x : x + n]
                    texts.append(b" ".join(map(word, own[~out].tolist())).decode())
                    removed.append(int(out.sum()))
                    x += n
                ids = [None if i == NO_ID else i for i in c.ids.tolist()]
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(c.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], [id_col, "n_words", "n_removed", "kept_text"])

    done = chunks.join(parts(verified, "parts"), "chunk", "left")
    return done.mapInArrow(remove, f"`{id_col}` long, n_words long, n_removed long, kept_text string")
