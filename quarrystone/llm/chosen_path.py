"""N-gram Jaccard join by chosen paths.

Documents are sets of shingles (five folded words; a text with fewer words, but
some, is one shingle). Equal sets are one record. A record is embedded as a fixed
number of min-hash tokens; a run starts with all records in one node, and each
node chooses a few token places from its own path, on average 1/threshold of
them: records that share the token at a chosen place go to the same child. Nodes
of few records are compared by brute force over small sketches, larger ones are
split further. A large node is settled without that if all its records but a few
agree with one of them: those are one class, and only the few are compared with
all others, so nothing is left that splitting could find. Runs are repeated as often as the survival of a pair at the
threshold requires for the target recall. Nodes that are still large at the last
depth hold near copies of one text; all their records are taken as candidates.

Candidates form loose classes. Within each, the whole shingle sets are compared
exactly, in tiles of bounded size when a class is large; tiles return counts of
links and a spanning forest, never pairs. A class of n records is dealt into about
sqrt(n / tile) blocks, each of which meets each other one in a task, so a record is
sent as often as there are blocks; within the task, tiles are compared one by one. Exact classes are the components.

Defined cases: a null text is alone; texts without words are linked only to equal
texts; equal texts are always linked, so repeated rows are links of each other;
null ids are ignored when a class is named, and a class without any id is named
null; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import keep, materialize, replayable, ship
from .components import components
from .fm_index import words_of
from .recompression import mix

SHINGLE = 5
THRESHOLD = 0.8
TOKENS = 64  # min-hash tokens of a record
DEPTH = 4  # deepest split
LEAF = 128  # records of a node that is compared by brute force
RECALL = 0.999  # of pairs at the threshold, by the paths alone
PIVOTS = 4  # records of a large node of which one may settle it
SKETCH_SLACK = 0.25  # sketches may fall short of the threshold by so much (five deviations)
TILE = 512  # records on a side of an exact comparison
BLOCK_BYTES = 64 << 20  # shingles of a block of records that travels as a whole

_B = np.uint64(0xD1342543DE82EF95)
_C = np.uint64(0x9E3779B97F4A7C15)


def path_recall(similarity: float, runs: int, threshold: float = THRESHOLD, depth: int = DEPTH, tokens: int = TOKENS) -> float:
    """The probability that a pair meets in a node of the deepest level in some run.

    Runs choose their places anew, but all from the same tokens: of these a pair
    shares a binomial number. The nodes in which it stays together are a branching
    process; each has 1/threshold children on average, a Poisson number, of which
    the pair shares as many as it shares tokens.
    """
    missed = 0.0
    for shared in range(tokens + 1):
        alive = 1.0
        for _ in range(depth):
            alive = 1 - math.exp(-alive * shared / tokens / threshold)
        missed += math.comb(tokens, shared) * similarity**shared * (1 - similarity) ** (tokens - shared) * (1 - alive) ** runs
    return 1 - missed


def runs_for(recall: float, threshold: float, depth: int, tokens: int = TOKENS) -> int:
    """The least number of runs after which a pair at the threshold has met with the wanted probability."""
    most = 1_000  # beyond, a pair that shares too few tokens isn't met by more runs either
    return next((r for r in range(1, most) if path_recall(threshold, r, threshold, depth, tokens) >= recall), most)


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit names of the shingles of each text."""
    import xxhash

    codes: dict[bytes, int] = {}
    each, counts = [], []
    for t in texts:
        w = words_of(t)
        for x in w:
            if x not in codes:
                codes[x] = len(codes)
        each.append(np.fromiter(map(codes.__getitem__, w), np.int64, len(w)))
        counts.append(len(w))
    if not codes:
        return [np.zeros(0, np.uint64) for _ in texts]
    names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in codes), np.uint64, len(codes))
    words = mix(names)[np.concatenate(each)]
    n = len(words)
    h = np.zeros(n, np.uint64)
    power = np.uint64(1)
    for d in range(size - 1, -1, -1):
        h[: max(0, n - d)] += words[d:] * power
        power = np.uint64(int(power) * int(_B) & 0xFFFFFFFFFFFFFFFF)
    h = mix(h)
    out, at = [], 0
    for c in counts:
        if c >= size:
            out.append(np.unique(h[at : at + c - size + 1]))
        elif c:
            x = np.uint64(c)
            for w in words[at : at + c]:
                x = np.uint64((int(x) * int(_B) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([x], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def signatures(sets: list[np.ndarray], tokens: int = TOKENS) -> np.ndarray:
    """Min-hash tokens of each non-empty set (zeros for empty ones)."""
    out = np.zeros((len(sets), tokens), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    sizes = np.array([len(sets[i]) for i in full])
    heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    x = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
    rng = np.random.default_rng(20_240_229)
    factors = rng.integers(0, 1 << 31, tokens, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 1 << 32, tokens, dtype=np.uint32)
    for k in range(tokens):
        y = x * factors[k]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        y += shifts[k]
        out[full, k] = np.minimum.reduceat(y, heads)
    return out


def children(paths: np.ndarray, signature: np.ndarray, tokens: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and child paths: each node chooses places by its path; a child is a place and the token there."""
    chance = np.uint64(min(0xFFFFFFFFFFFFFFFF, int(2**64 / (threshold * tokens))))
    unique, back = np.unique(paths, return_inverse=True)
    places = mix(unique[:, None] ^ mix(np.arange(1, tokens + 1, dtype=np.uint64) * _C)[None, :]) < chance
    rows, at = np.nonzero(places[back])
    return rows, mix(paths[rows] * _B + mix((at.astype(np.uint64) << np.uint64(32)) | signature[rows, at].astype(np.uint64)))


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each index's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
    return label


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Whole groups of rows that follow each other with equal first `keys` columns; several groups at a time."""
    rest: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        cols = [t.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in range(keys)]
        differ = np.zeros(t.num_rows, bool)
        for c in cols:
            differ |= c != c[-1]
        cut = int(np.flatnonzero(differ)[-1]) + 1 if differ.any() else 0
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _fixed(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, key, sig, n): key is a digest of the shingle set, sig the record's tokens, n the number of its shingles."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts = b[2].to_pylist()
                sets = shingle_sets(texts)
                keys = [xxhash.xxh3_128_digest(b"s" + s.tobytes()) if len(s) else None if t is None else xxhash.xxh3_128_digest(b"t" + t.encode()) for s, t in zip(sets, texts, strict=True)]
                sig = signatures(sets)
                yield pa.record_batch([b[0], b[1], pa.array(keys, pa.binary()), pa.array([x.tobytes() if len(s) else None for x, s in zip(sig, sets, strict=True)], pa.binary()), pa.array(map(len, sets), pa.int64())], ["id", "th", "key", "sig", "n"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, th long, key binary, sig binary, n long").withColumn("row", F.monotonically_increasing_id())


def _first_nodes(runs: int, tokens: int, threshold: float):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rec, sig = b[0].to_numpy(), _fixed(pa.chunked_array([b[1]]), np.uint32, tokens)
            for r in range(runs):
                rows, paths = children(np.full(len(rec), mix(np.array([r + 1], np.uint64))[0]), sig, tokens, threshold)
                yield pa.record_batch([pa.array(paths.view(np.int64)), pa.array(rec[rows])], ["path", "rec"])

    return run


def _next_nodes(tokens: int, threshold: float):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rec, sig = b[1].to_numpy(), _fixed(pa.chunked_array([b[2]]), np.uint32, tokens)
            rows, paths = children(b[0].to_numpy().view(np.uint64), sig, tokens, threshold)
            yield pa.record_batch([pa.array(paths.view(np.int64)), pa.array(rec[rows])], ["path", "rec"])

    return run


def _leaf_links(tokens: int, least: float):  # noqa: ANN202
    """Within each small node: a spanning forest of the records whose sketches agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 1):
            path, rec = (t.column(k).combine_chunks().to_numpy() for k in (0, 1))
            sketch = _fixed(t.column(2), np.uint8, tokens)
            n, a, b, d = len(path), [], [], 1
            at = np.arange(n - 1)
            while len(at := at[at < n - d]) and len(at := at[path[at] == path[at + d]]):
                for part in np.array_split(at, len(at) // 65_536 + 1):
                    met = part[(sketch[part] == sketch[part + d]).sum(1) >= least * tokens]
                    a.append(met)
                    b.append(met + d)
                d += 1
            if a:
                label = _labels(n, np.concatenate(a), np.concatenate(b))
                own = np.flatnonzero(label != np.arange(n))
                if len(own):
                    yield pa.record_batch([pa.array(rec[own]), pa.array(rec[label[own]])], ["a", "b"])

    return run


def _far(tokens: int, least: float):  # noqa: ANN202
    """The other columns, then for each pivot of a record's node: whether their sketches agree too little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, pivots = (_fixed(pa.chunked_array([b.column(c)]), np.uint8, tokens) for c in ("sketch", "pivots"))
                many = len(pivots) // b.num_rows
                far = (pivots.reshape(-1, many, tokens) == own[:, None, :]).sum(2) < least * tokens
                lists = pa.ListArray.from_arrays(np.arange(0, far.size + 1, many, dtype=np.int32), pa.array(far.ravel()))
                names = [c for c in b.schema.names if c != "pivots"]
                yield pa.record_batch([*(b.column(c) for c in names), lists], [*names, "far"])

    return run


def _few_links(tokens: int, least: float):  # noqa: ANN202
    """Within each settled node: a spanning forest of the few and the records whose sketches agree with theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            path, rec, sketch = b[0].to_numpy(), b[1].to_numpy(), _fixed(pa.chunked_array([b[2]]), np.uint8, tokens)
            edge = np.flatnonzero(np.concatenate(([True], path[1:] != path[:-1], [True])))
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                few = b[3][int(s)].as_py()
                both = np.concatenate((np.array([x["rec"] for x in few]), rec[s:e]))
                other = np.frombuffer(b"".join(x["sketch"] for x in few), np.uint8).reshape(-1, tokens)
                met = [np.flatnonzero((sketch[s:e] == x).sum(1) >= least * tokens) for x in other]
                label = _labels(len(both), np.repeat(np.arange(len(few)), [len(x) for x in met]), len(few) + np.concatenate(met))
                own = np.flatnonzero(both != both[label])
                if len(own):
                    yield pa.record_batch([pa.array(both[own]), pa.array(both[label[own]])], ["a", "b"])

    return run


def _settled(large: DataFrame, records: DataFrame, leaf: int, least: float, tokens: int) -> tuple[DataFrame, list[DataFrame]]:
    """Paths of nodes that need no splitting, and the links (a, b) that hold the candidates of each together.

    Records that agree with a pivot are one class. Of a settled node no more than `leaf`
    others are left, and each of them is compared with all records, as within a leaf.
    Steps are written, not kept: a kept table brings the plans of all that it is made from
    into each plan that reads it, and the driver holds and tells of those with every stage.
    """
    rows = materialize(large.join(records.select("rec", "sketch"), "rec").select("path", "rec", "sketch"), "large")
    drawn = (F.min(F.struct(F.xxhash64("rec", F.lit(q)).alias("h"), "sketch"))["sketch"] for q in range(PIVOTS))
    pivots = materialize(rows.groupBy("path").agg(*(x.alias(f"p{q}") for q, x in enumerate(drawn))).select("path", F.concat(*(f"p{q}" for q in range(PIVOTS))).alias("pivots")), "pivots")
    judged = rows.join(pivots.hint("merge"), "path").select("path", "rec", "sketch", "pivots").mapInArrow(_far(tokens, least), "path long, rec long, sketch binary, far array<boolean>")
    counted = judged.groupBy("path").agg(
        F.array(*(F.count_if(F.col("far")[q]) for q in range(PIVOTS))).alias("n"), F.array(*(F.min(F.when(~F.col("far")[q], F.col("rec"))) for q in range(PIVOTS))).alias("first")
    )
    best = (F.array_position("n", F.array_min("n")) - 1).cast("int")
    enough = counted.where(F.array_min("n") <= leaf).select("path", best.alias("q"), F.get("first", best).alias("first"))
    paths = materialize(enough.join(pivots, "path").select("path", "first", F.substring("pivots", F.col("q") * tokens + 1, F.lit(tokens)).alias("pivots")), "settled")
    inside = rows.join(paths.hint("merge"), "path").select("path", "rec", "sketch", "first", "pivots").mapInArrow(_far(tokens, least), "path long, rec long, sketch binary, first long, far array<boolean>")
    inside = materialize(inside.withColumn("far", F.col("far")[0]), "inside")
    few = materialize(inside.where("far").groupBy("path").agg(F.collect_list(F.struct("rec", "sketch")).alias("few")), "few")  # no more than leaf
    compared = inside.join(few.hint("merge"), "path").select("path", "rec", "sketch", "few").mapInArrow(_few_links(tokens, least), "a long, b long")
    return paths.select("path"), [inside.where(~F.col("far") & (F.col("rec") != F.col("first"))).select(F.col("rec").alias("a"), F.col("first").alias("b")), compared]


def loose_links(records: DataFrame, threshold: float, recall: float, depth: int, leaf: int, tokens: int) -> DataFrame:
    """(a, b): links that hold all candidates together; records: (rec, sig)."""
    nodes = keep(records.mapInArrow(_first_nodes(runs_for(recall, threshold, depth), tokens, threshold), "path long, rec long"))
    leaves, links = [], []
    for level in range(1, depth + 1):
        sizes = keep(nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), now=True)  # apart, so that Spark can split a hot node in the join
        met = materialize(nodes.join(sizes.hint("merge"), "path").select("path", "rec", (F.col("n") > leaf).alias("large")), "nodes", compact=True)
        for x in (nodes, sizes):
            x.unpersist()
        leaves.append(met.where(~F.col("large")).select("path", "rec"))
        large = met.where("large").select("path", "rec")
        if large.isEmpty():
            break
        if level < depth:
            settled, held = _settled(large, records, leaf, threshold - SKETCH_SLACK, tokens)
            links += held
            nodes = keep(large.join(settled.hint("merge"), "path", "left_anti").join(records, "rec").select("path", "rec", "sig").mapInArrow(_next_nodes(tokens, threshold), "path long, rec long"))
        else:
            head = materialize(large.groupBy("path").agg(F.min("rec").alias("b")), "heads")
            links.append(large.join(head.hint("merge"), "path").select(F.col("rec").alias("a"), "b").where(F.col("a") != F.col("b")))
    every = leaves[0]
    for x in leaves[1:]:
        every = every.unionByName(x)
    compared = every.join(records.select("rec", "sketch"), "rec").select("path", "rec", "sketch")
    n = max(1, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = compared.repartition(n, "path").sortWithinPartitions("path", "rec").mapInArrow(_leaf_links(tokens, threshold - SKETCH_SLACK), "a long, b long")
    for x in links:
        found = found.unionByName(x)
    return found


def _compare(left: list[np.ndarray], right: list[np.ndarray] | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of left, j of right or left) of sets whose similarity reaches least."""
    other = left if right is None else right
    sets = left if right is None else left + right
    sizes = np.array([len(s) for s in sets], np.float32)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[code]
    owner, code = owner[keep], place[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    n, m, width = len(left), len(other), int(shared.sum())
    both = np.zeros((n, m), np.float32)
    step = max(256, min(1 << 14, (16 << 20) // max(1, len(sets))))
    for at in range(0, width, step):
        lo, hi = np.searchsorted(code, [at, at + step])
        bits = np.zeros((len(sets), min(step, width - at)), np.float32)
        bits[owner[lo:hi], code[lo:hi] - at] = 1
        both += bits[:n] @ (bits if right is None else bits[n:]).T
    either = sizes[:n, None] + (sizes if right is None else sizes[n:])[None, :] - both
    hit = both.astype(np.float64) >= least * either.astype(np.float64)
    if right is None:
        hit = np.triu(hit, 1)
    return np.nonzero(hit)


def _blocks_compared(left: list[np.ndarray], right: list[np.ndarray] | None, least: float, tile: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The index pairs of _compare(), tile by tile."""
    other = left if right is None else right
    for a in range(0, len(left), tile):
        for b in range(a if right is None else 0, len(other), tile):
            own = right is None and a == b
            x, y = _compare(left[a : a + tile], None if own else other[b : b + tile], least)
            yield x + a, y + b


def _exact_tiles(least: float, tile: int):  # noqa: ANN202
    """Within each pair of blocks: links counted with the copies of the other record, and a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            comp, i, j, rec, block, weight = (t.column(k).combine_chunks().to_numpy() for k in range(6))
            sets = t.column(6)
            edge = np.flatnonzero(np.concatenate(([True], (comp[1:] != comp[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True])))
            out: list[list[np.ndarray]] = [[], [], []]
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                _, own = np.unique(rec[s:e], return_index=True)  # repeated rows bring a record again
                own += s
                arrays = [np.frombuffer(sets[k].as_buffer(), np.uint64) for k in own.tolist()]
                x = y = np.arange(len(own))
                if i[s] != j[s]:
                    x, y = np.flatnonzero(block[own] == i[s]), np.flatnonzero(block[own] == j[s])
                left = [arrays[k] for k in x]
                links, label = np.zeros(len(own), np.int64), np.arange(len(own))
                if len(x) and len(y):
                    for a, b in _blocks_compared(left, None if i[s] == j[s] else [arrays[k] for k in y], least, tile):
                        a, b = x[a], y[b]
                        np.add.at(links, a, weight[own][b])
                        np.add.at(links, b, weight[own][a])
                        label = _labels(len(own), np.concatenate((np.arange(len(own)), a)), np.concatenate((label, b))) if len(a) else label
                met = np.flatnonzero(links)
                if len(met):
                    out[0].append(rec[own][met])
                    out[1].append(links[met])
                    out[2].append(rec[own][label[met]])
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in out], ["rec", "links", "root"])

    return run


def join(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL, depth: int = DEPTH, leaf: int = LEAF, tile: int = TILE) -> DataFrame:
    """(id, th, row, class_id, n_links, first) for each row of docs.

    class_id is the smallest id of the row's class, n_links the number of other
    rows whose similarity reaches the threshold, th a hash of the text, and first
    tells the one row of each class that stays when the class is thinned out.
    """
    spark = docs.sparkSession
    ship(spark)
    seen = keep(_sketch(replayable(docs.select(id_col, text_col)), id_col, text_col))
    known = materialize(seen.where("key is not null").groupBy("key").agg(F.min("row").alias("rec"), F.count(F.lit(1)).alias("weight"), F.max("n").alias("shingle_count")), "records", compact=True)
    tokens = seen.where("sig is not null").select(F.col("row").alias("rec"), "sig").join(known.select("rec"), "rec", "left_semi")

    def sketch8(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = _fixed(pa.chunked_array([b[1]]), np.uint32, TOKENS) if b.num_rows else np.zeros((0, TOKENS), np.uint32)
            yield pa.record_batch([b[0], b[1], pa.array([x.tobytes() for x in mix(sig.astype(np.uint64)).astype(np.uint8)], pa.binary())], ["rec", "sig", "sketch"])

    records = materialize(tokens.mapInArrow(sketch8, "rec long, sig binary, sketch binary"), "tokens", compact=True)
    loose = (components(loose_links(records, threshold, recall, depth, leaf, TOKENS)))
    found = keep(loose.join(known.select(F.col("rec").alias("node"), "weight", "shingle_count"), "node"))
    counted = keep(found.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("shingle_count").alias("shingles")))
    blocks = F.greatest(F.ceil(F.sqrt(F.col("n") / tile)), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES), F.lit(1)).cast("int")
    sized = found.join(counted.hint("merge"), "root").select(F.col("node").alias("rec"), F.col("root").alias("comp"), "weight", blocks.alias("blocks"))
    members = (
        sized
        .join(seen.select(F.col("row").alias("rec"), "id", "th"), "rec")
        .select("rec", "comp", "weight", "blocks", F.pmod(F.xxhash64("rec"), "blocks").cast("int").alias("block"), F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("ik"), "th")
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                yield pa.record_batch([*(b[k] for k in range(5)), pa.array([s.tobytes() for s in shingle_sets(b[5].to_pylist())], pa.binary())], ["rec", "comp", "weight", "blocks", "block", "shingles"])

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("ik"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    whole = texts.join(members, ["ik", "th"]).select("rec", "comp", "weight", "blocks", "block", "text").mapInArrow(sets, "rec long, comp long, weight long, blocks int, block int, shingles binary")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tiles = whole.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k")).select(
        "comp", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "rec", "block", "weight", "shingles"
    )
    exact = materialize(
        tiles.repartition(n, "comp", "i", "j").sortWithinPartitions("comp", "i", "j", "rec").mapInArrow(_exact_tiles(threshold, tile), "rec long, links long, root long"),
        "exact",
        compact=True,
    )
    roots = components(exact.select(F.col("rec").alias("a"), F.col("root").alias("b")))
    linked = exact.groupBy("rec").agg(F.sum("links").alias("links"))
    classes = (
        known.join(linked, "rec", "left")
        .join(roots.withColumnRenamed("node", "rec"), "rec", "left")
        .select("key", F.coalesce("root", "rec").alias("root"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    rows = seen.select("id", "th", "row", "key").join(classes, "key", "left").select("id", "th", "row", F.coalesce("root", "row").alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    rows = materialize(rows, "classed", compact=True)
    named = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "row")).alias("m")).select("root", F.col("m.id").alias("class_id"), F.col("m.row").alias("kept_row"))
    named = keep(named)
    return rows.join(named.hint("merge"), "root").select(
        F.col("id").alias(id_col), "th", "row", F.when(F.col("n_links") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"), "n_links", (F.col("row") == F.col("kept_row")).alias("first")
    )


def thin_out(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class, all columns; of rows with equal ids and texts the one with the least hash of all columns."""
    names = docs.columns
    kept = join(docs, threshold, id_col, text_col).where("first").select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("__ik"), F.col("th").alias("__th"))
    whole = F.struct(*(F.col(f"`{c}`") for c in names))
    keyed = docs.select(whole.alias("__doc"), F.xxhash64(*(F.col(f"`{c}`") for c in names)).alias("__hash"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("__ik"), F.xxhash64(text_col).alias("__th"))
    one = keyed.join(kept.distinct(), ["__ik", "__th"], "left_semi").groupBy("__ik", "__th").agg(F.min_by("__doc", "__hash").alias("__doc"))
    return one.select(*(F.col("__doc")[c].alias(c) for c in names))
