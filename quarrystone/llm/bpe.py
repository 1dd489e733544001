"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

Each byte is mapped to a printable character, so that every entry of the rank
file becomes a piece of the model, scored by its negative rank, with identity
normalisation. Texts are divided by the pre-token pattern; each pre-token is
encoded by itself, and ids are decoded by the inverse byte mapping. No tokenizer
is trained here.

Defined cases: a null text is an empty one and has no ids; texts of any length
are encoded whole; repeated rows give repeated results; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..storage import ship

KEPT_PRE_TOKENS = 200_000  # entries of a worker's cache of pre-tokens; it is emptied beyond
KEPT_LENGTH = 48  # characters of a pre-token that is kept in the cache


def byte_characters() -> list[str]:
    """A printable character for each byte: its own if Latin-1 prints it, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(r): base64.b64decode(t) for t, r in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be gapless from 0")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: int | bytes | float) -> bytes:
    """A field in the wire format of protocol buffers."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value & (1 << 64) - 1)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(entries: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece i is entries[i]; one more piece stands for the unknown."""
    shown = byte_characters()
    pieces = bytearray()
    for rank, entry in enumerate(entries):
        piece = "".join(shown[b] for b in entry).encode()
        pieces += _field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, 1))
    unknown = len(entries)
    pieces += _field(1, _field(1, "�".encode()) + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, unknown + 1) + _field(40, unknown) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBPE:
    """Encoder and decoder of one serialised model."""

    def __init__(self, model: bytes, pattern: str) -> None:
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        shown = byte_characters()
        self.to_shown = {b: shown[b] for b in range(256)}
        back = {c: b for b, c in enumerate(shown)}
        self.bytes_of = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(self.model.get_piece_size() - 1)]
        self.kept: dict[str, bytes] = {}

    def _pre_token(self, token: str) -> bytes:
        ids = self.model.encode(token.encode().decode("latin-1").translate(self.to_shown))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= KEPT_LENGTH:
            if len(self.kept) >= KEPT_PRE_TOKENS:
                self.kept.clear()
            self.kept[token] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        kept, miss = self.kept, self._pre_token
        return b"".join([kept.get(t) or miss(t) for t in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


_made: dict[str, ByteBPE] = {}


def _shared(spark: SparkSession, rank_path: str, pattern: str) -> Callable[[], ByteBPE]:
    """The codec in a task. The rank file is read by the driver alone; the model made from it goes to the executors."""
    model = serialise_model(read_ranks(rank_path))  # some MB: a rank file's entries are a vocabulary
    name, sent = hashlib.sha256(model + pattern.encode()).hexdigest(), spark.sparkContext.broadcast((model, pattern))

    def codec() -> ByteBPE:
        if name not in _made:
            _made[name] = ByteBPE(*sent.value)
        return _made[name]

    return codec


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): ids is the packed token ids of the whole text, 4 bytes each."""
    ship(docs.sparkSession)
    made = _shared(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = made()
        for b in batches:
            yield pa.record_batch([b[0], pa.array([codec.encode(t or "") for t in b[1].to_pylist()], pa.binary())], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): encode, then decode the ids, in one worker (one codec in memory)."""
    ship(docs.sparkSession)
    made = _shared(docs.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = made()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                ids = [codec.encode(t or "") for t in b[1].to_pylist()]
                yield pa.record_batch([b[0], pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary())], [id_col, "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded binary")


def decode(encoded: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the bytes for which the ids stand."""
    ship(encoded.sparkSession)
    made = _shared(encoded.sparkSession, rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = made()
        for b in batches:
            yield pa.record_batch([b[0], b[1], pa.array([codec.decode(x) for x in b[1].to_pylist()], pa.binary())], [id_col, "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded binary")
