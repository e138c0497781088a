"""SentencePiece encoding that knows which bytes of the source each piece came from."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6


class CharacterMap:
    """The compiled map of a normaliser: a double-array trie over UTF-8 bytes and the replacements."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.texts = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest key at ``at``, and its replacement; length 0 if there is none."""
        best, node, units = (0, b""), 0, self.units
        if not units:
            return best
        offset = lambda u: (u >> 10) << ((u & (1 << 9)) >> 6)
        node = offset(units[0])
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units) or (units[node] & 0x800000FF) != data[end]:
                break
            unit = units[node]
            node ^= offset(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                best = end + 1 - at, self.texts[start : self.texts.index(b"\0", start)]
        return best


class PieceCodec:
    """Encodes and decodes with one model, given as its file's bytes."""

    def __init__(self, model: bytes):
        self.model = model
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        norm = spec.normalizer_spec
        self.map = CharacterMap(norm.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        self.kinds = [p.type for p in spec.pieces]
        self.pieces = [p.piece for p in spec.pieces]
        #: What each id puts into the decoded bytes, and whether it does so as a single byte.
        self.bytes_of = [bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else p.piece.replace(SPACE, " ").encode() for p in spec.pieces]
        #: What each id decodes to.
        self.shown = [b" \xe2\x81\x87 " if k == _UNKNOWN else b"" if k == _CONTROL else x for k, x in zip(self.kinds, self.bytes_of, strict=True)]
        #: Bytes of the normalised text that each id takes; those of an unknown piece depend on the text.
        self.sizes = np.array([1 if p.type == _BYTE else -1 if p.type == _UNKNOWN else len(p.piece.encode()) for p in spec.pieces], np.int64)
        #: Each id's bytes may be joined to give what the library decodes, but for the space that the normaliser adds.
        self.joins = self.dummy and self.escape and not spec.trainer_spec.treat_whitespace_as_suffix and not any(k == _USER for k in self.kinds) and not self.squeeze

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised text in UTF-8, and for each of its bytes and its end the source byte it came from.

        By longest prefix: at each place the map's longest key is replaced, or
        else the character stands for itself. Bytes of one character or of one
        replacement come from its beginning. User-defined pieces, which a
        normaliser would leave alone, are not looked for.
        """
        data = text.encode()
        out, source = bytearray(), []

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        space = SPACE.encode() if self.escape else b" "
        if data and not self.map.units and not self.squeeze:  # no key can match: each character stands for itself
            first = len(space) if self.dummy else 0
            units = np.frombuffer(data, np.uint8)
            begin = np.maximum.accumulate(np.where((units & 0xC0) != 0x80, np.arange(len(units), dtype=np.int32), 0))
            whole = np.repeat(begin, np.where(units == 32, len(space), 1))
            return space[:first] + data.replace(b" ", space), np.concatenate([np.zeros(first, np.int32), whole, [len(data)]])
        at, parts = 0, []
        while at < len(data):
            size, piece = self.map.longest(data, at)
            if not size:
                size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                piece = data[at : at + size]
            parts.append((piece, at))
            at += size
        if self.squeeze:
            while parts and parts[0][0] in (b" ", b""):
                parts.pop(0)
        if parts and self.dummy:
            put(space, parts[0][1])
        blank = self.squeeze
        for piece, at in parts:
            if self.squeeze and blank:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", space), at)
                blank = piece.endswith(b" ")
        end = len(data)
        if self.squeeze:
            while out.endswith(space):
                end = source[len(out) - len(space)]
                del out[-len(space) :], source[-len(space) :]
        return bytes(out), np.array([*source, end], np.int64)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the source bytes [begin, end) of each.

        Of pieces inside one character or replacement the last takes the whole of
        its source, and those before it are empty, at its beginning.
        """
        ids = np.array(self.library.encode(text or ""), np.int64)
        if not len(ids):
            return ids, ids, ids
        norm, source = self.normalize(text)
        sizes = self.sizes[ids]
        if (sizes < 0).any():  # unknown characters that follow each other are one piece; the library tells which
            parts = self.library.encode(text, return_type="proto").pieces
            sizes = np.where(sizes < 0, np.array([len(p.piece.encode()) for p in parts]), sizes)
        ends = np.cumsum(sizes)
        if ends[-1] != len(norm):
            raise ValueError(f"pieces end at byte {ends[-1]} of {len(norm)}")
        return ids, source[np.concatenate([[0], ends[:-1]])], source[ends]

    def decode(self, ids: Sequence[int]) -> str:
        """What the library's decode gives."""
        if not self.joins:
            return self.library.decode([int(i) for i in ids])
        text = b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_CODECS: dict[int, PieceCodec] = {}


def _codec(model: bytes) -> PieceCodec:
    key = hash(model)
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(model)
    return _CODECS[key]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, ids, decoded, begins, ends)``, the last two in source bytes.

    Null texts count as empty: no ids, empty decoded text. Every row is encoded
    whole, however long; repeated rows are encoded alike; other columns are
    ignored; an empty table gives no rows. The model file is read by the driver
    and travels with the task (its size does not depend on the data).
    """
    return _encoded(docs, model_path, "begins array<int>, ends array<int>")


def _encoded(docs: DataFrame, model_path: str, more: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` and the columns of ``more``: both of the spans, or their digest."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "ids", "decoded", *(c.split()[0] for c in more.split(", "))]

    def lists(rows: list[np.ndarray]) -> pa.ListArray:
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                done = [codec.encode(t) for t in batch.column("text").to_pylist()]
                columns = [batch.column("doc_id"), lists([d[0] for d in done]), pa.array([codec.decode(d[0].tolist()) for d in done], pa.string())]
                if "begins" in names:
                    columns += [lists([d[k] for d in done]) for k in (1, 2)]
                else:
                    columns.append(pa.array([span_digest(*d[1:]) for d in done], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, ids array<int>, decoded string, {more}")


def span_digest(begins: np.ndarray, ends: np.ndarray) -> str:
    """SHA-256 of all begins and then all ends, each as four bytes, the lowest first."""
    return hashlib.sha256(np.concatenate([begins, ends]).astype("<i4").tobytes()).hexdigest()


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256)`` of every row."""
    done = _encoded(docs, model_path, "spans_sha256 string")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "spans_sha256",
    )
