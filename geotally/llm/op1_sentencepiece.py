"""SentencePiece encoding with byte offsets, and decoding.

Normalisation is done here: the model's compiled character map (a double-array trie with a string table) is applied
by longest prefix, and every normalised byte keeps the offset of the source bytes it came from. The library then
segments the *normalised* text with a copy of the model whose own normaliser is switched off, and each piece is
projected through the alignment to its span of UTF-8 bytes in the source.

Pieces only hold the word mark at their start, so a normalised text falls apart into runs of marks with the word
behind them; such a chunk is segmented once per worker and remembered, as long as a bounded number of bytes allows; chunks of
over ``LONG_CHUNK`` characters are not. A model with other pieces is segmented text by text.

Defined results: a null text is empty; an empty text has only the begin and end ids; repeated rows are encoded each by
itself; columns other than doc_id and text are ignored. Texts are never cut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, worker_cache

MARK = "▁"
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
SLICE_BYTES = 1 << 20
#: Bytes that the chunks which a worker remembers may take, about; longer chunks are not remembered; chunks segmented at a time.
MEMORY_BYTES, LONG_CHUNK, GROUP = 24 << 20, 48, 1 << 16
#: What a remembered chunk takes beside its characters and ids.
ENTRY = 200
ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>"


class CharacterMap:
    """The compiled character map: longest-prefix replacement of UTF-8 byte strings."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size :]
        self.known: dict[int, bytes] = {}

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest key that starts at ``at`` (0: none), and its replacement."""
        units, length, value = self.units, 0, 0
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                length, value = i + 1 - at, units[node] & 0x7FFFFFFF
        if not length:
            return 0, b""
        if value not in self.known:
            self.known[value] = self.strings[value : self.strings.index(b"\0", value)]
        return length, self.known[value]


class Model:
    """A piece model: normalisation with alignment, segmentation of normalised text, decoding."""

    def __init__(self, serialized: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as format

        proto = format.ModelProto.FromString(serialized)
        rules = proto.normalizer_spec
        self.dummy, self.squeeze, self.escape = rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.map = CharacterMap(rules.precompiled_charsmap)
        own = sorted((p.piece.encode() for p in proto.pieces if p.type == p.USER_DEFINED), key=len, reverse=True)
        self.own = re.compile(b"|".join(map(re.escape, own))) if own else None
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=serialized)
        self.bos, self.eos = self.decoder.bos_id(), self.decoder.eos_id()
        for field in ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces"):
            setattr(rules, field, False)
        rules.precompiled_charsmap = b""
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        kind = type(proto.pieces[0])
        # Normalised bytes that a piece covers; unknown pieces differ, and are measured where they occur.
        self.sizes = np.array([1 if p.type == kind.BYTE else 0 if p.type == kind.CONTROL else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = self.decoder.unk_id()
        self.has_bytes = proto.trainer_spec.byte_fallback
        self.in_chunks = self.escape and not any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces)
        # Chunks of late, and those before them; the latter go when the former have taken half of the room.
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def normalise(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source offset."""
        if not raw:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and self.own is None and self.dummy and self.escape and not self.squeeze and not self.suffix:
            mark = MARK.encode()
            spaces = np.frombuffer(raw, np.uint8) == 32
            at = np.repeat(np.arange(len(raw)), np.where(spaces, 3, 1))
            return mark + raw.replace(b" ", mark), np.concatenate((np.zeros(3, np.int64), at, [len(raw)]))
        space = MARK.encode() if self.escape else b" "
        out, at = bytearray(), []

        def put(piece: bytes, where: int) -> None:
            for byte in piece:
                own = space if byte == 32 else bytes((byte,))
                out.extend(own)
                at.extend([where] * len(own))

        i = 0
        while self.squeeze and i < len(raw):
            size, piece = self.prefix(raw, i)
            if piece != b" ":
                break
            i += size
        if i == len(raw):
            return b"", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            put(b" ", i)
        after_space = self.squeeze
        while i < len(raw):
            size, piece = self.prefix(raw, i)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece, i)
                after_space = piece.endswith(b" ")
            i += size
            after_space = after_space and self.squeeze
        while self.squeeze and out.endswith(space):
            i = at[len(out) - len(space)]
            del out[len(out) - len(space) :], at[len(at) - len(space) :]
        if self.dummy and self.suffix:
            put(b" ", i)
        return bytes(out), np.array([*at, i], np.int64)

    def prefix(self, raw: bytes, at: int) -> tuple[int, bytes]:
        """The next step of normalisation: source bytes consumed and their replacement."""
        if self.own is not None and (own := self.own.match(raw, at)):
            return len(own[0]), own[0]
        if self.map.units:
            size, piece = self.map.longest(raw, at)
            if size:
                return size, piece
        first = raw[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return size, raw[at : at + size]

    def segment(self, normal: bytes) -> np.ndarray:
        """Ids of a normalised text; chunks are remembered without the mark that each begins with."""
        text = normal.decode()
        if not self.in_chunks or not text.startswith(MARK):
            return np.array(self.segmenter.encode(text), "<u4")
        chunks = text.split(MARK)[1:]
        if "" in chunks:  # runs of marks belong to the word behind them
            chunks = [c[1:] for c in CHUNKS.findall(text)]
        return np.frombuffer(b"".join(self._group(chunks[i : i + GROUP]) for i in range(0, len(chunks), GROUP)), "<u4")

    def _group(self, chunks: list[str]) -> bytes:
        """Ids of some chunks. What is remembered after it has a bounded size, whatever the chunks."""
        memory = self.memory
        fresh = set(chunks).difference(memory)
        for c in [c for c in fresh if c in self.older]:
            memory[c] = self.older[c]
            self.held += ENTRY + len(c) + len(memory[c])
            fresh.remove(c)
        fresh = list(fresh)
        if fresh:
            # Segmented side by side as one text: no piece reaches over a mark.
            plain = [c for c in fresh if c and c[0] != MARK] if self.has_bytes else []
            ids = np.array(self.segmenter.encode(MARK + MARK.join(plain)) if plain else [], "<u4")
            ends = np.cumsum([len(c.encode()) + 3 for c in plain])
            cuts = [0, *(np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1).tolist()]
            raw = ids.tobytes()
            memory.update((c, raw[4 * x : 4 * y]) for c, x, y in zip(plain, cuts, cuts[1:], strict=False))
            for c in set(fresh).difference(plain):
                memory[c] = np.array(self.segmenter.encode(MARK + c), "<u4").tobytes()
        out = b"".join(map(memory.__getitem__, chunks))
        for c in fresh:
            if len(c) > LONG_CHUNK:
                del memory[c]
            else:
                self.held += ENTRY + len(c) + len(memory[c])
        if self.held > MEMORY_BYTES // 2:
            self.memory, self.older, self.held = {}, memory, 0
        return out

    def encode(self, raw: bytes | None, bos: bool = True, eos: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the source bytes [begin, end) of each; begin and end ids have empty spans at the text's edges."""
        raw = raw or b""
        normal, at = self.normalise(raw)
        ids = self.segment(normal) if normal else np.empty(0, np.uint32)
        sizes = self.sizes[ids]
        if not self.has_bytes and self.unknown >= 0 and (ids == self.unknown).any():
            pieces = self.segmenter.encode(normal.decode(), out_type=str)
            sizes = np.array([len(p.encode()) for p in pieces], np.int64)
        ends = np.cumsum(sizes)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("pieces don't cover the normalised text")
        spans = at[np.concatenate(([0], ends))]
        head, tail = [self.bos] * bos, [self.eos] * eos
        ids = np.concatenate((np.array(head, np.uint32), ids, np.array(tail, np.uint32)))
        begins = np.concatenate((np.zeros(len(head), np.int64), spans[:-1], np.full(len(tail), len(raw))))
        ends = np.concatenate((np.zeros(len(head), np.int64), spans[1:], np.full(len(tail), len(raw))))
        return ids, begins, ends


def worker_model(serialized: bytes) -> Model:
    models = worker_cache("piece_models")
    key = hashlib.sha256(serialized).digest()
    if key not in models:
        models[key] = Model(serialized)
    return models[key]


def encoder(model):
    """Batches (doc_id, text as bytes) to batches (doc_id, ids, begins, ends)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_model(model.value)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found = [own.encode(text) for text in part.column(1).to_pylist()]
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(x[0]) for x in found]))), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[i] for x in found]).astype(np.int32))) for i in range(3)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], names=["doc_id", "ids", "begins", "ends"])
    return encode


def digester(model):
    """Batches of ``encoder`` to digests of the ids, of the decoded text and of the spans."""
    encode = encoder(model)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_model(model.value)
        for batch in encode(batches):
            cuts = batch.column(1).offsets.to_numpy()
            ids, begins, ends = (batch.column(i).values.to_numpy() for i in (1, 2, 3))
            rows: list[tuple[int, str, str, str]] = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                text = own.decoder.decode(ids[a:b].tolist())
                spans = np.stack((begins[a:b], ends[a:b]), 1)
                rows.append((b - a, *(hashlib.sha256(x).hexdigest() for x in (ids[a:b].astype("<u4").tobytes(), text.encode(), spans.astype("<u4").tobytes()))))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
    return digest


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def model_of(spark: SparkSession, path: str):
    """The model file's bytes (at most a few MB), read once by the driver and broadcast."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, and the source bytes [begins, ends) of every id."""
    return _source(docs).mapInArrow(encoder(model_of(docs.sparkSession, path)), ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that the library decodes from ids; null ids decode to an empty text."""
    model = model_of(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_model(model.value)
        for batch in batches:
            texts = [own.decoder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids, decoded text and byte spans, hashed where the text is encoded."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
    return _source(docs).mapInArrow(digester(model_of(docs.sparkSession, path)), schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), default_model())
