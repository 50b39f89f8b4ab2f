"""Byte-level BPE through a sentencepiece model made straight from a rank file.

The vocabulary's byte strings become pieces: each byte is written as one
printable character, a piece's score is its negative rank, and nothing is
normalised.  Sentencepiece then merges the neighbours whose joined piece has the
lowest rank first, leftmost on ties, which is byte-level BPE.  Texts are cut into
pre-tokens by the vocabulary's pattern, every pre-token is encoded separately,
and ids are decoded by the inverse mapping.

Nulls: a null text is an empty one and gives no ids.  Repeated rows give
repeated rows; an empty table an empty result; columns other than the key and
the text are not looked at.  Work is one pass over the rows, without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from lociflow.llm.common import column, slices

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pre-tokens whose ids a Python worker remembers; the memory is emptied when full.
REMEMBERED = 300_000


def printable_bytes() -> list[str]:
    """One printable character for each byte: itself where it has a visible form, else one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte string of each rank, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(piece) for piece, rank in map(bytes.split, lines)}
    return [ranked[i] for i in range(len(ranked))]


def serialised_model(pieces: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; one more id stands for the unknown."""
    signs = printable_bytes()
    model = model_pb2.ModelProto()
    for rank, piece in enumerate(pieces):
        model.pieces.add(piece="".join(signs[b] for b in piece), score=-float(rank))
    unknown = model_pb2.ModelProto.SentencePiece.UNKNOWN
    model.pieces.add(piece="<unk>", score=0.0, type=unknown)
    model.trainer_spec.model_type = model_pb2.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(pieces) + 1
    model.trainer_spec.unk_id = len(pieces)
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes pre-tokens and decodes ids; one for each Python worker."""

    def __init__(self, path: str, pattern: str) -> None:
        self.pieces = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(self.pieces))
        self.signs = {b: c for b, c in enumerate(printable_bytes())}
        self.known: dict[str, tuple[list[int], str]] = {}

    def learn(self, tokens: list[str]) -> None:
        """Encode the pre-tokens that aren't remembered."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({t for t in tokens if t not in self.known})
        if not new:
            return
        mapped = [t.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.signs) for t in new]
        for token, ids in zip(new, self.model.encode(mapped, num_threads=1), strict=True):
            self.known[token] = (ids, " ".join(map(str, ids)))

    def encode(self, text: str | None) -> list[int]:
        tokens = self.split(text) if text else []
        self.learn(tokens)
        return list(chain.from_iterable([self.known[t][0] for t in tokens]))

    def encode_with_line(self, text: str | None) -> tuple[list[int], str]:
        """The ids, and the same in decimals joined by one space."""
        tokens = self.split(text) if text else []
        self.learn(tokens)
        got = [self.known[t] for t in tokens]
        return list(chain.from_iterable([g[0] for g in got])), " ".join([g[1] for g in got])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(key, ids): the token ids of every text."""
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for part in slices(parts):
            ids = pa.array([c.encode(t) for t in column(part, text)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), ids], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(coded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """(key, bytes): what the ids stand for."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, public_tokenizers.PATTERN)
        for part in slices(parts):
            made = pa.array([c.decode(x or []) for x in column(part, ids)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), made], ["key", "bytes"])

    kind = coded.schema[key].dataType.simpleString()
    return coded.select(key, ids).mapInArrow(run, f"key {kind}, bytes binary").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode every text, decode the ids, in one pass."""
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for part in slices(parts):
            counts, sums, back = [], [], []
            for text in column(part, "text"):
                ids, line = c.encode_with_line(text)
                counts.append(len(ids))
                sums.append(hashlib.sha256(line.encode()).hexdigest())
                back.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
