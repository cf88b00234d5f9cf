"""Byte-level BPE by a sentencepiece model that is written from the vocabulary.

Every byte is one private character, so that a vocabulary entry becomes a piece
of such characters. Its score is the negative rank: the merges with the highest
score first are the merges with the lowest rank first. The model normalises
nothing. Texts are split into pre-tokens by the pattern, each pre-token is encoded
by itself, and decoding maps ids back to bytes.

Rows: a null text is an empty one, which has no tokens. Repeated rows and further
columns are passed on as they are.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the characters that stand for the bytes 0 to 255 begin.
FIRST = 0x100
#: A character that stands for no byte.
MARK = chr(FIRST + 256)
#: A worker keeps the ids of about this many words, and of as many that it met before them.
CACHE = 400_000
#: Longer words are encoded but not kept.
CACHED_CHARS = 64


def pieces(data: bytes) -> str:
    return data.decode("latin-1").translate(_SHIFT)


_SHIFT = {i: chr(FIRST + i) for i in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries by rank; the ranks must run from 0 without a gap."""
    with open(path, "rb") as lines:
        pairs = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(pairs) != list(range(len(pairs))):
        raise ValueError(f"ranks of {path} have gaps")
    if missing := [i for i in range(256) if bytes([i]) not in set(pairs.values())]:
        raise ValueError(f"{path} has no entry for the bytes {missing}")
    return [pairs[i] for i in range(len(pairs))]


def serialise_model(vocabulary: list[bytes]) -> bytes:
    """The sentencepiece model: piece i is the entry of rank i, and the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    for rank, token in enumerate(vocabulary):
        model.pieces.add(piece=pieces(token), score=-float(rank), type=schema.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=-float(len(vocabulary)), type=schema.ModelProto.SentencePiece.UNKNOWN)
    trainer, normal = model.trainer_spec, model.normalizer_spec
    trainer.model_type = schema.TrainerSpec.BPE
    trainer.vocab_size = len(vocabulary) + 1
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(vocabulary), -1, -1, -1
    normal.name = "identity"
    normal.add_dummy_prefix = normal.remove_extra_whitespaces = normal.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.vocabulary = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.vocabulary))
        self.split = regex.compile(pattern).findall
        self.blank = re.compile(r"[\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
        self.outer = regex.compile(r"(?<=\S) (?=\S)").split
        self.unknown = len(self.vocabulary)
        self.digits = [str(i) for i in range(len(self.vocabulary))]
        # An entry that merges cannot reach is still taken whole where it is a pre-token.
        self.whole = {}
        for i, token in enumerate(self.vocabulary):
            if self.processor.encode(pieces(token)) != [i]:
                self.whole[token] = [i]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> list[int]:
        """Ids of the text.

        A space between two other characters always opens a pre-token, and nothing
        left of it matters for the split: words between such spaces are looked up
        whole, and only unknown ones are split by the pattern and merged.
        """
        words = self.outer(text) if self._odd(text) else text.split(" ")
        if len(self.known) > CACHE:  # words that come again move back from the older half
            self.known, self.older = {}, self.known
        known = self.known
        first = self._encode(self.split(words[0]))
        del words[0]
        coded = list(map(known.get, words))
        if None in coded:
            missing = {w for w, ids in zip(words, coded, strict=True) if ids is None}
            old = self.older
            if old:
                known.update((w, old[w]) for w in missing if w in old)
                missing = [w for w in missing if w not in known]
            parts = [self.split(" " + w) for w in missing]
            ids = iter(self._encode(list(chain.from_iterable(parts))))
            for w, own in zip(missing, parts, strict=True):
                known[w] = next(ids) if len(own) == 1 else b"".join(islice(ids, len(own)))
            coded = list(map(known.__getitem__, words))
            for w in missing:
                if len(w) > CACHED_CHARS:
                    del known[w]
        return array("i", b"".join([*first, *coded])).tolist()

    def _odd(self, text: str) -> bool:
        """Whether a space may stand beside another blank or at an end."""
        pairs = "  " in text or " \n" in text or "\n " in text
        return pairs or text[:1] == " " or text[-1:] == " " or self.blank(text) is not None

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of each pre-token as bytes of ints.

        One call takes many, between marks that no piece holds, so none merges across.
        """
        out: list[bytes] = []
        whole, unknown = self.whole, self.unknown
        for first in range(0, len(parts), 500):
            raw = [p.encode() for p in parts[first : first + 500]]
            ids = array("i", self.processor.encode(MARK.join(map(pieces, raw))))
            start = 0
            for r in raw:
                end = start
                while end < len(ids) and ids[end] != unknown:
                    end += 1
                out.append(array("i", whole[r]).tobytes() if r in whole else ids[start:end].tobytes())
                start = end + 1
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of this worker process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _batches(batches: Iterator[pa.RecordBatch], columns: list[str], rows: int = 64) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).select(columns)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """Per row: id, ``ids`` (array of int), ``decoded`` (the bytes that decoding gives back)."""
    source = docs.select(id_column, "text")
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        own = codec(path, pattern)
        for batch in _batches(batches, [id_column, "text"]):
            ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(i) for i in ids], pa.binary())],
                names=[id_column, "ids", "decoded"],
            )

    return source.mapInArrow(run, f"`{id_column}` {kind}, ids array<int>, decoded binary")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number of tokens and digests of ids and of decoded bytes, made where the ids are."""

    def run(batches):
        own = codec(path, pattern)
        for batch in _batches(batches, ["doc_id", "text"]):
            counts, hashes, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                ids = own.encode(text or "")
                counts.append(len(ids))
                joined = ",".join(map(own.digits.__getitem__, ids))
                hashes.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
