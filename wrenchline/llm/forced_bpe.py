"""Byte-level BPE of a tokenizer file, by forced boundaries.

Two bytes that stand side by side inside no vocabulary entry can never end up in
one token, whatever the merges do. Between them a cut is certain. Each pre-token
is cut at all such places, every fragment is merged by itself, and the ids of
the fragments are put one behind the other. Fragments repeat far more often than
texts, so a worker keeps the ids of those it met.

The file is read once on the driver and sent to the tasks; it has the size of a
vocabulary and doesn't grow with the texts.

Rows: a null or empty text has no tokens. Repeated rows, null ids and very long
texts are rows like others; a task holds one text at a time beside its caches,
and long words are not kept there. Tables without rows give none. Further
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Entries of a cache before its older half is let go, and the longest key that is kept.
CACHED, CACHED_CHARS = 300_000, 64
#: What keeps a text from being cut by plain splitting: blanks but for single spaces and line ends between two words.
ODD = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c")
ODD_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else the next one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def allowed_pairs(entries: list[str]) -> np.ndarray:
    """For each two characters whether some entry holds them side by side."""
    allowed = np.zeros((0x200, 0x200), dtype=bool)
    codes = [np.frombuffer(e.encode("utf-16-le"), dtype="<u2") for e in entries]
    for c in codes:
        allowed[c[:-1], c[1:]] = True
    return allowed


def fragments(words: list[str], allowed: np.ndarray) -> tuple[list[str], list[int]]:
    """All fragments of the byte-character words, and how many each word has.

    A cut stands at the start of every word and between two characters that no
    entry holds side by side.
    """
    joined = "".join(words)
    codes = np.frombuffer(joined.encode("utf-16-le"), dtype="<u2")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths)
    cut = np.zeros(len(codes) + 1, dtype=bool)
    cut[1:-1] = ~allowed[codes[:-1], codes[1:]]
    cut[0] = True
    cut[ends] = True
    places = np.flatnonzero(cut)
    counts = np.diff(np.searchsorted(places, np.concatenate(([0], ends))))
    bounds = places.tolist()
    return [joined[a:b] for a, b in zip(bounds, bounds[1:], strict=False)], counts.tolist()


class Recent:
    """A dictionary that forgets what was not asked for in a while."""

    def __init__(self, size: int = CACHED):
        self.size, self.new, self.old = size, {}, {}

    def fill(self, keys: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The values of the keys; those not known are made in one call."""
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        found = list(map(new.get, keys))
        if None in found:
            places, i = [], -1
            for _ in range(found.count(None)):
                i = found.index(None, i + 1)
                places.append(i)
            lacking = {keys[i]: None for i in places}
            new.update([(k, old[k]) for k in lacking if k in old])
            lacking = [k for k in lacking if k not in new]
            new.update(zip(lacking, make(lacking), strict=True))
            for i in places:
                found[i] = new[keys[i]]
            for k in lacking:
                if len(k) > CACHED_CHARS:
                    del new[k]
        return found


class Codec:
    """Encodes and decodes as the tokenizer of the given file does, without truncation and padding."""

    def __init__(self, config: str):
        from tokenizers import Tokenizer, models

        parts = json.loads(config)
        model, split = parts["model"], parts["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        if not plain or parts["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
            raise ValueError("expects a byte-level BPE without normaliser and prefix space")
        if any(t[k] for t in parts["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("expects added tokens that are matched as they are")
        whole = Tokenizer.from_str(config)
        self.pre_tokens = whole.pre_tokenizer.pre_tokenize_str
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merger = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
        self.allowed = allowed_pairs(list(model["vocab"]))
        back = {ord(c): b for b, c in enumerate(byte_characters())}
        self.added = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.entry = {i: t.translate(back).encode("latin-1") for t, i in model["vocab"].items()}
        self.entry.update((i, t.encode()) for t, i in self.added.items())
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.words, self.pieces = Recent(), Recent()

    def encode(self, text: str) -> array:
        """Ids of the text as unsigned 32-bit numbers."""
        ids = array("I")
        sections = self.at_added.split(text) if self.at_added else [text]
        for i, section in enumerate(sections):
            if i % 2:
                ids.append(self.added[section])
            elif section:
                ids.frombytes(b"".join(self._section(section)))
        return ids

    def _section(self, text: str) -> list[bytes]:
        """Ids word by word.

        A space between two visible characters opens a pre-token, and so does a line
        end; what lies between such places is a word, which keeps its line end.
        """
        odd = any(o in text for o in ODD) or text[0] in " \n" or text[-1] in " \n"
        plain = not odd and (text.isascii() or not ODD_BLANKS.search(text))
        first, *rest = text.replace("\n", " \n").split(" ") if plain else BETWEEN.split(text)
        return [*self._encode(first, []), *self.words.fill(rest, lambda words: self._encode("", words))]

    def _encode(self, first: str, words: list[str]) -> list[bytes]:
        """Ids of what stands before the first space, if anything, and of each word after it."""
        spelled = [w if w[0] == "\n" else " " + w for w in words]
        if first:
            spelled.insert(0, first)
        if not spelled:
            return []
        parts = self.pre_tokens("".join(spelled))
        cut, counts = fragments([p for p, _ in parts], self.allowed)
        coded = self.pieces.fill(cut, self._merge)
        # From characters to pre-tokens to fragments: where each word ends.
        ends = np.cumsum(np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled)))
        stops = np.fromiter((place[1] for _, place in parts), dtype=np.int64, count=len(parts))
        bounds = np.cumsum(counts)[np.searchsorted(stops, ends)].tolist()
        return [coded[a] if b - a == 1 else b"".join(coded[a:b]) for a, b in zip([0, *bounds], bounds, strict=False)]

    def _merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of each fragment, merged by itself."""
        merge = self.merger.tokenize
        return [array("I", [token.id for token in merge(p)]).tobytes() for p in pieces]

    def decode_bytes(self, ids: list[int] | array) -> bytes:
        return b"".join(map(self.entry.__getitem__, ids))

    def decode(self, ids: list[int] | array) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(config: str) -> Codec:
    """The codec of this worker process."""
    key = hashlib.sha256(config.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(config)
    return _CODECS[key]


def _send(docs: DataFrame, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _rows(batches: Iterator[pa.RecordBatch], rows: int = 32) -> Iterator[tuple[pa.Array, list[str]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part.column(0), [t or "" for t in part.column(1).to_pylist()]


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """Per row: id, ``ids`` (array of long) and ``decoded``, the text that the ids give back."""
    sent = _send(docs, path)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        own = codec(sent.value)
        for keys, texts in _rows(batches):
            ids = [own.encode(t) for t in texts]
            coded = pa.array([i.tolist() for i in ids], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, coded, pa.array(map(own.decode, ids), pa.string())], names=[id_column, "ids", "decoded"]
            )

    return docs.select(id_column, "text").mapInArrow(run, f"`{id_column}` {kind}, ids array<bigint>, decoded string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded texts, made where the ids are."""
    sent = _send(docs, path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = codec(sent.value)
        for keys, texts in _rows(batches):
            counts, hashes, decoded = [], [], []
            for text in texts:
                ids = own.encode(text)
                counts.append(len(ids))
                decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
                if sys.byteorder == "big":
                    ids.byteswap()
                hashes.append(hashlib.sha256(ids.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
