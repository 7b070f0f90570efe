"""Byte-level BPE encoding and decoding.

A text is split at the special tokens and by the vocabulary's pattern. Pieces
recur, so each worker keeps the ids of those it has met. A piece is merged pair
by pair, lowest rank first; one longer than ``LEAF`` bytes (text without any
break) by tree concatenation: its halves are encoded on their own, down to
leaves, and joined by encoding a window of tokens around the join anew; the
window grows until its first token and its last token are what the left and
the right side already have there. Two encodings that share a token on both
sides of the join are the encoding of the whole, since a sequence of tokens is
the BPE encoding of its bytes exactly when each two neighbours are.

The vocabulary is a parameter: the path of a ``tokenizer.json`` (byte-level BPE,
no normaliser), or None for the public 50k one; the path is opened on the
executors.

Defined cases: null and empty texts have no ids; a special token's string in a
text gives its id; texts of any length are encoded whole; rows keep their other
columns out (``encode`` returns doc_id, n_tokens, ids).
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAF = 128
SHORT = 48
MOST_PIECES = 100_000
VOCABULARY = "byte_bpe_50k.json"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokens:
    """The bytes of each id of a tokenizer file: all that decoding needs."""

    def __init__(self, path: str | None):
        self.read(self.spec(path))

    @staticmethod
    def spec(path: str | None) -> dict:
        import public_tokenizers

        with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
            return json.load(f)

    def read(self, spec: dict) -> None:
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.bytes_of = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, k in vocab.items():
            self.bytes_of[k] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, k in self.special.items():
            self.bytes_of[k] = token.encode()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class Vocabulary(Tokens):
    """Merges, ids and the pattern of one tokenizer file."""

    def __init__(self, path: str | None):
        import public_tokenizers
        import regex

        spec = self.spec(path)
        self.read(spec)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.of_byte = [vocab[c] for c in sorted(letters, key=letters.get)]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        marks = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")").split if marks else None
        self.pieces = _Pieces(self)

    def merge(self, ids: list[int]) -> list[int]:
        """Merge neighbours, lowest rank first and leftmost among equals."""
        if len(ids) > SHORT:
            return self.merge_long(ids)
        rank, never = self.ranks.get, len(self.merged)
        ranks = [rank(p, never) for p in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < never:
            i = ranks.index(least)
            ids[i:i + 2] = [self.merged[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), never)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), never)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        rank, n = self.ranks.get, len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i, p) for i, p in enumerate(zip(ids, ids[1:])) if (r := rank(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = self.merged[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := rank((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, (ids[x], ids[y])))
        return [x for x in ids if x >= 0]

    def direct(self, data: bytes) -> list[int]:
        return self.merge([self.of_byte[b] for b in data])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours from theirs."""
        n = 2
        while True:
            a, b = left[-n:], right[:n]
            window = self.direct(b"".join(self.bytes_of[x] for x in (*a, *b)))
            if (len(a) == len(left) or window[0] == a[0]) and (len(b) == len(right) or window[-1] == b[-1]):
                return left[:len(left) - len(a)] + window + right[len(b):]
            n *= 2

    def tree(self, data: bytes) -> list[int]:
        """Ids of a piece's bytes: halves on their own, then joined, level by level."""
        if len(data) <= LEAF:
            return self.direct(data)
        parts = [data]
        while len(parts[0]) > LEAF:
            parts = [x for p in parts for x in (p[:len(p) // 2], p[len(p) // 2:])]
        level = [self.direct(p) for p in parts]
        while len(level) > 1:
            level = [self.join(level[k], level[k + 1]) for k in range(0, len(level), 2)]
        return level[0]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        pieces = self.pieces
        if len(pieces) > MOST_PIECES:
            pieces.clear()
        if self.split_special is None or not any(s in text for s in self.special):
            return b"".join(map(pieces.__getitem__, self.split(text)))
        out = []
        for part in self.split_special(text):
            out.append(self.special[part].to_bytes(4, "little") if part in self.special
                       else b"".join(map(pieces.__getitem__, self.split(part))))
        return b"".join(out)


class _Pieces(dict):
    """Packed ids by piece; long pieces are not kept."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        packed = np.array(self.vocabulary.tree(data), "<u4").tobytes()
        if len(data) <= LEAF:
            self[piece] = packed
        return packed


_LOADED: dict[tuple, Tokens] = {}


def vocabulary(path: str | None = None, kind: type = Vocabulary):
    """The vocabulary (or only its Tokens), read once per worker."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row; ids are packed little-endian unsigned 32-bit integers."""
    def run(batches):
        v = vocabulary(path)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                ids = [v.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and ``text``, decoded from ``ids`` (null: empty)."""
    def run(batches):
        v = vocabulary(path, Tokens)
        for b in batches:
            at = b.schema.get_field_index("ids")
            texts = pa.array([v.decode(x or b"") for x in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, "text"])
    base = encoded.drop("text")
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("text", T.StringType())]))
