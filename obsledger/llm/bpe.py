"""BPE encoding and decoding: batched numpy merge rounds over a byte-level vocabulary."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from importlib.util import find_spec
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from obsledger.llm.tables import add_columns, texts_of

# Fixed value: the public pattern that splits a text before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_BYTES = 8 << 20
"""Words are kept with their ids until they have so many bytes (Python's own for each word come on top)."""
KEPT_WORD = 64
"""Longer words are not kept: they hardly come again."""
GROUP_CHARS = 1 << 20
"""Texts are encoded in groups of about so many code points; the words of a group are Python strings for a while."""
LONG_WORD = 512
"""Bytes from which a word is merged alone, with a heap: rounds over all of its pairs would be many."""
NO_RANK = np.iinfo(np.int32).max


def default_vocabulary() -> str:
    """Path of the public byte-level vocabulary, where its package is installed."""
    spec = find_spec("public_tokenizers")
    if spec is None or spec.origin is None:
        raise FileNotFoundError("no vocabulary installed: pass the path of one")
    return str(Path(spec.origin).parent / "byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1 stands for itself,
    the other bytes follow from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary with its merges as sorted pair keys."""

    def __init__(self, path: str) -> None:
        data = json.loads(Path(path).read_text(encoding="utf-8"))
        vocab = data["model"]["vocab"]
        letters = byte_letters()
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        self.size = size
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        self.split = regex.compile(PATTERN)
        names = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.special = regex.compile(f"({names})") if names else None
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair by binary search, NO_RANK where there is no merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word as packed integers; all words share the rounds.

        The symbols of all words lie in one array. A round takes each word's lowest rank
        and merges, from the left, all pairs of it that do not overlap; words without
        a pair to merge leave.
        """
        out: list[bytes] = [b""] * len(words)
        short = [i for i, w in enumerate(words) if 0 < len(w) < LONG_WORD]
        for i, w in enumerate(words):
            if len(w) >= LONG_WORD:
                out[i] = self.merge_long(w)
        if not short:
            return out
        sizes = np.array([len(words[i]) for i in short])
        ids = self.byte_ids[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        word = np.repeat(np.array(short), sizes)
        while len(ids):
            inside = word[:-1] == word[1:]
            rank = np.full(len(ids), NO_RANK, np.int32)
            rank[:-1][inside] = self.rank(ids[:-1][inside], ids[1:][inside])
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            counts = np.diff(np.append(begin, len(ids)))
            low = np.minimum.reduceat(rank, begin)
            over = low == NO_RANK
            if over.any():
                packed = ids.astype("<u4").tobytes()
                ends = (4 * (begin + counts)[over]).tolist()
                for w, b, e in zip(word[begin[over]].tolist(), (4 * begin[over]).tolist(), ends, strict=True):
                    out[w] = packed[b:e]
                stay = np.repeat(~over, counts)
                ids, word, rank, low, counts = ids[stay], word[stay], rank[stay], low[~over], counts[~over]
                if not len(ids):
                    break
            hit = rank == np.repeat(low, counts)
            # Of overlapping pairs (a a a) the first, third, ... merge.
            at = np.flatnonzero(hit)
            run = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[place % 2 == 0]
            ids[at] = self.made[rank[at]]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, word = ids[stay], word[stay]
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same for one long word: pairs wait in a heap by rank and place."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        rank = self.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(rank) if r != NO_RANK]
        heapq.heapify(heap)
        look = self.pairs
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0:
                    found = look.get((ids[left], ids[right]))
                    if found is not None:
                        heapq.heappush(heap, (found, left, ids[left], ids[right]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    @property
    def pairs(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_pairs"):
            both = zip((self.keys // self.size).tolist(), (self.keys % self.size).tolist(), strict=True)
            self._pairs = dict(zip(both, self.ranks.tolist(), strict=True))
        return self._pairs

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed token ids (little-endian, 32 bits) of each text.

        An added token's string stands for the token wherever it is; the rest is split
        into words. Short words are kept with their ids up to a number of bytes.
        """
        split, added = self.split.findall, self.added
        parts: list[list[list[str] | bytes]] = []
        new: set[str] = set()
        if self.known_bytes > CACHED_BYTES:
            self.known.clear()
            self.known_bytes = 0
        known = self.known
        for text in texts:
            pieces = self.special.split(text) if self.special else [text]
            own: list[list[str] | bytes] = []
            for piece in pieces:
                if piece in added:
                    own.append(added[piece].to_bytes(4, "little"))
                elif piece:
                    words = split(piece)
                    own.append(words)
                    new |= set(words).difference(known)
            parts.append(own)
        fresh = list(new)
        known.update(zip(fresh, self.merge([w.encode() for w in fresh]), strict=True))
        look = known.__getitem__
        out = [b"".join(p if isinstance(p, bytes) else b"".join(map(look, p)) for p in own) for own in parts]
        for w in fresh:
            if len(w) > KEPT_WORD:
                del known[w]
            else:
                self.known_bytes += len(w)
        return out

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        look = self.bytes_of.__getitem__
        return b"".join(map(look, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The vocabulary, once for each Python worker."""
    return Bpe(path)


def text_groups(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in groups of about GROUP_CHARS code points; a longer text is a group of its own."""
    begin = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > GROUP_CHARS:
            yield texts[begin:k]
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield texts[begin:]


IDS = T.StructType([T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``.

    The ids are those of the tokenizers library without special tokens around the text; the string
    of an added token inside a text is that token. A null or empty text has no tokens.
    ``path`` names the vocabulary file, which every executor must have. Columns
    of these names are replaced, others pass through; rows stay as they are.
    """
    path = path or default_vocabulary()

    def make():
        bpe = load(path)

        def columns(batch: pa.RecordBatch) -> list:
            ids = [x for some in text_groups(texts_of(batch, text_col)) for x in bpe.encode_batch(some)]
            return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]

        return columns

    return add_columns(docs, IDS, make)


def decode(tokens: DataFrame, path: str | None = None, ids_col: str = "token_ids") -> DataFrame:
    """``tokens`` with ``decoded``, the text of the packed ids; null ids give an empty text."""
    path = path or default_vocabulary()

    def make():
        bpe = load(path)

        def columns(batch: pa.RecordBatch) -> list:
            packed = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            return [pa.array([bpe.decode(x or b"") for x in packed], pa.string())]

        return columns

    return add_columns(tokens, T.StructType([T.StructField("decoded", T.StringType())]), make)
