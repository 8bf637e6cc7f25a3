"""BPE encoding and decoding with a segment tree over pair ranks (operator 6).

Every word's adjacent symbol pairs are the leaves of a segment tree of
(rank, position) minima, so the root yields the leftmost pair of the lowest
rank.  A merge changes three leaves (its own pair and both neighbours'), each
by a logarithmic point update, until no mergeable pair remains.  The distinct
words of a slice are merged together: one numpy array holds the trees of all
words of a length class, and every step merges once in each unfinished word.

The vocabulary file (normaliser, split pattern and merges of a lower-casing
BPE with word ends) is a parameter; the driver parses it and the tables, whose
size the file bounds, go to the tasks.  A task remembers the encodings of at
most CACHE words, and starts afresh beyond that.

Defined results: null and empty texts have no tokens; special tokens in a text
are recognised as such.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .textscan import ByteHashes, bounded_batches, map_texts

CACHE = 300_000
#: Words of more bytes than this are merged alone.
_LONG = 64
_NONE = np.int64(1 << 62)
_POSITION_BITS = 24

# The white space that the normaliser of the vocabulary file drops.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009" \
         "\u200a\u2028\u2029\u202f\u205f\u3000"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> list[str]:
    """The printable stand-in of every byte: itself where printable, else from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    stand = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [stand[b] for b in range(256)]


class Bpe:
    """Tables of one vocabulary file, and the encoder."""

    def __init__(self, path: str | None = None):
        with open(path or default_vocabulary(), encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in (*vocab.items(), *self.special.items()):
            self.token[i] = t
        symbols = _byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.last = np.array([vocab[c + suffix] for c in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        first = np.unique(key, return_index=True)[1]  # in key order; a repeated pair keeps its first rank
        self.keys, self.ranks, self.merged = key[first], first.astype(np.int64), merged

    def _leaf(self, a: np.ndarray, b: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Leaf values of pairs: rank and position in one number, _NONE where there is no merge."""
        key = (a << np.int64(20)) | b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[i] == key) & (a >= 0) & (b >= 0)
        return np.where(known, (self.ranks[i] << np.int64(_POSITION_BITS)) | position, _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words (not empty) in a row, and their count for each word."""
        size = np.array([len(w) for w in words], np.int64)
        count, parts = np.zeros(len(words), np.int64), []
        done, width = 0, 4
        while done < len(words):
            rows = np.flatnonzero((size <= width) & (size > (width // 2 if width > 4 else 0)))
            step = 8192 if width <= _LONG else 1
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                ids, count[some] = self._merge([words[r] for r in some.tolist()], width)
                parts.append((some, ids))
            done += len(rows)
            width *= 2
        starts = np.cumsum(count) - count
        flat = np.zeros(count.sum(), np.int32)
        for some, ids in parts:
            flat[runs(starts[some], count[some])] = ids
        return flat, count

    def _merge(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of at most ``width`` bytes (a power of two)."""
        n = len(words)
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        place = np.arange(width)
        symbol = np.where(place < size[:, None] - 1, self.inner[raw], self.last[raw])
        symbol = np.hstack([np.where(place < size[:, None], symbol, -1), np.full((n, 1), -1)])
        tree = np.full((n, 2 * width), _NONE)
        tree[:, width:] = self._leaf(symbol[:, :-1], symbol[:, 1:], place)
        level = width
        while level > 1:  # inner nodes, bottom up
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        # column 0 of the links is position -1, the last one the end
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        mask = (np.int64(1) << np.int64(_POSITION_BITS)) - 1
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            rows, root = rows[root < _NONE], root[root < _NONE]
            if len(rows) == 0:
                break
            i = root & mask
            gone = after[rows, i]
            follows = after[rows, gone]
            left = before[rows, i]
            symbol[rows, i] = self.merged[root >> np.int64(_POSITION_BITS)]
            symbol[rows, gone] = -1
            after[rows, i] = follows
            before[rows, np.minimum(follows, width)] = i
            right_symbol = symbol[rows, np.minimum(follows, width)]
            has_left = left >= 0
            where = np.concatenate([rows, rows, rows[has_left]])
            node = np.concatenate([gone, i, left[has_left]]) + width
            tree[rows, gone + width] = _NONE
            tree[rows, i + width] = self._leaf(symbol[rows, i], right_symbol, i)
            tree[rows[has_left], left[has_left] + width] = self._leaf(
                symbol[rows[has_left], left[has_left]], symbol[rows[has_left], i[has_left]], left[has_left])
            level = width
            while level > 1:  # the three point updates climb together
                node >>= 1
                tree[where, node] = np.minimum(tree[where, 2 * node], tree[where, 2 * node + 1])
                level //= 2
        symbol = symbol[:, :width]
        live = symbol >= 0
        return symbol[live], live.sum(axis=1)


def runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for each run, in a row."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def _blob(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings with a space after each as bytes; starts and sizes."""
    raw = [f"{s} ".encode() for s in strings]
    size = np.array([len(r) for r in raw], np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size


_SPACE_CLASS, _LETTER_CLASS, _DIGIT_CLASS, _OTHER_CLASS = range(4)


def _classes() -> np.ndarray:
    """The split pattern's class of every code point."""
    every = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, every))
    table = np.full(0x110000, _OTHER_CLASS, np.uint8)
    code = np.array(every)
    for pattern, kind in ((r"\p{L}+", _LETTER_CLASS), (r"\p{N}+", _DIGIT_CLASS)):
        for m in regex.finditer(pattern, text):
            table[code[m.start():m.end()]] = kind
    table[[ord(c) for c in _SPACE]] = _SPACE_CLASS
    return table


class Encoder:
    """Encodes slices of texts; remembers the ids of words by their hash."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.numbers = _blob([str(i) for i in range(len(bpe.token))])
        self.tokens = _blob(bpe.token)
        self.special = re.compile("(" + "|".join(map(re.escape, bpe.special)) + ")")
        self.classes = _classes()
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, hashes: np.ndarray, word_at) -> None:
        """Encode the distinct words that aren't remembered yet, all together."""
        new = ~self._known(hashes)
        if len(self.hashes) + new.sum() > CACHE:
            self._forget()
            new[:] = True
        if not new.any():
            return
        flat, count = self.bpe.merge([word_at(i) for i in np.flatnonzero(new).tolist()])
        at = np.searchsorted(self.hashes, hashes[new])
        self.hashes = np.insert(self.hashes, at, hashes[new])
        self.start = np.insert(self.start, at, len(self.flat) + np.cumsum(count) - count)
        self.count = np.insert(self.count, at, count)
        self.flat = np.concatenate([self.flat, flat])

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        if len(self.hashes) == 0:
            return np.zeros(len(hashes), bool)
        i = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[i] == hashes

    @staticmethod
    def _normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final-sigma rule
        return text.lower()

    def _split(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, word starts and ends in them, and the number of words of each piece."""
        joined = "".join(pieces)
        edge = np.cumsum([0, *map(len, pieces)])
        data = np.frombuffer(joined.encode(), np.uint8)
        if joined.isascii():
            code, place = data, None
        else:
            code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            wide = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            place = np.concatenate([[0], np.cumsum(wide)])
        kind, n = self.classes[code], len(code)
        begins = kind != _SPACE_CLASS
        cut = np.ones(n, bool)  # a word can't go on from the character before
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT_CLASS)
        cut[edge[edge < n]] = True
        begins &= cut
        for at, size in self._contractions(code, cut, edge):
            begins[at + 1:at + size] = False
            cut[at + 1:at + size] = False
            if at + size < n and not cut[at + size]:
                cut[at + size] = begins[at + size] = True
        starts = np.flatnonzero(begins)
        cuts = np.append(np.flatnonzero(cut), n)
        ends = cuts[np.searchsorted(cuts, starts) + 1]
        words = np.diff(np.searchsorted(starts, edge))
        return data, *((starts, ends) if place is None else (place[starts], place[ends])), words

    @staticmethod
    def _contractions(code, cut, edge) -> list[tuple[int, int]]:
        """(place, size) of the split pattern's endings: an apostrophe that begins a run of others."""
        out = []
        n = len(code)
        begins_piece = np.zeros(n + 1, bool)
        begins_piece[edge] = True
        for at in np.flatnonzero((code == 39) & cut).tolist():
            for ending in ("s", "t", "re", "ve", "m", "ll", "d"):  # in the pattern's order
                size = len(ending)
                if at + size < n and all(code[at + 1 + k] == ord(c) for k, c in enumerate(ending)) \
                        and not begins_piece[at + 1:at + 1 + size].any():
                    out.append((at, size + 1))
                    break
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (one more at the end)."""
        pieces, owner, special = [], [], []
        for i, t in enumerate(texts):
            for k, p in enumerate(self.special.split(t) if t and "<|" in t else [t or ""]):
                pieces.append("" if k % 2 else self._normal(p))
                owner.append(i)
                special.append(self.bpe.special[p] if k % 2 else -1)
        data, starts, ends, words = self._split(pieces)
        hashes, first, which = np.unique(ByteHashes(data).of(starts, ends), return_index=True,
                                         return_inverse=True)
        self._learn(hashes, lambda i: data[starts[first[i]]:ends[first[i]]].tobytes())
        place = np.searchsorted(self.hashes, hashes)[which]
        count = self.count[place]
        flat = self.flat[runs(self.start[place], count)]
        owner, special = np.array(owner, np.int64), np.array(special, np.int64)
        sums = np.concatenate([[0], np.cumsum(count)])
        edge = sums[np.concatenate([[0], np.cumsum(words)])]
        size = np.diff(edge) + (special >= 0)
        flat = np.insert(flat, edge[:-1][special >= 0], special[special >= 0])
        return flat, np.concatenate([[0], np.cumsum(np.bincount(owner, size, len(texts)).astype(np.int64))])

    @staticmethod
    def joined(flat: np.ndarray, at: np.ndarray, blob) -> list[memoryview]:
        """Each text's strings of the blob, joined by a space, as UTF-8."""
        raw, start, size = blob
        sizes = size[flat]
        out = memoryview(raw[runs(start[flat], sizes)])
        edge = np.concatenate([[0], np.cumsum(sizes)])[at].tolist()
        return [out[a:max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:])]


def decode(bpe: Bpe, ids: list[int]) -> str:
    """The tokens of the ids, word ends and special tokens included, joined by a space."""
    return " ".join(bpe.token[i] for i in ids)


def _encoded(docs: DataFrame, path: str | None, make, schema: str) -> DataFrame:
    bpe, state = Bpe(path), {}

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        if "encoder" not in state:  # one for each task
            state["encoder"] = Encoder(bpe)
        flat, at = state["encoder"].encode(piece.column("text").to_pylist())
        return make(piece, state["encoder"], flat, at)

    return map_texts(docs.select("doc_id", "text"), work, schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    def make(piece, encoder, flat, at):
        def sha(blob):
            return pa.array([hashlib.sha256(x).hexdigest() for x in encoder.joined(flat, at, blob)], pa.string())
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), pa.array(np.diff(at)),
             sha(encoder.numbers), sha(encoder.tokens)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _encoded(docs, path, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text."""
    def make(piece, encoder, flat, at):
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), pa.array(np.diff(at)),
             pa.ListArray.from_arrays(at.astype(np.int32), pa.array(flat.astype(np.int32)))],
            ["doc_id", "n_tokens", "ids"])

    return _encoded(docs, path, make, "doc_id long, n_tokens long, ids array<int>")


#: Ids that are decoded at once (a longer single list is decoded alone).
SLICE_IDS = 1 << 18


def decode_ids(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df(..., ids array<int>)`` with the decoded text of every row as ``decoded``.

    Null lists give null and empty ones the empty text; null ids and ids outside the
    vocabulary are left out, as the tokenizers library does.
    """
    token, state = Bpe(path).token, {}
    bounded_batches(df.sparkSession)

    def decoded(ids: pa.Array) -> pa.Array:
        if "blob" not in state:  # one for each task
            state["blob"] = _blob(token)
        size = ids.value_lengths().fill_null(0).to_numpy()
        flat, row = ids.flatten(), np.repeat(np.arange(len(ids)), size)
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        flat = flat.fill_null(0).to_numpy().astype(np.int64)
        known &= (flat >= 0) & (flat < len(token))
        at = np.concatenate([[0], np.cumsum(np.bincount(row[known], minlength=len(ids)))]).astype(np.int64)
        texts = [str(t, "utf-8") for t in Encoder.joined(flat[known], at, state["blob"])]
        return pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(batch.column("ids").value_lengths().fill_null(0).to_numpy())
            start = 0
            while start < batch.num_rows:
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_IDS, side="right")))
                piece = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*piece.columns, decoded(piece.column("ids"))],
                                                 [*piece.schema.names, "decoded"])
                start = stop

    return df.mapInArrow(run_batches, StructType([*df.schema.fields, StructField("decoded", StringType())]))
