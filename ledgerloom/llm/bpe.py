"""Byte-level BPE by a segment tree over byte positions (operator 4).

A text is split by the tokenizer's pattern. In each piece the tree holds, per byte
position, the rank of the pair that starts there; its root is the leftmost minimum. A
merge takes the root, joins the two live neighbours and updates three leaves, each in
logarithmic time, so that a piece of n bytes takes O(n log n) and not O(n^2).

Rows are independent: one map over the documents, no shuffle. Pieces repeat, so each
task keeps a bounded cache of encoded pieces; a batch's unknown pieces are encoded
together, their trees being rows of one array.

Defined cases: null text is empty and gives no ids; rows with equal or null ids are
encoded each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Callable
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame

from .common import mapped, texts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Pieces a task remembers; beyond it only those of the last batch are kept.
CACHE_PIECES = 500_000
# Pieces up to so many bytes are encoded many at a time; longer ones are rare and go one by one.
WIDEST_TOGETHER = 64
CELLS_TOGETHER = 1 << 21
NONE = np.int32((1 << 31) - 1)
# Pairs of ids are looked up in a table of so many slots, at the top bits of a product.
SLOT_BITS = 20
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)
HASH = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64((1 << 64) - 1)
_ENCODERS: dict[tuple[str, str], Encoder] = {}


@cache
def newer() -> regex.Pattern:
    """Letters and numbers that the regex module knows from a later Unicode version than tiktoken does."""
    probes = [tiktoken.Encoding("probe", pat_str=p, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={}) for p in (r"\p{L}", r"\p{N}")]
    known = regex.compile(r"[\p{L}\p{N}]")
    points = [c for c in range(sys.maxunicode + 1) if known.match(chr(c)) and not any(p.encode_ordinary(chr(c)) for p in probes)]
    ends = [(a, b) for a, b in zip([None, *points], [*points, None], strict=True) if a is None or b != a + 1]
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for (_, a), (b, _) in zip(ends, ends[1:], strict=False)) + "]" if points else r"(?!)")


def finder(pattern: str) -> Callable[[str], list[str]]:
    """The pattern's matches in a text, with the letters and numbers that tiktoken knows."""
    compiled = regex.compile(pattern)

    def find(text: str) -> list[str]:
        if text.isascii() or not newer().search(text):
            return compiled.findall(text)
        return [text[m.start():m.end()] for m in compiled.finditer(newer().sub("\ufffe", text))]  # no letter, number or space

    return find


def encoder_of(path: str, pattern: str) -> Encoder:
    """One encoder, and so one cache of pieces, a worker process."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


class Encoder:
    """Encodes pieces by the ranks of a vocabulary file, and decodes ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.find = finder(pattern)
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.decimal = [str(i) for i in range(len(self.vocabulary))]
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.uint64)
        self.pairs = pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.slot_key = np.full((1 << SLOT_BITS) + 4096, EMPTY)
        self.slot_rank = np.full(len(self.slot_key), NONE, np.int32)
        keys, values = np.array(list(pairs), np.uint64), np.array(list(pairs.values()), np.int32)
        slots = (keys * HASH >> SLOT_SHIFT).astype(np.int64)
        while len(keys):
            free = self.slot_key[slots] == EMPTY
            self.slot_key[slots[free]] = keys[free]  # of several for one slot the last stays
            placed = self.slot_key[slots] == keys
            self.slot_rank[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], slots[~placed] + 1
        self.numbers = list(range(len(self.vocabulary)))  # one int object an id, shared by the cache
        self.cache: dict[str, tuple[int, ...]] = {}

    def encode_batch(self, batch: list[str]) -> list[list[int]]:
        cache, pieces = self.cache, [self.find(text) for text in batch]
        if missing := list(set(chain.from_iterable(pieces)) - cache.keys()):
            cache.update(zip(missing, self._encode_pieces([p.encode() for p in missing]), strict=True))
        out = [list(chain.from_iterable(map(cache.__getitem__, p))) for p in pieces]
        if len(cache) > CACHE_PIECES:
            self.cache = {p: cache[p] for p in set(chain.from_iterable(pieces[-len(pieces) // 2:]))}
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))

    def _encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list = [None] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        widths = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            if width > WIDEST_TOGETHER:
                for i in rows.tolist():
                    out[i] = self._encode_one(pieces[i])
                continue
            for part in np.array_split(rows, -(-len(rows) * width // CELLS_TOGETHER)):
                for i, ids in zip(part.tolist(), self._encode_together([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        slot = (key * HASH >> SLOT_SHIFT).astype(np.int64)
        out = np.full(len(key), NONE, np.int32)
        rows = np.arange(len(key))
        while len(rows):  # linear probing; most pairs end at the first slot
            found = self.slot_key[slot]
            hit = found == key
            out[rows[hit]] = self.slot_rank[slot[hit]]
            on = ~hit & (found != EMPTY)
            rows, key, slot = rows[on], key[on], slot[on] + 1
        return out

    def _encode_together(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """One tree a row: leaves at width..2*width-1 hold rank * width + position, node k the lesser of 2k and 2k+1.

        All arrays are flat: position p of row r is at r * width + p, node k at r * 2 * width + k.
        """
        count = len(pieces)
        size = np.array([len(p) for p in pieces])
        text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        place = np.tile(np.arange(width, dtype=np.int32), count)
        live = place < np.repeat(size, width)
        ids = self.first[text]
        after = np.where(place + 1 < np.repeat(size, width), place + 1, width).astype(np.int32)
        before = place - 1
        wide = np.full((count, 2 * width), NONE, np.int32)
        paired = np.flatnonzero(after < width)
        rank = self._rank(ids[paired], ids[paired + 1])
        leaves = np.full(count * width, NONE, np.int32)
        leaves[paired] = np.where(rank < NONE, rank * width + place[paired], NONE)
        wide[:, width:] = leaves.reshape(count, width)
        level = width
        while level > 1:
            level //= 2
            wide[:, level:2 * level] = np.minimum(wide[:, 2 * level:4 * level:2], wide[:, 2 * level + 1:4 * level:2])
        tree = wide.reshape(-1)
        rows = np.flatnonzero(wide[:, 1] < NONE)
        while len(rows):
            base, root = rows * width, tree[rows * 2 * width + 1]
            left = root & (width - 1)
            at = base + left
            new = (root >> (width.bit_length() - 1)).astype(np.uint64)
            ids[at] = new
            right = after[at]
            live[base + right] = False
            beyond, prior = after[base + right], before[at]
            after[at] = beyond
            inner, some = np.flatnonzero(beyond < width), np.flatnonzero(prior >= 0)
            before[base[inner] + beyond[inner]] = left[inner]
            # The three leaves: the right one dies, the merged one and the one before it get new pairs.
            merged = np.full(len(rows), NONE, np.int32)
            rank = self._rank(np.concatenate((new[inner], ids[base[some] + prior[some]])),
                              np.concatenate((ids[base[inner] + beyond[inner]], new[some])))
            where = np.concatenate((left[inner], prior[some]))
            value = np.where(rank < NONE, rank * width + where, NONE)
            merged[inner] = value[:len(inner)]
            tree[2 * base + width + right] = NONE
            tree[2 * base + width + left] = merged
            tree[2 * base[some] + width + prior[some]] = value[len(inner):]
            offset = np.concatenate((2 * base, 2 * base, 2 * base[some]))
            node = np.concatenate((right, left, prior[some])) + width
            for _ in range(width.bit_length() - 1):
                child = offset + (node & ~1)
                node = node >> 1
                tree[offset + node] = np.minimum(tree[child], tree[child + 1])
            rows = rows[tree[2 * base + 1] < NONE]
        flat, number = ids[live].tolist(), self.numbers
        ends = np.cumsum(live.reshape(count, width).sum(axis=1)).tolist()
        flat = [number[i] for i in flat]
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def _encode_one(self, piece: bytes) -> tuple[int, ...]:
        """The same tree for one long piece."""
        size = len(piece)
        width, none, pairs = 1 << (size - 1).bit_length(), 1 << 62, self.pairs
        ids: list = self.first[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        tree = [none] * (2 * width)

        def leaf(at: int) -> int:
            rank = pairs.get(ids[at] << 20 | ids[after[at]]) if after[at] < size else None
            return none if rank is None else rank * width + at

        for at in range(size):
            tree[width + at] = leaf(at)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            rank, left = divmod(tree[1], width)
            right = after[left]
            ids[left], ids[right], after[left] = rank, None, after[right]
            if after[left] < size:
                before[after[left]] = left
            for at, value in ((right, none), (left, leaf(left)), *(((before[left], leaf(before[left])),) if before[left] >= 0 else ())):
                node = width + at
                tree[node] = value
                while node > 1:
                    node >>= 1
                    lesser = min(tree[2 * node], tree[2 * node + 1])
                    if tree[node] == lesser:
                        break
                    tree[node] = lesser
        return tuple(i for i in ids if i is not None)


def _coded(df: DataFrame, finish: Callable[[Encoder, list[int]], tuple], schema: str, vocabulary: str | None) -> DataFrame:
    path, pattern = vocabulary or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN

    def rows():
        encoder = encoder_of(path, pattern)
        return lambda b: [(i, *finish(encoder, ids)) for i, ids in zip(b["doc_id"], encoder.encode_batch(b["text"]), strict=True)]

    return mapped(texts(df, "doc_id"), rows, f"doc_id long, {schema}")


def encode(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and token_ids (array of int) of every row's whole text."""
    return _coded(df, lambda _, ids: (ids,), "token_ids array<int>", vocabulary)


def decode(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and text of rows with token_ids; bytes that are no UTF-8 become replacement characters."""
    path, pattern = vocabulary or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN

    def rows():
        encoder = encoder_of(path, pattern)
        return lambda b: [(i, encoder.decode(ids or []).decode(errors="replace")) for i, ids in zip(b["doc_id"], b["token_ids"], strict=True)]

    return mapped(df.select("doc_id", "token_ids"), rows, "doc_id long, text string")


def digests(encoder: Encoder, ids: list[int]) -> tuple[int, str, str]:
    """Count, sha256 of the decimal ids joined by commas, sha256 of the decoded bytes."""
    joined = ",".join(map(encoder.decimal.__getitem__, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()


def round_trip(df: DataFrame, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        return _coded(df, lambda e, ids: (*digests(e, ids), ids), f"{schema}, token_ids array<int>", vocabulary)
    return _coded(df, digests, schema, vocabulary)
