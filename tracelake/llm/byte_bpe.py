"""Byte-level BPE: a segment tree over byte positions keeps the leftmost pair of the lowest rank."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, byte_slices, ship, ship_file, shipped_file

#: The split pattern of the rank files (fixed value, equal to public_tokenizers.PATTERN).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens that a worker remembers in each of two generations.
REMEMBERED = 250_000
_NONE = 1 << 60
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4


@lru_cache(1)
def _char_classes() -> np.ndarray:
    """Class of every code point under the pattern's own \\p{L}, \\p{N} and \\s."""
    table = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            table[a : b + 1] = kind
    return table


#: Contractions of the pattern, in its order.
_SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


def split_text(text: str) -> list[str]:
    """The matches of ``PATTERN`` in order, found from runs of equal character class.

    A run of letters, numbers or other signs takes one space before it. The white space before that is a piece; so is a
    last white space that is no plain space. An apostrophe alone before a contraction's letters joins those letters.
    """
    if not text:
        return []
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _char_classes()[code]
    n = len(kind)
    run = np.flatnonzero(np.diff(kind, prepend=0))
    of = kind[run]
    end = np.append(run[1:], n)
    cut = np.zeros(n + 1, bool)
    cut[run] = True
    blank = np.flatnonzero((of == _SPACE) & (end < n))
    last = end[blank] - 1
    plain = code[last] == 32
    cut[last] = True
    cut[last[plain] + 1] = False
    lone = np.flatnonzero((of[:-1] == _OTHER) & (end[:-1] - run[:-1] == 1) & (of[1:] == _LETTER))
    lone = lone[code[run[lone]] == 39]
    for r in lone.tolist():
        at = int(run[r])
        if at and code[at - 1] == 32:
            continue
        for suffix in _SUFFIXES:
            if text.startswith(suffix, at + 1):
                cut[at + 1] = False
                if kind[at + 1 + len(suffix) : at + 2 + len(suffix)].tolist() == [_LETTER]:
                    cut[at + 1 + len(suffix)] = True
                break
    at = np.flatnonzero(cut[:n]).tolist()
    at.append(n)
    return [text[a:b] for a, b in zip(at, at[1:], strict=False)]


def _put(tree: list[int], at: int, rank: int) -> None:
    """Set a leaf and the minima above it, as far as they change."""
    while at and tree[at] != rank:
        tree[at] = rank
        beside = tree[at ^ 1]
        if beside < rank:
            rank = beside
        at >>= 1


class Merger:
    """Encoder of pre-tokens by a table of ranks {bytes: rank}."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: always the lowest pair rank is merged, of equal ones the leftmost.

        Leaf i of the tree holds the rank of the pair that starts at byte i and is live, an inner node the minimum of its
        two children. A merge sets three leaves: the pair of the grown part, the vanished one and the left neighbour's.
        """
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        get = ranks.get
        n = len(piece)
        leaves = 1 << max(n - 2, 0).bit_length()
        tree = [_NONE] * leaves
        tree += [get(piece[i : i + 2], _NONE) for i in range(n - 1)]
        tree += [_NONE] * (2 * leaves - len(tree))
        for i in range(leaves - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a <= b else b
        end = list(range(1, n + 1))  # end of the part that starts at byte i
        start = list(range(n))  # start of the part whose last byte is i
        while (low := tree[1]) != _NONE:
            node = 1
            while node < leaves:
                node *= 2
                if tree[node] != low:
                    node += 1
            i = node - leaves
            j = end[i]
            stop = end[j]
            end[i], start[stop - 1] = stop, i
            if j < n - 1:
                _put(tree, j + leaves, _NONE)
            _put(tree, node, get(piece[i : end[stop]], _NONE) if stop < n else _NONE)
            if i:
                h = start[i - 1]
                _put(tree, h + leaves, get(piece[h:stop], _NONE))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text. Recent pre-tokens are remembered in two generations of bounded size."""
        pieces = split_text(text)
        young, old = self.young, self.old
        if len(young) > REMEMBERED:
            self.old, self.young = old, young = young, {}
        for p in set(pieces).difference(young):
            ids = old.get(p)
            young[p] = self.merge(p.encode("utf-8")) if ids is None else ids
        return list(chain.from_iterable(map(young.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines "base64 rank"; every single byte must be there."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the rank file lacks single bytes: {missing[:5]}")
    return ranks


@lru_cache(2)
def _merger(path: str) -> Merger:
    return Merger(read_ranks(path))


def worker_merger(name: str) -> Merger:
    """The worker's encoder for a vocabulary that was sent under ``name`` (``common.ship_file``), read once per worker."""
    return _merger(shipped_file(name))


def ship_vocabulary(spark: SparkSession, path: str) -> str:
    """Send a rank file to the executors under a name made from its content; returns the name."""
    ship(spark)
    return ship_file(spark, path)


_RESULT = "struct<n_tokens:bigint,ids:array<int>,decoded:binary>"
_DIGEST = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) per row: ids of the whole text and the bytes they decode to.

    ``path`` is a rank file on the driver. Null text counts as empty. Bytes that are no UTF-8 become U+FFFD before
    encoding, as a tokenizer of strings would get them. No special tokens: their strings are ordinary text.
    """
    name = ship_vocabulary(docs.sparkSession, path)

    @F.arrow_udf(_RESULT)
    def run(text: pa.Array) -> pa.Array:
        m, rows = worker_merger(name), []
        for part in byte_slices(text):
            for t in part.to_pylist():
                ids = m.encode(t.decode("utf-8", "replace"))
                rows.append({"n_tokens": len(ids), "ids": ids, "decoded": m.decode(ids)})
        return pa.array(rows, pa.struct([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]))

    out = docs.select(F.col(id_col).alias("doc_id"), run(as_bytes(text_col)).alias("r"))
    return out.select("doc_id", "r.n_tokens", "r.ids", "r.decoded")


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row: ``encode_decode`` with the digests made beside the ids,
    so that neither ids nor texts travel back (ids as decimals joined by commas)."""
    name = ship_vocabulary(docs.sparkSession, path)

    @F.arrow_udf(_DIGEST)
    def run(text: pa.Array) -> pa.Array:
        m, rows = worker_merger(name), []
        sha = hashlib.sha256
        for part in byte_slices(text):
            for t in part.to_pylist():
                ids = m.encode(t.decode("utf-8", "replace"))
                joined = ",".join(map(m.text_of.__getitem__, ids))
                rows.append((len(ids), sha(joined.encode()).hexdigest(), sha(m.decode(ids)).hexdigest()))
        names = ("n_tokens", "ids_sha256", "decoded_sha256")
        kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        return pa.array([dict(zip(names, r, strict=True)) for r in rows], kind)

    out = docs.select(F.col(id_col).alias("doc_id"), run(as_bytes(text_col)).alias("r"))
    return out.select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256")
