"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity."""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tracelake.llm.common import as_bytes, byte_slices, ship
from tracelake.llm.words import mixed, shingle_hashes, split_words

#: Benchmark items and bytes of their texts that one pass over the documents carries; more items make more passes.
ITEMS_EACH_PASS = 25_000
BYTES_EACH_PASS = 16 << 20
#: Windows that are looked at together.
WINDOWS = 4096
SHINGLE = 5
SIMILARITY = 0.8
#: Largest number of differing fingerprint bits of a candidate. At similarity 0.8 about ten bits differ.
RADIUS = 22
BLOCKS = 8
SLICE = 2 << 20
_FILTER_BITS = 22
_NEXT = np.uint64(0xD6E8FEB86659FD93)
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def numbered(h: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Hash of a shingle and the number of its occurrence: the shingle's own for the first one."""
    return np.where(number > 0, mixed(h + number.astype(np.uint64) * _NEXT), h)


def window_fingerprints(h: np.ndarray, width: int) -> np.ndarray:
    """SimHash bytes of every window of ``width`` shingles over (shingle, number of its occurrence in the window).

    Weighted Jaccard similarity of two bags is the Jaccard similarity of these sets, and repeats do not vote together. A
    step of the window takes the last number of one shingle away and adds the next number of another.
    """
    n = len(h)
    order = np.argsort(h, kind="stable")
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    begin = np.flatnonzero(new)
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(new) - 1
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n) - begin[np.cumsum(new) - 1]
    out, into = np.arange(n - width), np.arange(width, n)
    if len(begin) == n:
        lost = gained = np.zeros(n - width, np.int64)
    else:
        keys = group[order] * (n + 1) + order
        before = lambda at, bound: np.searchsorted(keys, group[at] * (n + 1) + bound) - begin[group[at]]
        lost = before(out, out + width) - rank[out] - 1
        gained = rank[into] - before(into, out + 1)
    first = hash_bits(numbered(h[:width], rank[:width])).sum(0, dtype=np.int64)
    steps = hash_bits(numbered(h[into], gained)).astype(np.int8) - hash_bits(numbered(h[out], lost)).astype(np.int8)
    ones = first + np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(steps, axis=0, dtype=np.int64)])
    return np.packbits(2 * ones > width, axis=1)


def hash_bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def bag(words: list[bytes], k: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(k)), strict=False))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags of shingles (weight: number of occurrences)."""
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return low / (sum(a.values()) + sum(b.values()) - low) if low else 0.0


@dataclass
class Group:
    """Items of one length in words; ``blocks[b][v]`` marks the items whose block b is near the byte v."""

    size: int
    items: list[int] = field(default_factory=list)
    place: dict = field(default_factory=dict)  #: item -> its place in ``items``
    fps: np.ndarray | None = None
    blocks: np.ndarray | None = None


@dataclass
class Index:
    items: list  #: (id, words)
    k: dict  #: shingle length -> (filter, sorted hashes, first of each in the items, items that have it)
    groups: dict  #: words of an item -> Group


def shingle_length(words: int) -> int:
    """Items under five words are one shingle."""
    return min(SHINGLE, words)


def build_index(rows: list[tuple]) -> Index:
    """Index of (id, UTF-8 text) items; items without words match nothing and are left out."""
    items = [(i, t.lower().split()) for i, t in rows if t is not None and t.split()]
    hashes, owners = defaultdict(list), defaultdict(list)
    groups: dict[int, Group] = {}
    fps = defaultdict(list)
    for at, (_, words) in enumerate(items):
        k = shingle_length(len(words))
        h = shingle_hashes(split_words([b" ".join(words)]).hash, k)
        distinct = np.unique(h)
        hashes[k].append(distinct)
        owners[k].append(np.full(len(distinct), at, np.int32))
        g = groups.setdefault(len(words), Group(len(words)))
        g.place[at] = len(g.items)
        g.items.append(at)
        fps[len(words)].append(window_fingerprints(h, len(h))[0])
    near = RADIUS // BLOCKS  # of 8 blocks, one has at most this many of the differing bits
    close = _POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)] <= near
    for size, g in groups.items():
        g.fps = np.array(fps[size])
        g.blocks = np.stack([close[:, g.fps[:, b]] for b in range(BLOCKS)])
    tables = {}
    for k in hashes:
        h, owner = np.concatenate(hashes[k]), np.concatenate(owners[k])
        order = np.argsort(h, kind="stable")
        keys, first = np.unique(h[order], return_index=True)
        flags = np.zeros(1 << _FILTER_BITS, bool)
        flags[keys >> np.uint64(64 - _FILTER_BITS)] = True
        tables[k] = (flags, keys, np.append(first, len(h)), owner[order])
    return Index(items, tables, groups)


def _spans(at: list[int], size: int, k: int, n_words: int) -> list[tuple[int, int]]:
    """Merged ranges [a, b] of starts of the windows of ``size`` words that contain a shingle found at one of ``at``."""
    last = max(0, n_words - size)
    out: list[list[int]] = []
    for p in sorted(at):
        a, b = max(0, p - size + k), min(p, last)
        a = min(a, last)
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def matches_of(index: Index, words: list[bytes], h: np.ndarray, hits: list[tuple[int, int, int]]) -> list[tuple]:
    """(item id, similarity of the best window, its first word, windows found) of one text.

    hits: (shingle length, position, row of the index) of every shingle that some item has. A window without any is at
    similarity zero, so only windows that hold one are fingerprinted.
    """
    where = defaultdict(list)  # item -> places of its shingles, in order
    for k, p, row in sorted(hits, key=lambda x: x[1]):
        _, _, first, owner = index.k[k]
        for item in owner[first[row] : first[row + 1]].tolist():
            where[item].append(p)
    of_size = defaultdict(list)
    for item in where:
        of_size[len(index.items[item][1])].append(item)
    best: dict[int, list] = {}
    bags: dict[int, Counter] = {}
    for size, found in of_size.items():
        g, k = index.groups[size], shingle_length(size)
        sh = shingle_hashes(h, k)
        width, full = min(size, len(words)) - k + 1, size - k + 1  # a shorter text is one window
        # as many shingles a window shares with an item at least, if they are similar enough
        least = SIMILARITY * (width + full) / (1 + SIMILARITY) - 1e-6
        many = {item: np.array(where[item]) for item in found if len(where[item]) >= least}
        for a, b in _spans(sorted({p for item in found for p in where[item]}), size, k, len(words)):
            for begin in range(a, b + 1, WINDOWS):
                starts = np.arange(begin, min(b + 1, begin + WINDOWS))
                fp = window_fingerprints(sh[begin : starts[-1] + width], width)
                cand = np.zeros((len(starts), len(g.items)), bool)
                for block in range(BLOCKS):
                    cand |= g.blocks[block][fp[:, block]]
                w, i = np.nonzero(cand)
                far = _POPCOUNT[fp[w] ^ g.fps[i]].sum(1) > RADIUS
                cand[w[far], i[far]] = False
                for item, places in many.items():  # windows whose bits differ in more, though they share enough
                    shared = np.searchsorted(places, starts + width) - np.searchsorted(places, starts)
                    cand[shared >= least, g.place[item]] = True
                w, i = np.nonzero(cand)
                for start, j in zip((w + begin).tolist(), i.tolist(), strict=True):
                    item = g.items[j]
                    if item not in bags:
                        bags[item] = bag(index.items[item][1], k)
                    s = similarity(bag(words[start : start + size], k), bags[item])
                    if s >= SIMILARITY:
                        old = best.setdefault(item, [s, start, 0])
                        if (-s, start) < (-old[0], old[1]):
                            old[0], old[1] = s, start
                        old[2] += 1
    return sorted((index.items[item][0], s, start, n) for item, (s, start, n) in best.items())


def find_matches(index: Index, texts: list[bytes]) -> list[list[tuple]]:
    """Matches of each text."""
    out: list[list[tuple]] = [[] for _ in texts]
    w = split_words(texts)
    hits = defaultdict(list)
    for k, (flags, keys, _, _) in index.k.items():
        sh = shingle_hashes(w.hash, k)
        p = np.flatnonzero(flags[sh >> np.uint64(64 - _FILTER_BITS)])
        row = np.searchsorted(keys, sh[p])
        good = keys[np.minimum(row, len(keys) - 1)] == sh[p]
        p, row = p[good], row[good]
        doc = np.searchsorted(w.first, p, side="right") - 1
        inside = p + k <= w.first[doc + 1]
        for d, at, r in zip(doc[inside].tolist(), p[inside].tolist(), row[inside].tolist(), strict=True):
            hits[d].append((k, at - int(w.first[d]), r))
    for d, found in hits.items():
        a, b = w.first[d], w.first[d + 1]
        out[d] = matches_of(index, texts[d].lower().split(), w.hash[a:b], found)
    return out


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark in disjoint blocks of bounded size, by the hash of the row."""
    src = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("binary").alias("text")).distinct()
    row = src.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("b")).first()
    n = max(1, -(-row["n"] // ITEMS_EACH_PASS), -(-row["b"] // BYTES_EACH_PASS))
    return [src.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)] if n > 1 else [src]


def _matcher(index: Index, item: DataType):
    names = ("item_id", "similarity", "first_word", "windows")
    element = pa.struct(list(zip(names, (to_arrow_type(item), pa.float64(), pa.int32(), pa.int32()), strict=True)))

    @F.arrow_udf(f"array<struct<item_id:{item.simpleString()},similarity:double,first_word:int,windows:int>>")
    def run(text: pa.Array) -> pa.Array:
        rows = [m for part in byte_slices(text, SLICE) for m in find_matches(index, part.to_pylist())]
        return pa.array([[dict(zip(names, m, strict=True)) for m in r] for r in rows], pa.list_(element))

    return run.asNondeterministic()


def _with_matches(docs: DataFrame, text_col: str, block: DataFrame, to: str) -> DataFrame:
    """``docs`` with the matches of one block of items; the block is gathered and travels with the tasks."""
    rows = sorted(((r["item"], None if r["text"] is None else bytes(r["text"])) for r in block.collect()), key=str)
    run = _matcher(build_index(rows), block.schema["item"].dataType)
    return docs.withColumn(to, run(as_bytes(text_col)))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, windows): every document row and item with a window at 0.8 or more.

    Words are split at ASCII white space with A-Z lower-cased. A window has as many words as the item (a shorter text is
    one window); both are bags of five-word shingles (an item under five words: one shingle), and similarity is the
    weighted Jaccard coefficient. A window that shares no shingle with an item of its size is at zero and is skipped;
    every other one is fingerprinted (repeats of a shingle count as features of their own), found through the Hamming
    blocks if within ``RADIUS`` bits, and verified on the words themselves. At 0.8 the radius is a matter of chance, so
    windows beyond it that share as many shingles with an item as that similarity needs are verified, too: every pair and
    every window is found. Documents are read once for up to ``ITEMS_EACH_PASS`` items. Null and wordless texts and items match nothing. No shuffle of documents.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = []
    for block in _item_blocks(benchmark, item_col, item_text_col):
        found = _with_matches(src, "text", block, "m").where(F.size("m") > 0)
        parts.append(found.select("doc_id", F.inline("m")))
    return reduce(DataFrame.unionByName, parts)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs`` without any match, with their columns."""
    ship(docs.sparkSession)
    out = docs
    for block in _item_blocks(benchmark, item_col, item_text_col):
        out = _with_matches(out, text_col, block, "__m").where(F.size("__m") == 0).select(*docs.columns)
    return out
