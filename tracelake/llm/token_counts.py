"""Token counts: unigram segmentation of distinct pre-tokens by dynamic programming over a shared trie."""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.byte_bpe import read_ranks, ship_vocabulary, split_text
from tracelake.llm.common import as_bytes, byte_slices, shipped_file

#: Nodes of a worker's trie, after which it begins a new one; pre-tokens remembered beside it.
NODES = 400_000
REMEMBERED = 200_000
#: Scores are quantised to this, so that sums do not depend on the order of pieces.
UNIT = 1 << 20


def unigram_scores(ranks: dict[bytes, int], shift: float = 2.7) -> dict[bytes, int]:
    """Log probability of every token in units of 1/UNIT: by rank r it is in proportion to 1 / (r + shift)."""
    total = math.log(math.fsum(1 / (r + shift) for r in ranks.values()))
    return {t: round(-(math.log(r + shift) + total) * UNIT) for t, r in ranks.items()}


class TrieCounter:
    """Counts tokens of the best segmentation (highest score, then fewest tokens) of pre-tokens.

    Node d of a path stands for the first d bytes and holds the best score and token count of reaching it. Both depend
    on those bytes alone, so pre-tokens share them for as long as they share a prefix; a pre-token's answer is what
    its last node holds.
    """

    def __init__(self, scores: dict[bytes, int]):
        self.ends: dict[bytes, int | None] = {}  # every suffix of a token: its score if it is a token itself
        for t in scores:
            for i in range(1, len(t)):
                self.ends.setdefault(t[i:], None)
        self.ends.update(scores)
        self.reset()
        self.young: dict[str, tuple[int, int]] = {}
        self.old: dict[str, tuple[int, int]] = {}

    def reset(self) -> None:
        self.child: dict[int, int] = {}
        self.best = [0]
        self.count = [0]

    def insert(self, word: bytes) -> tuple[int, int]:
        """(tokens, score) of a pre-token; nodes that no earlier one had are added and scored."""
        child, best, count, ends = self.child, self.best, self.count, self.ends
        path = [0]
        node = 0
        for i, byte in enumerate(word, 1):
            key = node << 8 | byte
            node = child.get(key, 0)
            if not node:
                node = child[key] = len(best)
                top, least = -1 << 62, 0
                for j in range(i - 1, -1, -1):
                    part = word[j:i]
                    if part not in ends:
                        break
                    s = ends[part]
                    if s is not None:
                        before = path[j]
                        s += best[before]
                        if s > top or s == top and count[before] < least:
                            top, least = s, count[before]
                best.append(top)
                count.append(least + 1)
            path.append(node)
        return count[node], best[node]

    def text(self, text: str) -> tuple[int, int, int]:
        """(pre-tokens, tokens, score) of a text."""
        pieces = split_text(text)
        young, old = self.young, self.old
        if len(young) > REMEMBERED:
            self.old, self.young = old, young = young, {}
        for p in set(pieces).difference(young):
            got = old.get(p)
            if got is None:
                if len(self.best) > NODES:
                    self.reset()
                got = self.insert(p.encode("utf-8"))
            young[p] = got
        found = list(map(young.__getitem__, pieces))
        return len(pieces), sum(f[0] for f in found), sum(f[1] for f in found)


@lru_cache(2)
def _counter(path: str) -> TrieCounter:
    return TrieCounter(unigram_scores(read_ranks(path)))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, log_prob) per row for a rank file on the driver.

    Texts are split into pre-tokens by the rank file's pattern; each is segmented into tokens of the highest summed
    log probability, by Zipf's law over the ranks (every byte is a token, so there always is one). Null text counts as
    empty: no tokens, log probability zero. Rows are independent: no shuffle; the trie of a worker is bounded.
    """
    name = ship_vocabulary(docs.sparkSession, path)

    @F.arrow_udf("struct<n_pretokens:bigint,n_tokens:bigint,log_prob:double>")
    def run(text: pa.Array) -> pa.Array:
        c, rows = _counter(shipped_file(name)), []
        for part in byte_slices(text):
            for t in part.to_pylist():
                n, tokens, score = c.text(t.decode("utf-8", "replace"))
                rows.append({"n_pretokens": n, "n_tokens": tokens, "log_prob": score / UNIT})
        return pa.array(rows, pa.struct([("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64())]))

    out = docs.select(F.col(id_col).alias("doc_id"), run(as_bytes(text_col)).alias("r"))
    return out.select("doc_id", "r.n_pretokens", "r.n_tokens", "r.log_prob")
