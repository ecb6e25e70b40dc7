"""Token counts against a plain Viterbi search over each pre-token."""

import math
import random

import public_tokenizers

from tracelake.llm import token_counts as C
from tracelake.llm.byte_bpe import read_ranks, split_text

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCORES = C.unigram_scores(read_ranks(PATH))
LONGEST = max(map(len, SCORES))


def plain(word: bytes):
    best = [(0, 0)]
    for i in range(1, len(word) + 1):
        found = [(best[j][0] + SCORES[word[j:i]], best[j][1] - 1) for j in range(max(0, i - LONGEST), i) if word[j:i] in SCORES]
        best.append(max(found))
    return -best[-1][1], best[-1][0]


def texts():
    rnd = random.Random(8)
    syllables = ["th", "er", "on", "an", "ing", "ed", "é", "日本", "ß", "2024", "the", "!", "'s", " ", "  ", "\n"]
    return ["".join(rnd.choice(syllables) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 60))) for _ in range(300)]


def test_scores_are_probabilities():
    assert abs(math.fsum(math.exp(s / C.UNIT) for s in SCORES.values()) - 1) < 1e-4


def test_counts_equal_plain_search():
    c = C.TrieCounter(SCORES)
    for t in [*texts(), "a" * 2000, "", " ", "🙂" * 50]:
        pieces = split_text(t)
        want = [plain(p.encode()) for p in pieces]
        assert c.text(t) == (len(pieces), sum(w[0] for w in want), sum(w[1] for w in want))


def test_prefixes_are_scored_once():
    c = C.TrieCounter(SCORES)
    c.insert(b"thersting")
    n = len(c.best)
    assert c.insert(b"therst") == plain(b"therst") and len(c.best) == n
    c.insert(b"therstone")
    assert len(c.best) == n + 3


def test_bounded_trie(monkeypatch):
    monkeypatch.setattr(C, "NODES", 40)
    monkeypatch.setattr(C, "REMEMBERED", 5)
    c = C.TrieCounter(SCORES)
    for t in texts()[:100]:
        want = [plain(p.encode()) for p in split_text(t)]
        assert c.text(t)[1:] == (sum(w[0] for w in want), sum(w[1] for w in want))


def test_edge_rows(spark):
    rows = [(1, None, 0), (None, "the the", 1), (2, "", 1), (2, "", 1), (3, "z" * 150_000, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = sorted((tuple(r) for r in C.token_counts(docs, PATH).collect()), key=str)
    want = []
    for i, t, _ in rows:
        each = [plain(p.encode()) for p in split_text(t or "")]
        want.append((i, len(each), sum(w[0] for w in each), sum(w[1] for w in each) / C.UNIT))
    assert got == sorted(want, key=str)
    assert C.token_counts(docs.limit(0), PATH).count() == 0
