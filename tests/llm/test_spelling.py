"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tracelake.llm import spelling
from tracelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def neighbours(words):
    """{word: words one edit apart}, by comparing every pair."""

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    by_len = {}
    for w in words:
        by_len.setdefault(len(w), []).append(w)
    return {w: [v for k in (-1, 0, 1) for v in by_len.get(len(w) + k, ()) if near(w, v)] for w in words}


def plain(counts, times=10):
    """{word: (form, root, n, n_near, form_n)} from {word: n}."""
    near, form = neighbours(counts), {}
    for w, found in near.items():
        best = min(((-counts[v], v) for v in found), default=None)
        form[w] = best[1] if best and -best[0] >= times * counts[w] else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def plain_vocabulary(docs, min_chars=7, min_count=2, drop_one_in=31):
    total = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if drop_one_in and h % drop_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_chars and n >= min_count}


def as_dict(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def made_words(seed, n=400, alphabet="abé", low=3, high=9):
    rng = random.Random(seed)
    return {"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))): rng.choice([2, 3, 5, 20, 30, 400, 5000]) for _ in range(n)}


@pytest.mark.parametrize("seed", range(12))
def test_composition_accepts_exactly_the_near_pairs(seed):
    words = sorted(made_words(seed, 200, "ab" if seed % 2 else "abcd", 0, 7))
    pairs = spelling.near_pairs(words)
    assert len(pairs) == len(set(map(frozenset, pairs)))
    expected = {frozenset((u, v)) for u, found in neighbours(words).items() for v in found}
    assert set(map(frozenset, pairs)) == expected
    first = {p for p in expected if len({w[:1] for w in p}) == 2}
    assert set(map(frozenset, spelling.near_pairs(words, True))) == first


def test_acceptor_is_minimal_and_accepts_its_words():
    words = sorted(a + m + e for a in ("un", "re", "") for m in ("load", "lock", "lad") for e in ("ed", "ing", ""))
    a = spelling.Acceptor(words)
    got, todo = [], [("", a.start)]
    while todo:
        path, q = todo.pop()
        got += [path] * a.final[q]
        todo += [(path + x, r) for x, r in a.arcs[q].values()]
    assert sorted(got) == words
    right = {}
    for q in range(len(a.final)):
        lang, todo = set(), [("", q)]
        while todo:
            path, r = todo.pop()
            if a.final[r]:
                lang.add(path)
            todo += [(path + x, s) for x, s in a.arcs[r].values()]
        assert right.setdefault(frozenset(lang), q) == q  # no two states of one language


@pytest.mark.parametrize(("seed", "group"), [(1, 10_000), (2, 40), (3, 5), (4, 1)])
def test_partitions_lose_and_repeat_nothing(spark, seed, group):
    counts = made_words(seed)
    counts |= {"samebeginning" + w: n for w, n in made_words(seed + 50, 60).items()}  # a hot prefix that parts late
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_dict(spelling.group_variants(df, 10, group)) == plain(counts)


def test_chains_ties_and_levels(spark):
    counts = {"aaaaaaa": 3, "aaaaaab": 30, "aaaaabb": 300, "aaaabbb": 3000, "aaabbbb": 30_000, "aabbbbb": 300_000, "zzzzzzz": 2, "zzzzzzy": 20, "zzzzzzx": 20, "yyyyyyyy": 2, "yyyyyyy": 19}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = as_dict(spelling.group_variants(df))
    assert got == plain(counts)
    assert got["aaaaaaa"][:2] == ("aaaaaab", "aabbbbb") and got["zzzzzzz"][0] == "zzzzzzx" and got["yyyyyyyy"][0] is None


def test_very_long_words(spark):
    long = "ab" * 200_000
    counts = {long: 2, long + "c": 20, "x" + long: 50, "a" * 300_000: 2, "a" * 300_001: 30, long[:-1] + "cc": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    for group in (100, 2):
        got = as_dict(spelling.group_variants(df, 10, group))
        assert got[long] == ("x" + long, "x" + long, 2, 2, 50) and got["a" * 300_000][0] == "a" * 300_001
        assert got[long + "c"][3] == 2 and got[long[:-1] + "cc"][3] == 1


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_vocabulary(docs)
    got = QUERIES["op12_spelling"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_dict(got) == plain(counts) and len(counts) > 500


def test_vocabulary_of_odd_rows(spark):
    rows = [(None, "Überraschung überraschung Überraschung"), (1, None), (2, ""), (3, "x" * 6 + " " + "y" * 7 + "1" + "Y" * 7 + "×÷ÿ" * 3), (3, "y" * 7), (4, "word" * 50_000)] * 2
    rows += [(k, f"planted misspelling number{'abcdefgh'[k % 8]}xyz") for k in range(200)]
    df = spark.createDataFrame([(*r, 9, "clash") for r in rows], "doc_id long, text string, n int, word string")
    got = {r.word: r.n for r in spelling.vocabulary(df, drop_one_in=31).collect()}
    assert got == plain_vocabulary([("" if i is None else i, t) for i, t in rows])
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == plain_vocabulary(rows, drop_one_in=None)


def test_empty_table_and_no_near_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(empty).collect() == []
    df = spark.createDataFrame([("alone", 5)], "word string, n long")
    assert as_dict(spelling.group_variants(df)) == {"alone": (None, "alone", 5, 0, None)}
    with pytest.raises(ValueError):
        spelling.group_variants(df, 1)
