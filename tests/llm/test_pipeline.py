"""The corpus pipeline: every stage's rows against plain versions on the smallest table."""

import hashlib
import re

import duckdb
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline as P
from tracelake.llm import byte_bpe, line_dedup, quality_crf

SF = "/root/testdata/sf0.001"


def plain_lines(rows):
    where = {}
    for i, t in rows.items():
        for line in t.split("\n"):
            where.setdefault(line_dedup.line_key(line.encode()), set()).add(i)
    common = {k for k, d in where.items() if k and len(d) >= 10}
    return {i: "\n".join(x for x in t.split("\n") if line_dedup.line_key(x.encode()) not in common) for i, t in rows.items()}


def plain_fingerprint(text):
    """By the xxhash library, shingle by shingle and bit by bit."""
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_near(rows):
    fps = {i: plain_fingerprint(t) for i, t in rows.items()}
    label = {i: i for i in rows}
    changed = True
    while changed:
        changed = False
        for i in rows:
            for j in rows:
                if label[j] < label[i] and (fps[i] ^ fps[j]).bit_count() <= 2:
                    label[i], changed = label[j], True
    return {i: t for i, t in rows.items() if label[i] == i}


def test_pipeline_equals_plain_stages(spark):
    con = duckdb.connect()
    rows = dict(con.execute(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall())
    items = con.execute(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fold = quality_crf.held_out()
    model = quality_crf.train(docs.where(~fold), labels.where(~fold))
    rows = {i: t for i, t in rows.items() if quality_crf.score_texts(model, [t.encode()])[0] >= 0.3}
    rows = plain_near(plain_lines(rows))
    rows = {i: t for i, t in rows.items() if not any(p in t for _, p in items)}
    path = public_tokenizers.path(P.VOCABULARY)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    got = {r.doc_id: r for r in P.run(spark, SF).collect()}
    assert set(got) == set(rows)
    for i, t in rows.items():
        ids = enc.encode_ordinary(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns_and_take_edge_rows(spark, k):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "x", "en", "s", 1), (2, "", "en", None, 0), (3, "w " * 70_000, None, "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = P.STAGES[k][1](spark, docs, SF)
    assert out.columns == docs.columns and out.count() <= 5
    assert P.STAGES[k][1](spark, docs.limit(0), SF).count() == 0
