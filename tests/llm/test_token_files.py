"""Token files: planes, chunk index, order, starts and digests against the tokenizers library."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tracelake.llm import token_files as tf
from tracelake.llm.common import scratch
from tracelake.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows, path=WORDS, end=(1,)):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows that are in order, each text encoded whole."""
    t, out, at = Tokenizer.from_file(path), [], 0
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + list(end)
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_planes_round_trip(planes, n):
    rng = np.random.default_rng(n)
    for top in (1, 2, 256, 65_537, 2**32):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        parts = tf.to_planes(ids, planes)
        assert len(parts) == planes and np.array_equal(tf.from_planes(parts, n), ids)
        assert all(not p or any(p) for p in parts)


@pytest.mark.parametrize("planes", [4, 32])
def test_index_finds_any_span(planes):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    w, docs = tf.FileWriter(3, 2, planes, 100, pa.int64()), []
    for i in range(40):
        docs.append(rng.integers(0, 50_000, int(rng.integers(0, 300))).astype("<u4"))
        w.add(i, docs[-1].tobytes())
    data = w.close() + tf.END
    f, every = tf.TokenFile(data), np.concatenate(docs)
    assert (f.part, f.seq, f.n_ids) == (3, 2, len(every))
    assert [x.tolist() for _, x in f.documents()] == [d.tolist() for d in docs]
    for a, b in ((0, 0), (0, 1), (99, 101), (100, 200), (250, 1234), (0, len(every)), (len(every) - 1, len(every))):
        assert f.ids(a, b).tolist() == every[a:b].tolist()
    with pytest.raises(ValueError):
        tf.TokenFile(data[:-3])


def rows_of(df):
    return [tuple(r) for r in df.orderBy("start", "doc_id").collect()]


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op11_token_files"](spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert rows_of(got) == expected(docs)


def test_words_of_all_kinds_of_white_space(spark):
    odd = ["", " ", "a\tb\nc\x0bd\x0ce\rf", "x\x1cy\x85z q\xa0r", "it's we'LL ́a é É", "ΣαΣ Σ", "<|endoftext|>a<|startoftext|> b", "<|endof text|>", "a" * 500 + " " + "b" * 500, "가 ᆨ", "1234 5.6!?", "Word. WORD, word?! .word 'word' w.o word.1 wörd; <|ENDOFTEXT|> end:<|endoftext|>.", "ÉTÉ été, straße$$$ ÿ×y ÷ø Ø.' naïve### (ça) e\u0301te\u0301 ǅ İi", None]
    rows = list(enumerate(odd))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(tf.file_round_trip(df, WORDS, words=True)) == expected(rows)
    assert rows_of(tf.file_round_trip(df, WORDS, words=False, planes="bit")) == expected(rows)
    assert rows_of(tf.file_round_trip(df, BYTES, end_id=None)) == expected(rows, BYTES, ())


def test_small_files_and_blocks_keep_order_and_documents_whole(spark):
    rows = [(i, f"word{i} " * (i % 50)) for i in range(300)] + [(300, "long text " * 20_000)]
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(7)
    path = scratch(spark, "token-files-test")
    tf.write_token_files(df, WORDS, path, words=True, planes="bit", block_ids=64, file_ids=500)
    got = tf.read_documents(spark, path, with_ids=True)
    assert [tuple(r) for r in got.drop("ids").orderBy("start").collect()] == expected(rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got.collect())
    files = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    sizes = [tf.TokenFile(bytes(r.content)) for r in files]
    assert len(sizes) > 20 and all(f.n_ids - f.docs["n_tokens"].to_pylist()[-1] < 500 for f in sizes)


def test_repeated_null_and_text_ids_and_clashing_columns(spark):
    rows = [(None, "no id"), (5, "b"), (5, "a"), (5, "a"), (2, None)] + [(7, "same")] * 50
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, part int, place int, ids int")
    got = rows_of(tf.file_round_trip(df, WORDS, words=True))
    assert [g[0] for g in got] == [None, 2, 5, 5, 5] + [7] * 50
    assert sorted((g[0] or 0, g[2], g[3]) for g in got) == sorted((e[0] or 0, e[2], e[3]) for e in expected(rows))
    assert [g[1] for g in got] == np.concatenate([[0], np.cumsum([g[2] for g in got])[:-1]]).tolist()
    named = spark.createDataFrame([("x", "one"), ("a", "two words")], "k string, body string")
    assert rows_of(tf.file_round_trip(named, WORDS, words=True, id_col="k", text_col="body")) == expected([("a", "two words"), ("x", "one")])


def test_empty_table(spark):
    assert tf.file_round_trip(spark.createDataFrame([], "doc_id long, text string"), WORDS, words=True).collect() == []


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 50)
    e = tf.Encoder(Tokenizer.from_file(WORDS), True)
    t = Tokenizer.from_file(WORDS)
    for k in range(20):
        texts = [f"w{k} x{k * j} y{j} {'long' * 40}{j}" for j in range(30)]
        assert e.encode([x.encode() for x in texts]) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
        assert len(e.known) < 200 and len(e.known.old) < 200
