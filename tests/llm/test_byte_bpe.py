"""Byte-level BPE against the tiktoken library, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from tracelake.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = B.read_ranks(PATH)
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

HARD = [
    "", " ", "\n", "a", "  a", " \n a", "\t\ta b", "it's I'll we've they're I'd I'm don't 'sab ''s 'S ' s 'll'll x'", "don'tre '", "'s", " 's",
    "3.14 ²½ Ⅻ 12345", "\x1c\x1d\x1e\x1f \x85 \xa0a b​　c", "naïve Ünï ñ ß", "日本語 テキスト", "🙂🙂 👩‍👩‍👧", "<|endoftext|>",
    "a" * 3000, " " * 3000, "ab" * 1500 + "!" * 700, "\r\n\r\n x \r\n", "end  ", "end \n",
]


def random_texts(n=3000):
    rnd = random.Random(3)
    alphabet = list("  '\n\tabstrelvmd19.,!é²日🙂 \x85\x1c") + ["'s", "'ll", " the", "ing"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_pattern_is_the_published_one():
    assert B.PATTERN == public_tokenizers.PATTERN


def test_split_equals_the_pattern():
    for t in [*HARD, *random_texts()]:
        assert B.split_text(t) == regex.findall(B.PATTERN, t), repr(t)


def test_ids_equal_the_library():
    m = B.Merger(RANKS)
    for t in [*HARD, *random_texts(1500)]:
        ids = m.encode(t)
        assert ids == ORACLE.encode_ordinary(t), repr(t)
        assert m.decode(ids) == t.encode()


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 50)
    m = B.Merger(RANKS)
    for i in range(400):
        t = f"word{i} again{i % 7}"
        assert m.encode(t) == ORACLE.encode_ordinary(t)
        assert len(m.young) <= 60 and len(m.old) <= 60


def test_rank_file_without_all_bytes(tmp_path):
    (tmp_path / "r").write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        B.read_ranks(str(tmp_path / "r"))


def test_query_columns(spark):
    rows = [(1, "Hello  world's\n", 5), (None, None, 0), (2, "", 1), (2, "", 1), (3, "z" * 150_000 + " 日", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    full = {(r.doc_id, r.n_tokens): r for r in B.encode_decode(docs, PATH).collect()}
    got = B.token_digests(docs, PATH).collect()
    assert len(got) == 5
    for r in got:
        text = next(t or "" for i, t, _ in rows if i == r.doc_id)
        ids = ORACLE.encode_ordinary(text)
        assert r.n_tokens == len(ids) and full[r.doc_id, r.n_tokens].ids == ids
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert B.token_digests(docs.limit(0), PATH).count() == 0


def test_two_vocabularies_of_one_base_name(spark, tmp_path):
    import base64

    from tracelake.llm.token_counts import token_counts

    paths = []
    for folder, extra in (("a", []), ("b", [b"ab", b"abab"])):
        ranks = [bytes([b]) for b in range(256)] + extra
        (tmp_path / folder).mkdir()
        paths.append(tmp_path / folder / "own.tiktoken")
        paths[-1].write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(ranks)))
    docs = spark.createDataFrame([(1, "ababab")], "doc_id long, text string")
    for _ in range(2):
        assert [B.encode_decode(docs, str(p)).first().n_tokens for p in paths] == [6, 2]
        assert [token_counts(docs, str(p)).first().n_tokens for p in paths] == [6, 2]
