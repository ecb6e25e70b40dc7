"""Quality classifier: inference against enumeration, gradient of the fit, held-out accuracy, edge rows."""

import itertools
import zlib

import numpy as np

from tracelake.llm import quality_crf as Q

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(1)
    first = np.array([0, 1, 5, 7, 13])
    emit, trans = rnd.normal(size=13), rnd.normal(size=(2, 2))
    good, sums, log_z = Q.Crf(np.zeros(1), trans).marginals(emit, first, pairs=True)
    want, pair, total = np.zeros(13), np.zeros((2, 2)), 0.0
    for a, b in itertools.pairwise(first):
        paths = list(itertools.product((0, 1), repeat=b - a))
        score = np.array([sum(emit[a + i] * y for i, y in enumerate(p)) + sum(trans[x, y] for x, y in itertools.pairwise(p)) for p in paths])
        prob = np.exp(score) / np.exp(score).sum()
        total += np.log(np.exp(score).sum())
        for p, w in zip(paths, prob, strict=True):
            want[a:b] += w * np.array(p)
            for x, y in itertools.pairwise(p):
                pair[x, y] += w
    assert np.allclose(good, want) and np.allclose(sums, pair) and np.isclose(log_z, total)


def test_features_do_not_depend_on_the_batch():
    texts = [b"", b"\n\n", "Ä b\nÄ b\nC!! D##".encode(), b"x " * 5000, b"one"]
    whole = Q.line_features(texts)
    for i, t in enumerate(texts):
        alone = Q.line_features([t])
        assert np.array_equal(alone.x, whole.x[whole.first[i] : whole.first[i + 1]])
        assert len(alone.x) == t.count(b"\n") + 1


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fold = Q.held_out()
    out = Q.quality(docs, Q.train(docs.where(~fold), labels.where(~fold)))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == docs.count()
    marks = [(got[r.doc_id], r.quality) for r in labels.collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r, _ in marks)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(r.score, q) for r, q in marks if r.held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    auc = np.mean([[g > b for b in bad] for g in good])
    assert auc > 0.98 and np.mean([g >= 0.3 for g in good]) > 0.98


def test_edge_rows_and_labels(spark):
    rows = [(1, None, 0.5), (1, None, 0.5), (None, "Some text.\nMore.", 0.1), (3, "", 0.2), (4, "A!! " * 60_000, 0.3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (3, None), (9, 0)], "doc_id bigint, quality int")
    for labels in (none, one):
        model = Q.train(docs, labels)
        out = Q.quality(docs, model).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
        kept = Q.keep_good(docs, model)
        assert kept.columns == docs.columns and kept.count() == 5
    assert Q.quality(docs.limit(0), model).count() == 0


def test_long_documents_are_learned_from_and_the_sample_is_bounded(spark):
    good = "\n".join(f"This is a plain sentence, number {i}, and it ends here." for i in range(3000))
    bad = "\n".join(f"$$$ BUY NOW!!! {i} ### CLICK!!!" for i in range(3000))
    docs = spark.createDataFrame([(i, (good, bad)[i % 2]) for i in range(6)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(6)], "doc_id bigint, quality int")
    scores = {r.doc_id: r.score for r in Q.quality(docs, Q.train(docs, labels)).collect()}
    assert all(scores[i] > 0.9 if i % 2 == 0 else scores[i] < 0.1 for i in range(6))
    spans = {Q.line_span(good.encode(), h, 250).count(b"\n") + 1 for h in range(-5000, 5000, 7)}
    assert spans == {250} and Q.line_span(b"a\nb", 3, 2) == b"a\nb"
    many = docs.limit(2).crossJoin(spark.range(3000)).select("doc_id", docs.text.substr(1, 300).alias("text"))
    Q.train(many, labels, sample_docs=10)  # rows of one id count, too


def test_scores_equal_a_plain_version(spark):
    """Forward-backward in plain Python over the model's own emissions, line by line."""
    texts = ["", "One line.", "A\n\nB!! $$\nThe third line, it has words.\n", "x\n" * 40]
    rng = np.random.default_rng(3)
    crf = Q.Crf(rng.normal(size=3 * Q.WIDTH + 3), rng.normal(size=(2, 2)))
    for text, got in zip(texts, Q.score_texts(crf, [t.encode() for t in texts]), strict=True):
        lines = Q.line_features([text.encode()])
        emit = Q.with_neighbours(lines) @ crf.weights
        n = len(emit)
        alpha, beta = [[0.0, emit[0]]], [[0.0, 0.0]]
        for i in range(1, n):
            alpha.append([np.logaddexp(*(alpha[-1][a] + crf.trans[a, b] for a in (0, 1))) + b * emit[i] for b in (0, 1)])
        for i in range(n - 1, 0, -1):
            beta.insert(0, [np.logaddexp(*(crf.trans[a, b] + b * emit[i] + beta[0][b] for b in (0, 1))) for a in (0, 1)])
        p = [np.exp(x[1] + y[1] - np.logaddexp(x[0] + y[0], x[1] + y[1])) for x, y in zip(alpha, beta, strict=True)]
        sizes = [len(line) for line in text.encode().split(b"\n")]
        weights = sizes if sum(sizes) else [1] * n
        assert np.isclose(got, np.average(p, weights=weights))
