"""Quality classifier: features, steps, held-out accuracy, edges."""

import zlib

import numpy as np
import pyarrow.parquet as pq

from kinestream.llm import classifier, queries

SF = "/root/testdata/sf0.01"


def test_features_are_counts_of_words_and_pairs():
    at, value = classifier.features("b a b, a b")
    words = {w: np.uint64(zlib.crc32(w.encode())) for w in "ab,"}
    with np.errstate(over="ignore"):
        one = {w: int(h * classifier._MIX >> np.uint64(64 - classifier.BITS)) for w, h in words.items()}
        two = {p: int((words[p[0]] * classifier._MIX + words[p[1]]) * classifier._MIX >> np.uint64(64 - classifier.BITS)) for p in ("ba", "ab", "b,", ",a")}
    want = {one["a"]: 2, one["b"]: 3, one[","]: 1, two["ba"]: 1, two["ab"]: 2, two["b,"]: 1, two[",a"]: 1}
    assert dict(zip(at.tolist(), (value * np.sqrt(sum(n * n for n in want.values()))).round(9).tolist(), strict=True)) == want
    assert at.tolist() == sorted(at.tolist()) and classifier.features("x x x")[0].tolist()[0] == 0
    for blank in (None, "", " \n\t"):
        assert not len(classifier.features(blank)[0])


def test_word_hashes_are_bounded():
    for i in range(3):
        classifier.features(" ".join(f"{i}x{j}" for j in range(70_000)) + " " + "y" * 100_000)
    assert len(classifier._hashes) <= classifier.CACHED_WORDS and max(map(len, classifier._hashes)) <= classifier.CACHED_CHARS


def test_one_step_is_the_proximal_minimum():
    """After one row each weight is the minimum of g*w + lasso*|w| + (ridge + (smooth + |g|) / rate) * w*w / 2."""
    x = (np.array([3, 9]), np.array([0.6, 0.8]))
    got = classifier.fit([x], np.array([1.0]), np.array([1.0]), rounds=1, rate=0.5, smooth=1.0, lasso=0.1, ridge=0.3)
    for at, v, lasso in ((3, 0.6, 0.1), (9, 0.8, 0.1), (None, 1.0, 0.0)):
        g = -0.5 * v
        grid = np.linspace(-1, 1, 400_001)
        best = grid[np.argmin(g * grid + lasso * np.abs(grid) + (0.3 + (1 + abs(g)) / 0.5) * grid**2 / 2)]
        assert abs((got.bias if at is None else got.weights[at]) - best) < 1e-5
    assert np.count_nonzero(got.weights) == 2


def test_held_out_documents(spark):
    quality = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = queries.op12_quality_classifier(spark, SF).collect()
    assert len(rows) == pq.read_table(f"{SF}/documents.parquet").num_rows
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    apart = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert len(apart) > 50 and np.mean([p == q for p, q in apart]) >= 0.95 and all(p for p, q in apart if q)


def test_labels_of_held_out_rows_are_not_learned(spark):
    """Turning every held-out label round changes no score."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = "crc32(cast(doc_id as string)) % 5 = 0"
    turned = labels.selectExpr("doc_id", f"if({held}, 1 - quality, quality) as quality")
    a, b = classifier.train(docs, labels), classifier.train(docs, turned)
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_edges(spark):
    """Null ids and texts, both labels, one label, no labels, no rows, repeated rows, clashing columns."""
    docs = spark.createDataFrame([(1, "good words here", 0.5), (2, "BAD!! BAD!!", 0.1), (None, None, 0.2), (4, "", 0.3), (1, "good words here", 0.5), (6, "x " * 300_000, 0.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    both = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0)], "doc_id long, quality int")
    got = classifier.score(docs, classifier.train(docs, none)).collect()
    assert len(got) == 6 and {r.score for r in got} == {0.5} and [r.doc_id for r in got].count(None) == 1
    assert all(0 <= r.score <= 1 and r.held_out is not None for model in (one, both) for r in classifier.score(docs, classifier.train(docs, model)).collect())
    assert len({r.score for r in classifier.score(docs, classifier.train(docs, both)).collect() if r.doc_id == 1}) == 1
    assert classifier.score(docs.limit(0), classifier.train(docs, both)).count() == 0
