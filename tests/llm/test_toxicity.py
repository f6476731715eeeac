import math
import random
import re

import numpy as np

from tableflow.llm.toxicity import (
    MARKED,
    NEIGHBOURS,
    BlockMaxIndex,
    choose_examples,
    fit,
    isotonic,
    op6_toxicity,
    score_toxicity,
    unit_rows,
)


def test_neighbours_are_exact():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.15, (700, 30)).astype(float)
    vectors = unit_rows(counts[counts.any(1)], np.linspace(1, 3, 30))
    queries = unit_rows(rng.poisson(0.2, (80, 30)).astype(float), np.linspace(1, 3, 30))
    index = BlockMaxIndex(vectors)
    for k in (1, 5, 25):
        found, cosines = index.nearest(queries, k)
        every = np.round(queries @ vectors.T, 12)
        for row in range(len(queries)):
            best = [w for w in np.argsort(-every[row], kind="stable")[:k] if every[row, w] > 0]
            assert found[row, : len(best)].tolist() == best and (found[row, len(best) :] == -1).all()
            assert np.allclose(cosines[row, : len(best)], every[row, best])
    found, _ = index.nearest(vectors, 3, np.arange(len(vectors)))
    assert not (found == np.arange(len(vectors))[:, None]).any()


def test_isotonic_is_monotone_and_keeps_the_mean():
    votes, labels = np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1])
    least, rate = isotonic(votes, labels)
    assert (np.diff(rate) > 0).all() and (np.diff(least) > 0).all()
    at = np.searchsorted(least, votes, "right") - 1
    assert np.isclose(rate[at].sum(), labels.sum())


def test_learns_words_and_their_beginnings(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        own = [f"w{rng.randrange(60)}" for _ in range(40)]
        if k % 5 == 0:
            own[3:3] = rng.choice(["idiot"] * 3 + [f"moro{rng.randrange(9)}"]).split()
        rows.append((k, " ".join(own)))
        labels.append((k, int(k % 5 == 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, "IDIOT!"), (902, "moroff w1")], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as row", "2 as score", "'x' as evidence")
    model = fit(docs, spark.createDataFrame([*labels, (0, 0), (None, 1), (5, None)], "doc_id long, toxic int"))
    out = score_toxicity(docs, model)
    assert out.select("row.*").columns == docs.columns
    got = out.select("row.doc_id", "row.text", "score", "predicted", "evidence").collect()
    assert len(got) == 404
    for row in got:
        toxic = "idiot" in (row["text"] or "").lower() or "moro" in (row["text"] or "")
        assert row["predicted"] == int(toxic) == int(row["score"] >= 0.5) and 0 <= row["score"] <= 1
        assert bool(row["evidence"]) == bool(row["text"])  # whatever has a word of an example
    again = score_toxicity(docs.repartition(7), model, ["doc_id"]).collect()
    assert sorted((r["row"]["doc_id"], r["score"]) for r in again) == sorted((r["doc_id"], r["score"]) for r in got)


def test_nothing_to_learn_from_and_empty_table(spark, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [r["score"] for r in score_toxicity(docs, fit(docs, none)).collect()] == [0.0]
    assert score_toxicity(no_docs, fit(no_docs, none)).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op6_toxicity(spark, sf_dir).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert counts[(1, 1)] / (counts[(1, 1)] + counts.get((1, 0), 0)) >= 0.9  # about 6 in 100 toxic texts have no mark
    assert counts.get((0, 1), 0) / (counts[(0, 0)] + counts.get((0, 1), 0)) <= 0.02


def test_neighbours_by_rare_and_common_terms_are_exact():
    rng = np.random.default_rng(2)
    rates = np.geomspace(0.004, 0.4, 300)
    counts = rng.poisson(rates, (900, 300)).astype(float)
    vectors = unit_rows(counts[counts.any(1)], np.linspace(6, 1, 300))
    queries = unit_rows(rng.poisson(rates, (300, 300)).astype(float), np.linspace(6, 1, 300))
    index = BlockMaxIndex(vectors)
    assert 0 < len(index.common) < 300
    every = np.round(queries @ vectors.T, 12)
    for k in (1, 3, 25):
        found, cosines = index.nearest(queries, k)
        for row in range(len(queries)):
            best = [w for w in np.argsort(-every[row], kind="stable")[:k] if every[row, w] > 0]
            assert found[row, : len(best)].tolist() == best and (found[row, len(best) :] == -1).all()
            assert np.allclose(cosines[row, : len(best)], every[row, best])


def test_texts_without_a_mark_have_neighbours_and_a_score(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(400):
        one, two = rng.choice("ab"), rng.choice("xy")
        rows.append((k, " ".join(f"{kind}{n}" for kind in (one, two) for n in rng.sample(range(10), 8))))
        labels.append((k, int((one, two) in (("a", "x"), ("b", "y")))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([l for l in labels if l[0] >= 100], "doc_id long, toxic int"))
    assert not len(model.marks)
    got = {r["row"]["doc_id"]: r for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    for doc_id, toxic in labels[:100]:
        assert got[doc_id]["predicted"] == toxic and len(got[doc_id]["evidence"]) == 3


def test_scores_are_those_of_brute_force(spark):
    """Cosines, votes, calibration and scores computed with dictionaries, from the marks that were chosen."""
    rng = random.Random(6)
    rows = []
    for k in range(300):
        own = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randrange(0, 40))]
        if k % 4 == 0:
            own.insert(0, rng.choice(["vile", "vilest", "rotten", "fine"]))
        rows.append((k, " ".join(own)))
    labels = [(k, int(k % 4 == 0 and not rows[k][1].startswith("fine"))) for k in range(220)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["row"]["doc_id"]: r for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    # terms: words; and marks, told by the hashes that the model holds
    words = {k: re.findall("[a-z0-9]+", text) for k, text in rows}
    assert len(model.marks) and MARKED > 0
    from tableflow.llm.toxicity import candidates
    from tableflow.llm.words import pieces
    import pyarrow as pa

    marks = set(model.marks.tolist())

    def terms(k):
        _, _, data, offsets = next(pieces(pa.array([rows[k][1]])))
        _, hashes, plain = candidates(data, offsets)
        counts = {}
        for at, h in enumerate(hashes.tolist()):
            if at < plain:
                counts[("word", h)] = counts.get(("word", h), 0) + 1
            if h in marks:
                counts[("mark", h)] = counts.get(("mark", h), 0) + 1
        return counts

    counts = {k: terms(k) for k, _ in rows}
    seen = {}
    for k, _ in rows:
        for term in counts[k]:
            seen[term] = seen.get(term, 0) + 1
    first = {}
    for k, text in rows[:220]:
        first.setdefault(text, k)
    examples = sorted(first.values())
    known = {term for k in examples for term in counts[k]}
    idf = {term: math.log((1 + len(rows)) / (1 + seen[term])) + 1 for term in known}

    def vector(k):
        parts = {}
        for kind, share in (("word", 1 - MARKED), ("mark", MARKED)):
            part = {t: (1 + math.log(c)) * idf[t] for t, c in counts[k].items() if t in known and t[0] == kind}
            length = math.sqrt(sum(w * w for w in part.values()))
            parts |= {t: w / length * math.sqrt(share) for t, w in part.items()}
        length = math.sqrt(sum(w * w for w in parts.values()))
        return {t: w / length for t, w in parts.items()}

    vectors = {k: vector(k) for k, _ in rows}
    label = dict(labels)

    def vote(k, without=None):
        cosines = [
            (round(sum(w * vectors[e].get(t, 0) for t, w in vectors[k].items()), 9), label[e], e)
            for e in examples if e != without and vectors[e]
        ]
        best = sorted((c for c in cosines if c[0] > 0), key=lambda c: -c[0])[:NEIGHBOURS]
        return (sum(c * y for c, y, _ in best) / sum(c for c, _, _ in best), best) if best else (None, [])

    filled = [e for e in examples if vectors[e]]
    votes = [(round(vote(e, e)[0] or 0, 9), label[e]) for e in filled]
    least, rate = isotonic(np.array([v for v, _ in votes]), np.array([y for _, y in votes]))
    bare = [label[e] for e in examples if not vectors[e]]
    near = 0
    for k, _ in rows:
        own, best = vote(k)
        if own is None:
            assert math.isclose(got[k]["score"], sum(bare) / len(bare) if bare else sum(label[e] for e in examples) / len(examples))
            continue
        want = rate[max(int(np.searchsorted(least, round(own, 9), "right")) - 1, 0)]
        near += abs(got[k]["score"] - want) < 0.02
        assert np.allclose([e["cosine"] for e in got[k]["evidence"]], [c for c, _, _ in best[:3]], atol=1e-6)
    assert near >= 0.98 * sum(1 for k, _ in rows if vectors[k])  # ties of cosines may part at the last neighbour


def test_equal_rows_are_one_example(spark):
    rows = spark.range(20_000).selectExpr("1 as doc_id", "'the same vile text' as text")
    more = spark.createDataFrame([(2, "another text"), (3, "the same vile text"), (1, "with another text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    chosen, names = choose_examples(rows.unionByName(more), labels, 100, 1 << 20)
    assert chosen.count() == len(names) == 3
    assert sorted(names.column("toxic").to_pylist()) == [0, 1, 1]
    assert choose_examples(more, labels, 100, 20)[1].num_rows == 1  # those that fit
    assert choose_examples(more, labels, 2, 1 << 20)[1].num_rows == 2
    out = score_toxicity(rows.unionByName(more), fit(rows.unionByName(more), labels)).groupBy("row.text").count().collect()
    assert sorted(row["count"] for row in out) == [1, 1, 20_001]


def test_a_very_long_text(spark):
    rows = [(k, f"w{k % 7} " + ("vile" if k % 3 == 0 else "fine")) for k in range(60)] + [(99, "some more words " * 200_000 + "vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int"))
    got = {r["row"]["doc_id"]: r["predicted"] for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    assert got[99] == 1 and got[1] == 0
