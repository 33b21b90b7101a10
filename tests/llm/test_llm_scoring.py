"""Trees and subsequence kernels: against plain versions and held-out labels."""

import itertools
import random

import duckdb
import numpy as np
import plain
import pytest

from trackmill.llm import quality, toxicity


def plain_kernel(s, t, decay):
    def features(word):
        found = {}
        for places in itertools.combinations(range(len(word)), 3):
            run = "".join(word[i] for i in places)
            found[run] = found.get(run, 0) + decay ** (places[2] - places[0] + 1)
        return found

    a, b = features(s), features(t)
    return sum(v * b.get(k, 0) for k, v in a.items())


def test_kernel_counts_gapped_runs():
    words, landmarks = ["idiot", "id1iot", "i.d.i.o.t", "banana", "ab", "", "日本語日本"], ["idiot", "nanan", "日本語"]
    expected = [[plain_kernel(w, m, 0.6) for m in landmarks] for w in words]
    np.testing.assert_allclose(toxicity.kernel(words, landmarks), expected, atol=1e-6)
    near = toxicity.similarities(["idiot", "id1iot", "xx" * 40 + "idiot" + "y" * 30, "table"], ["idiot"])[:, 0]
    assert near[0] == near[2] == 1 and 0.5 < near[1] < 1 and near[3] == 0


def toxic_texts(n=400):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        words = [f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.choice('nrst')}{rng.randrange(30)}" for _ in range(40)]
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words[rng.randrange(40)] = rng.choice(["blockhead", "numbskull", "nitwit"])
        rows.append((i, " ".join(words), toxic))
    return rows


def test_machine_learns_and_tolerates_inserted_characters():
    rows = toxic_texts()
    machine = toxicity.train([set(t.split()) for _, t, _ in rows], np.array([float(y) for *_, y in rows]))
    tests = ["ban1 bos2 numbskull nitwit", "ban1 num-bskull blo.ckhead", "ban1 bos2 fir3", "", "kan7 " * 5000]
    scores = machine.score(toxicity.Describer(machine.landmarks).describe([t.encode() for t in tests]))
    assert (scores[:2] > 0.5).all() and (scores[2:] < 0.3).all()


def test_five_letter_insults_with_gaps_count():
    rng = random.Random(2)
    texts = []
    for i in range(400):
        words = {f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.choice('nrst')}{rng.randrange(30)}" for _ in range(40)}
        texts.append(words | set(rng.sample(["idiot", "trash", "moron"], 2) if i % 5 == 0 else []))
    machine = toxicity.train(texts, np.array([float(i % 5 == 0) for i in range(400)]))
    describer = toxicity.Describer(machine.landmarks)
    spoiled = {
        "one gap": lambda w: w[:2] + "." + w[2:],
        "one inserted": lambda w: w[:2] + "1" + w[2:],
        "all gaps": ".".join,
        "missing": lambda w: w[:2] + w[3:],
        "masked": lambda w: w[:2] + "*" + w[3:],
    }
    insults = ["idiot", "trash", "moron"]
    texts = ["ban1 bos2 " + " ".join(map(spoil, insults)) for spoil in spoiled.values()]
    scores = dict(zip(spoiled, machine.score(describer.describe([t.encode() for t in texts]))))
    clean = machine.score(describer.describe([b"ban1 bos2 fir3 the riot and the idol"]))[0]
    assert clean < toxicity.THRESHOLD
    assert min(scores["one gap"], scores["one inserted"], scores["all gaps"]) >= toxicity.THRESHOLD
    # three runs of five letters lost: more than a clean text, below the threshold (see the README)
    assert min(scores["missing"], scores["masked"]) > 2 * clean


def test_machine_without_both_kinds_scores_the_share():
    assert toxicity.train([], np.zeros(0)).score(np.zeros((2, 0))).tolist() == [0.5, 0.5]
    assert toxicity.train([{"a"}], np.ones(1)).score(np.zeros((1, 0)))[0] == pytest.approx(0.999)


def plain_score(forest, row):
    total = forest.base
    for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_trees_fit_and_are_walked_alike():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5)).round(1)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] < -0.2)).astype(float)
    forest = quality.grow(x, y, trees=40)
    scores = forest.score(x)
    assert ((scores > 0.5) == y).mean() > 0.97
    np.testing.assert_allclose(scores[:50], [plain_score(forest, r) for r in x[:50]])


def test_trees_without_labels():
    assert quality.grow(np.zeros((0, 22)), np.zeros(0)).score(np.zeros((2, 22))).tolist() == [0.5, 0.5]
    assert quality.grow(np.zeros((3, 22)), np.ones(3)).score(np.zeros((1, 22)))[0] == pytest.approx(0.999)


def test_statistics_of_odd_texts():
    for text in [None, "", " ", "\n", "x", "a b", "é" * 100_000, "{}[]<>!!||"]:
        values = quality.statistics(text)
        assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()


def labels_of(spark, rows, name):
    other = "toxic" if name == "quality" else "quality"
    return spark.createDataFrame([(i, y, None) for i, y in rows], f"doc_id long, {name} int, {other} int")


@pytest.mark.parametrize("module, name", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_all_rows(spark, module, name):
    docs, rows = plain.documents(spark)
    marked = [(i, int((t or "").count("w") > 40)) for i, t in rows if i is not None]
    marked += [(rows[0][0], 1 - marked[0][1]), (None, 1), (rows[1][0], None), (10**6, 1)]
    found = module.score(docs, module.fit(docs, labels_of(spark, marked, name))).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    texts = {}
    for r, t in ((r, t) for r in found for i, t in rows if i == r.doc_id):
        texts.setdefault(t, set()).add(r.score)
    assert all(len(s) == 1 for s in texts.values())
    nothing = module.fit(plain.empty(spark), labels_of(spark, [], name))
    assert {r.score for r in module.score(docs, nothing).collect()} == {0.5}
    assert module.score(plain.empty(spark), nothing).count() == 0


def test_held_out_rows_follow_the_checksum(spark):
    import zlib

    docs, rows = plain.documents(spark)
    for module, modulus, rest in ((quality, 5, 0), (toxicity, 4, 2)):
        model = module.fit(plain.empty(spark), labels_of(spark, [], "quality" if modulus == 5 else "toxic"))
        for r in module.score(docs, model).collect():
            if r.doc_id is not None:
                assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)


@pytest.mark.parametrize("query, label, floor", [(quality.op9_quality, "quality", 0.95), (toxicity.op6_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, small, query, label, floor):
    folder = small.replace("sf0.001", "sf0.1")
    scored = query(spark, folder).filter("held_out").toPandas()  # noqa: F841
    right = duckdb.sql(
        f"select avg((predicted = {label})::int) from scored join '{folder}/labels.parquet' using (doc_id) where {label} is not null"
    ).fetchall()[0][0]
    assert right >= floor
