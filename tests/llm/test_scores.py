"""Toxicity and quality: exact neighbours, densities, held-out accuracy, odd inputs."""

import numpy as np
import pytest

from shopstrata.llm import quality_qda, toxicity
from shopstrata.llm.common import table

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, label int, score string, x string"
LABELS = "doc_id long, quality int, toxic int"


def accuracy(spark, scored, column):
    labels = table(spark, SF_DIR, "labels")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] == r[column] for r in rows) / len(rows)
    ones = [r["score"] for r in rows if r[column]]
    zeros = [r["score"] for r in rows if not r[column]]
    wins = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    return hit, wins


def test_nearest_are_exact():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        terms = np.sort(rng.choice(40, rng.integers(0, 6), replace=False))
        weights = rng.integers(1, 4, len(terms)).astype(float)
        vectors.append((terms, weights / max(1e-9, np.sqrt(weights @ weights))))
    index = toxicity.BlockMaxIndex(list(range(500)), vectors, 40, block=16)
    dense = np.zeros((500, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for q in range(100):
        cosines = np.round(dense @ dense[q], 9)
        cosines[q] = 0
        near, found = index.nearest(*vectors[q], 15, q)
        least = np.sort(cosines)[-15]
        expected = {i for i in range(500) if cosines[i] >= least and cosines[i] > 0}
        assert set(index.ids[near].tolist()) == expected
        assert np.allclose(found, cosines[index.ids[near]])


def test_calibration_rises():
    rng = np.random.default_rng(1)
    votes = rng.random(400)
    x, p = toxicity.calibrate(votes, (rng.random(400) < votes).astype(float))
    assert (np.diff(x) > 0).all() and (np.diff(p) >= -0.3).all()
    assert abs(np.interp(0.5, x, p) - 0.5) < 0.2 and 0 < p.min() and p.max() < 1


def test_densities():
    rng = np.random.default_rng(2)
    x = np.vstack((rng.normal(0, 1, (300, 4)), rng.normal(1, 2, (200, 4))))
    y = np.repeat([0.0, 1.0], (300, 200))
    model = quality_qda.fit(x, y)

    def density(p, k):
        s = np.linalg.inv(model.whiten[k])
        s = s @ s.T
        d = p - model.means[k]
        prior = (y == k).mean()
        return np.log(prior) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * d @ np.linalg.solve(s, d)

    plain = [density(p, 1) - density(p, 0) for p in x]
    assert np.allclose(model.difference(x), plain)
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.75


def test_held_out_toxicity(spark):
    docs = table(spark, SF_DIR, "documents")
    scored = toxicity.toxicity_scores(docs, table(spark, SF_DIR, "labels"))
    assert scored.count() == docs.count()
    hit, wins = accuracy(spark, scored, "toxic")
    assert hit > 0.9 and wins > 0.75


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_toxic_rows_are_found(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # Held-out rows; the last condition is that clean ones are left alone.
    rows = toxicity.toxicity_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    found = [r for r in rows if r["toxic"] == 1 and r["predicted"] == 1]
    assert len(found) >= 0.9 * sum(r["toxic"] == 1 for r in rows)
    assert sum(r["predicted"] == 1 for r in rows) - len(found) <= 0.05 * len(rows)


def test_scores_are_of_the_text_alone(spark):
    rows = [(i, f"fine words number {i % 20} here", None, "", "") for i in range(60)]
    rows += [(i, f"awful awful thing AWFUL {i % 9}!!!", None, "", "") for i in range(100, 160)]
    labels = spark.createDataFrame([(i, 0, int(i >= 100 and i % 3 > 0)) for i, *_ in rows], LABELS)
    # The same texts once more, without an id or with one that has no label.
    again = [(None if i % 2 else 1000 + i, text, *rest) for i, text, *rest in rows]
    docs = spark.createDataFrame(rows + again, SCHEMA).repartition(3)
    of = {}
    for r in toxicity.toxicity_scores(docs, labels).join(docs.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect():
        of.setdefault(r["text"], set()).add((r["score"], str(r["evidence"])))
    assert len(of) == 29 and all(len(found) == 1 for found in of.values())


def test_index_of_many_terms_is_exact():
    rng = np.random.default_rng(8)
    vectors = []
    for _ in range(300):
        terms = np.sort(rng.choice(20_000, 30, replace=False)) if rng.random() < 0.5 else np.sort(rng.choice(60, 30, replace=False))
        weights = rng.random(30)
        vectors.append((terms, weights / np.sqrt(weights @ weights)))
    index = toxicity.BlockMaxIndex(list(range(300)), vectors, 20_000, block=8)
    dense = np.zeros((300, 20_000))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for q in range(0, 300, 7):
        near, found = index.nearest(*vectors[q], 10)
        cosines = np.round(dense @ dense[q], 9)
        least = np.sort(cosines)[-10]
        assert set(index.ids[near].tolist()) == {i for i in range(300) if cosines[i] >= least and cosines[i] > 0}
        assert found[0] == pytest.approx(1.0)


def test_held_out_quality(spark):
    docs = table(spark, SF_DIR, "documents")
    scored = quality_qda.quality_scores(docs, table(spark, SF_DIR, "labels"))
    assert scored.count() == docs.count()
    hit, wins = accuracy(spark, scored, "quality")
    assert hit > 0.9 and wins > 0.9


@pytest.mark.parametrize("score,column", [(toxicity.toxicity_scores, "toxic"), (quality_qda.quality_scores, "quality")])
def test_odd_rows(spark, score, column):
    rows = [(i, f"fine words number {i} here", None, "", "") for i in range(60)]
    rows += [(i, f"awful awful thing AWFUL {i}!!!", None, "", "") for i in range(100, 160)]
    rows += [(None, None, 1, "", ""), (200, "", 1, "", ""), (201, "long " * 30000, 1, "", ""), (1, rows[1][1], 1, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    marks = [(i, int(i >= 100), int(i >= 100)) for i, *_ in rows[:120]] + [(None, 1, 1), (5, None, None), (5, 0, 0)]
    labels = spark.createDataFrame(marks, LABELS)
    found = score(docs, labels).collect()
    assert sorted((r["doc_id"] for r in found), key=str) == sorted((r[0] for r in rows), key=str)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    for r in found:
        if r["doc_id"] is not None and r["doc_id"] < 160:
            assert r["predicted"] == (r["doc_id"] >= 100)
    # Held-out labels are not looked at.
    modulus, rest = (4, 2) if column == "toxic" else (5, 0)
    flipped = labels.withColumn(column, __import__("pyspark").sql.functions.expr(
        f"if(crc32(cast(cast(doc_id as string) as binary)) % {modulus} = {rest}, 1 - {column}, {column})"))
    assert sorted(map(str, score(docs, flipped).collect())) == sorted(map(str, found))
    assert score(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in score(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in score(docs, labels.where(f"{column} = 1")).collect()} == {1}


@pytest.mark.parametrize("score,column", [(toxicity.toxicity_scores, "toxic"), (quality_qda.quality_scores, "quality")])
def test_repeated_ids_are_one_example(spark, monkeypatch, score, column):
    rows = [(i, f"fine words number {i} here" + " more" * (i % 7), None, "", "") for i in range(60)]
    rows += [(i, f"awful awful thing AWFUL {i}!!!" + " more" * (i % 5), None, "", "") for i in range(100, 160)]
    labels = spark.createDataFrame([(i, int(i >= 100), int(i >= 100)) for i, *_ in rows], LABELS)
    chosen = labels.where(f"crc32(cast(cast(doc_id as string) as binary)) % {4 if column == 'toxic' else 5} NOT IN (0, 2)")
    hot = min(r["doc_id"] for r in chosen.collect())
    repeated = [*rows, *[r for r in rows if r[0] == hot] * 300]
    fitted, counted = [], []
    fit, select = quality_qda.fit, toxicity.select_terms
    monkeypatch.setattr(quality_qda, "fit", lambda x, y: fitted.append(len(x)) or fit(x, y))
    monkeypatch.setattr(toxicity, "select_terms", lambda d, *a: counted.append(d.count()) or select(d, *a))
    for found in (rows, repeated):
        score(spark.createDataFrame(found, SCHEMA).repartition(3), labels).collect()
    first, second = fitted or counted
    assert first == second <= 120
