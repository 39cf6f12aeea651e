"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are words and their first three to six letters, and second and third occurrences are terms of
their own. Of these, the terms are kept whose occurrence in labelled examples depends on the label: by chi
squared as a share of the examples, a size of effect that means the same with few labels and many. Inverse document frequencies come from all documents. The examples, at most SAMPLE, are in an
inverted index in blocks that knows the largest weight of each term in each block: a block whose bound is
below the k-th best cosine so far is skipped, so the neighbours are exact. Neighbours vote with their
cosine, and votes become probabilities by the rate of ones among examples with such votes; there, and only
there, an example is left out of its own neighbours. A score depends on the text alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import row_key, stored
from shopstrata.llm.labelled import held_out, training_labels

# Most labelled examples in the index.
SAMPLE = 8192
# Least chi squared of a term, as a share of the examples, and in any case (a chance of one in twenty).
EFFECT = 1 / 75
CHI = 3.84
NEIGHBOURS = 15
PREFIXES = (3, 4, 5, 6)
REPEATS = 3
BLOCK = 64
MODULUS, REMAINDER = 4, 2
CUT = 0.3
# Words whose terms a task remembers.
MEMO = 200_000
WORDS = re.compile(r"\w+")


def base_terms(word: str) -> list[str]:
    """A word and its prefixes, marked with a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def term_set(text: str | None) -> set[tuple[str, int]]:
    """The terms of a text: (base, number of the occurrence up to REPEATS)."""
    counts: Counter = Counter()
    for word, n in Counter(WORDS.findall((text or "").lower())).items():
        for base in base_terms(word):
            counts[base] += n
    return {(b, k) for b, n in counts.items() for k in range(1, min(n, REPEATS) + 1)}


def select_terms(examples: DataFrame, effect: float = EFFECT, chi: float = CHI) -> list[tuple[str, int]]:
    """All terms of ``examples`` (text, label) whose chi squared is at least ``chi`` and ``effect`` times the examples.

    Terms are counted within a task first. Of rarer than three occurrences nothing can be said. The examples
    are a bounded sample, and so are the terms that reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list[int]] = {}

        def flush():
            rows = [(t, k, n, a) for (t, k), (n, a) in seen.items()]
            seen.clear()
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["term", "number", "n", "ones"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.column(1)[i].as_py()
                for term in term_set(batch.column(0)[i].as_py()):
                    count = seen.setdefault(term, [0, 0])
                    count[0] += 1
                    count[1] += one
                if len(seen) > 300_000:
                    yield flush()
        if seen:
            yield flush()

    total = examples.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    n, ones = total["n"], total["ones"] or 0
    if not 0 < ones < n:
        return []
    counted = (
        examples.select("text", "label").mapInArrow(run, "term string, number int, n long, ones long")
        .groupBy("term", "number").agg(F.sum("n").alias("n"), F.sum("ones").alias("a")).where("n >= 3")
    )
    table = (
        f"cast({n} as double) * pow(cast(a * {n} - n * {ones} as double), 2) / "
        f"(cast(n as double) * ({n} - n) * {ones} * {n - ones})"
    )
    strong = counted.withColumn("chi", F.when(F.col("n") < n, F.expr(table))).where(F.col("chi") >= max(chi, effect * n))
    return sorted((r["term"], r["number"]) for r in strong.select("term", "number").collect())


def with_terms(docs: DataFrame, terms: list[tuple[str, int]]) -> DataFrame:
    """(doc_id, _id, _hash, terms, weights) per row: the selected terms of a text, 1 + log of their counts."""
    place = {term: i for i, term in enumerate(terms)}
    bases = {b: [(k, place[b, k]) for k in range(1, REPEATS + 1) if (b, k) in place] for b, _ in terms}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found, weights = [], []
                for text in part.column(3):
                    counts: dict[str, int] = {}
                    for word in WORDS.findall((text.as_py() or "").lower()):
                        known = memo.get(word)
                        if known is None:
                            if len(memo) >= MEMO:
                                memo.clear()
                            known = memo[word] = tuple(b for b in base_terms(word) if b in bases)
                        for base in known:
                            counts[base] = counts.get(base, 0) + 1
                    pairs = sorted(
                        (i, 1 + np.log(n) if k == 1 else 1.0)
                        for b, n in counts.items() for k, i in bases[b] if n >= k
                    )
                    found.append([i for i, _ in pairs])
                    weights.append([w for _, w in pairs])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(found, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float64()))],
                    ["doc_id", "_id", "_hash", "terms", "weights"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), *row_key(), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, _id long, _hash long, terms array<int>, weights array<double>")


class BlockMaxIndex:
    """An inverted index of unit vectors in blocks, with the largest weight per term and block."""

    def __init__(self, ids: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = BLOCK):
        # Examples with the same strongest term are neighbours in the index, which keeps bounds tight.
        order = sorted(
            (i for i, (t, _) in enumerate(vectors) if len(t)),
            key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), ids[i]),
        )
        self.members = np.array(order, np.int64)
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.block = block
        blocks = -(-len(order) // block)
        self.blocks = blocks
        most: list[dict[int, float]] = [{} for _ in range(terms)]
        postings: list[list[tuple[int, float]]] = [[] for _ in range(terms)]
        for at, i in enumerate(order):
            for t, w in zip(*vectors[i]):
                postings[t].append((at, w))
                most[t][at // block] = max(most[t].get(at // block, 0.0), w)
        self.most = [(np.array(list(m), np.int64), np.array(list(m.values()))) for m in most]
        self.where = [np.array([p for p, _ in ps], np.int64) for ps in postings]
        self.weight = [np.array([w for _, w in ps]) for ps in postings]

    def _scores(self, terms: np.ndarray, weights: np.ndarray, alive: np.ndarray) -> np.ndarray:
        found = np.zeros(len(self.ids))
        for t, w in zip(terms, weights):
            where = self.where[t]
            use = alive[where // self.block]
            found[where[use]] += w * self.weight[t][use]
        return found

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int | None = None):
        """(members, cosines) of the ``k`` nearest and all that tie with the last of them.

        ``without`` leaves out the example with that id, for calibration.
        """
        bound = np.zeros(self.blocks)
        for t, w in zip(terms, weights):
            where, most = self.most[t]
            bound[where] += w * most
        if not bound.size or not bound.any():
            return np.empty(0, np.int64), np.empty(0)
        skip = np.flatnonzero(self.ids == without) if without is not None else []
        first = np.zeros(len(bound), bool)
        first[np.argsort(-bound, kind="stable")[: max(1, -(-2 * k // self.block))]] = True
        scores = self._scores(terms, weights, first)
        scores[skip] = 0.0
        least = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        rest = (bound >= least - 1e-9) & ~first & (bound > 0)
        if rest.any():
            scores += self._scores(terms, weights, rest)
            scores[skip] = 0.0
            least = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        near = np.flatnonzero((scores >= least - 1e-9) & (scores > 1e-12))
        near = near[np.lexsort((self.ids[near], -np.round(scores[near], 9)))]
        return near, np.minimum(scores[near], 1.0)


def calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps from votes to rates of ones: pooled adjacent violators, pulled a little to the mean."""
    rate = labels.mean()
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for v, y in zip(votes[order], labels[order]):
        pools.append([v, 1.0, y])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1] - 1e-12:
            v2, n2, y2 = pools.pop()
            v1, n1, y1 = pools.pop()
            pools.append([(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, y1 + y2])
    return np.array([p[0] for p in pools]), np.array([(p[2] + rate) / (p[1] + 1) for p in pools])


class Voters:
    """The index with its labels and the calibration; small enough to send to every task."""

    def __init__(self, ids, vectors, labels, idf: np.ndarray, k: int):
        self.idf, self.k = idf, k
        self.index = BlockMaxIndex(ids, [self.unit(*v) for v in vectors], len(idf))
        self.labels = np.array([labels[i] for i in self.index.members], float)
        own = [self.vote(v, ids[i])[0] for i, v in enumerate(vectors)]
        y = np.array(labels, float)
        silent = np.array([o is None for o in own], bool)
        rate = y.mean() if len(y) else 0.5
        self.silent = float((y[silent].sum() + rate) / (silent.sum() + 1))
        self.steps = None
        if (~silent).any():
            self.steps = calibrate(np.array([o for o in own if o is not None]), y[~silent])

    def unit(self, terms, weights) -> tuple[np.ndarray, np.ndarray]:
        terms = np.asarray(terms, np.int64)
        found = np.asarray(weights, float) * self.idf[terms] if len(terms) else np.empty(0)
        length = np.sqrt(found @ found)
        return terms, found / length if length else found

    def vote(self, vector, without: int | None = None):
        """(weighted share of ones among the neighbours or None, their places, their cosines)."""
        near, cosines = self.index.nearest(*self.unit(*vector), self.k, without)
        if not len(near):
            return None, near, cosines
        return float(cosines @ self.labels[near] / cosines.sum()), near, cosines

    def score(self, vote: float | None) -> float:
        return self.silent if vote is None or self.steps is None else float(np.interp(vote, *self.steps))


EVIDENCE = "array<struct<doc_id:bigint,label:int,cosine:double>>"


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    column: str = "toxic",
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    cut: float = CUT,
    sample: int = SAMPLE,
    k: int = NEIGHBOURS,
    effect: float = EFFECT,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, _id, _hash) per row of ``docs`` (doc_id, text).

    Labels of rows whose id has crc32 modulo ``modulus`` equal to ``remainder`` are not looked at. The index has at
    most ``sample`` labelled examples; every text is scored whole. ``evidence`` lists the first ``k`` neighbours; those
    that tie with the last one vote as well. Ids, and with them whether a document is an example, are no inputs: equal
    texts have equal scores, and an example is its own nearest one. Texts without a selected term, empty
    and null ones among them, have no neighbours and get the rate of ones among such examples. Without labels, or
    with one class only, there is no term and the score is the share of ones (0.5 without any). A null doc_id is not
    held out. Repeated rows are scored alike, an empty table gives an empty result. ``_id`` and ``_hash`` tell rows with
    equal ids and different texts apart.
    """
    chosen = stored(training_labels(labels, column, modulus, remainder, sample))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # At most ``sample`` ids are broadcast; of rows with one id, that with the smallest hash is the example.
    labelled = texts.join(F.broadcast(chosen), "doc_id").select("label", *row_key(), "text")
    once = stored(labelled.groupBy("_id", "label").agg(F.min_by("text", "_hash").alias("text")))
    terms = select_terms(once, effect)
    vectors = stored(with_terms(texts, terms))
    count = vectors.count()
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per selected term
    idf = np.ones(len(terms))
    for r in df:
        idf[r["term"]] = np.log(1 + count / r["count"])
    examples = (
        vectors.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.min(F.struct("_hash", "terms", "weights")).alias("row"))
        .select("doc_id", "label", "row.terms", "row.weights").orderBy("doc_id").collect()
    )
    voters = Voters(
        [r["doc_id"] for r in examples], [(r["terms"], r["weights"]) for r in examples],
        [r["label"] for r in examples], idf, k,
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("_id", pa.int64()), ("_hash", pa.int64()), ("score", pa.float64()),
         ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, label_of = voters.index.ids, voters.labels
        for batch in batches:
            scores, evidence = [], []
            for found, weights in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                vote, near, cosines = voters.vote((found, weights))
                scores.append(voters.score(vote))
                evidence.append(
                    [{"doc_id": int(ids_of[i]), "label": int(label_of[i]), "cosine": float(c)}
                     for i, c in zip(near[:k], cosines[:k])]
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(scores, pa.float64()), pa.array(evidence, schema.field("evidence").type)],
                schema=schema,
            )

    scored = vectors.repartition(F.xxhash64("doc_id", "terms")).mapInArrow(
        run, f"doc_id long, _id long, _hash long, score double, evidence {EVIDENCE}"
    )
    return scored.select(
        "doc_id",
        held_out(modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
        "evidence",
        "_id",
        "_hash",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted to be toxic."""
    toxic = stored(toxicity_scores(docs, labels, **options).where("predicted = 1").select("_id", "_hash").distinct())
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *row_key())
    return keyed.join(toxic, ["_id", "_hash"], "left_anti").select("_row.*")
