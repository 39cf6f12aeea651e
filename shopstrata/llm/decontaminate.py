"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Of each test item the rarer half of its word n-grams are seeds, rare being counted over all documents.
A seed that occurs in a document opens a window around the place where the item would lie, and the
item is aligned with the window. Words weigh by their rarity, substitutions and gaps cost, and the best
local alignment divided by the weight of the whole item is the score: 1 for an exact copy, less for an
edited or paraphrased one. The half is taken per item and not against a fixed count, so an item that leaked
into very many documents still has seeds.

Test items are held in memory in blocks of bounded size, and every document is read against each block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SEED_WORDS = 2
LEAST_SCORE = 0.5
# Costs of a substitution and of a gap, in mean weights of the item's words.
MISMATCH = 0.5
GAP = 0.4
# Characters of test items that a task holds at once.
BLOCK_CHARS = 16_000_000
# Characters of documents that are looked up together.
CHUNK_CHARS = 1 << 18
WORDS = re.compile(r"\w+")
HITS = (
    "doc_id long, item_id long, score double, item_from int, item_to int, doc_from int, doc_to int, seeds int"
)


def align(item: np.ndarray, weights: np.ndarray, window: np.ndarray) -> tuple[float, int, int, int, int]:
    """Best local alignment: (score, item from, item to, window from, window to), ends exclusive.

    Row by row over the item; gaps along a row are a running maximum, so a row is a few array operations.
    """
    mean = weights.mean()
    gap, mismatch = GAP * mean, MISMATCH * mean
    width = len(window)
    slope = gap * np.arange(width + 1)
    rows = np.zeros((len(item) + 1, width + 1))
    for i in range(len(item)):
        hit = np.where(window == item[i], weights[i], -mismatch)
        row = np.zeros(width + 1)
        np.maximum(rows[i, :-1] + hit, rows[i, 1:] - gap, out=row[1:])
        np.maximum(row, 0.0, out=row)
        rows[i + 1] = np.maximum.accumulate(row + slope) - slope
    i, j = np.unravel_index(np.argmax(rows), rows.shape)
    best, end_i, end_j = float(rows[i, j]), int(i), int(j)
    while i and j and rows[i, j] > 1e-9:
        hit = weights[i - 1] if window[j - 1] == item[i - 1] else -mismatch
        if abs(rows[i, j] - rows[i - 1, j - 1] - hit) < 1e-9:
            i, j = i - 1, j - 1
        elif abs(rows[i, j] - rows[i - 1, j] + gap) < 1e-9:
            i -= 1
        else:
            j -= 1
    return best / float(weights.sum()), int(i), end_i, int(j), end_j


class Items:
    """A block of test items as word numbers."""

    def __init__(self, items: list[tuple[int | None, str]], n: int):
        self.n = n
        self.ids, texts = [], []
        for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
            words = WORDS.findall(text.lower())
            if words:
                self.ids.append(item_id)
                texts.append(words)
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.words = [np.array([self.vocabulary[w] for w in t], np.int64) for t in texts]
        grams = [self.grams(w) for w in self.words]
        self.known = np.unique(np.concatenate(grams)) if grams else np.empty(0, np.int64)
        self.at = [np.searchsorted(self.known, g) for g in grams]

    def grams(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the n-grams of known words; -1 where a word is unknown. Shorter texts are one gram."""
        n, size = min(self.n, len(words)), len(self.vocabulary) + 1
        code = np.zeros(max(0, len(words) - n + 1), np.int64)
        for k in range(n):
            part = words[k : len(words) - n + 1 + k]
            code = np.where((code < 0) | (part < 0), -1, code * size + part + 1)
        return code

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of texts one after the other with -1 behind each, and each one's start and length."""
        words = [WORDS.findall((t or "").lower()) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        flat = chain.from_iterable(chain(w, ("",)) for w in words)
        found = np.fromiter(map(self.vocabulary.get, flat, repeat(-1)), np.int64, int(sizes.sum()) + len(words))
        return found, np.cumsum(sizes + 1) - sizes - 1, sizes

    def found(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in the text, number of the gram) of all known grams of a text."""
        if not len(words) or not len(self.known):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        codes = [self.grams(words)]
        if self.n > 1:
            # Items shorter than n words have grams of fewer words.
            codes = [Items.grams(_Length(self, k), words) for k in sorted({min(self.n, len(w)) for w in self.words})]
        where, what = [], []
        for code in codes:
            at = np.flatnonzero(code >= 0)
            spot = np.searchsorted(self.known, code[at])
            spot[spot == len(self.known)] = 0
            same = self.known[spot] == code[at]
            where.append(at[same])
            what.append(spot[same])
        return np.concatenate(where), np.concatenate(what)


def chunks(texts: list[str | None], most: int = CHUNK_CHARS) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``most`` characters together."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text or "")
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


class _Length:
    """Items with another length of grams."""

    def __init__(self, items: Items, n: int):
        self.n, self.vocabulary = n, items.vocabulary


def frequencies(docs: DataFrame, items: Items) -> tuple[int, np.ndarray, np.ndarray]:
    """Documents, and in how many of them each word and gram of the items occurs.

    Tasks add up over their rows; a task sends at most as many rows as there are words and grams.
    """
    words, grams = len(items.vocabulary), len(items.known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + words + grams, np.int64)
        for batch in batches:
            total[0] += batch.num_rows
            for texts in chunks(batch.column(0).to_pylist()):
                numbers, starts, _ = items.numbers(texts)
                known = np.flatnonzero(numbers >= 0)
                where, what = items.found(numbers)
                for first, at, kind, size in ((1, known, numbers[known], words), (1 + words, where, what, grams)):
                    # Once per text, however often it occurs there.
                    pairs = np.unique((np.searchsorted(starts, at, side="right") - 1) * size + kind)
                    total[first : first + size] += np.bincount(pairs % size, minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    total = np.zeros(1 + words + grams, np.int64)
    for r in counted.collect():  # bounded by the size of a block of items
        total[r["at"]] = r["n"]
    return int(total[0]), total[1 : 1 + words], total[1 + words :]


class Matcher:
    """Seeds and weights of a block of items, ready to read documents."""

    def __init__(self, items: Items, documents: int, words: np.ndarray, grams: np.ndarray, least: float):
        self.items, self.least = items, least
        self.weights = [np.log(1 + documents / np.maximum(words[w], 1)) for w in items.words]
        of: dict[int, list[tuple[int, int]]] = {}
        for k, at in enumerate(items.at):
            order = np.lexsort((np.arange(len(at)), grams[at]))
            for p in order[: -(-len(at) // 2)]:
                of.setdefault(int(at[p]), []).append((k, int(p)))
        self.seeds = of
        self.is_seed = np.zeros(len(items.known), bool)
        self.is_seed[list(of)] = True

    def hits(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text (item, score, item from, item to, word from, word to, seeds) of each item found in it."""
        numbers, starts, sizes = self.items.numbers(texts)
        where, what = self.items.found(numbers)
        use = self.is_seed[what]
        where, what = where[use], what[use]
        of: dict[int, list[tuple[int, int]]] = {}
        for text, at, gram in zip((np.searchsorted(starts, where, side="right") - 1).tolist(), where.tolist(), what.tolist()):
            of.setdefault(text, []).append((at - int(starts[text]), gram))
        return [
            self._aligned(numbers[starts[i] : starts[i] + sizes[i]], of[i]) if i in of else [] for i in range(len(texts))
        ]

    def _aligned(self, words: np.ndarray, seeds: list[tuple[int, int]]) -> list[tuple]:
        spots: dict[int, list[int]] = {}
        for at, gram in seeds:
            for item, place in self.seeds[gram]:
                spots.setdefault(item, []).append(at - place)
        out = []
        for item, starts in spots.items():
            own, weights = self.items.words[item], self.weights[item]
            slack = len(own) // 2 + 2
            best = None
            starts.sort()
            at = 0
            while at < len(starts):
                # Seeds of about the same shift belong to one window; windows stay short in long texts.
                last = at
                while last + 1 < len(starts) and starts[last + 1] - starts[last] <= slack and (
                    starts[last + 1] - starts[at] <= 8 * len(own)
                ):
                    last += 1
                low = max(0, starts[at] - slack)
                high = min(len(words), starts[last] + len(own) + slack)
                score, i0, i1, j0, j1 = align(own, weights, words[low:high])
                if best is None or score > best[0]:
                    best = (score, i0, i1, low + j0, low + j1, len(starts))
                at = last + 1
            if best and best[0] >= self.least - 1e-9:
                out.append((item, *best))
        return sorted(out)


def matchers(
    docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS, least: float = LEAST_SCORE,
    block_chars: int = BLOCK_CHARS,
) -> Iterator[Matcher]:
    """A matcher for each block of items; blocks are dealt by hash so that each has about ``block_chars``."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.char_length("text")).alias("n")).first()["n"] or 0
    blocks = -(-size // block_chars)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct()
        block = Items([tuple(r) for r in part.collect()], seed_words)
        if block.ids:
            yield Matcher(block, *frequencies(docs, block), least)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and test item found in it.

    (doc_id, item_id, score, item_from, item_to, doc_from, doc_to, seeds): the alignment's words of the item
    and of the document, ends exclusive, and the number of seeds that led to it; the best one where an item
    occurs more than once. Null or empty texts and items match nothing; a null doc_id or item_id is carried;
    repeated rows are reported as often as they occur, repeated items once. Empty tables give an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for matcher in matchers(docs, benchmark, **options):

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                ids = iter(batch.column(0).to_pylist())
                for texts in chunks(batch.column(1).to_pylist()):
                    for doc_id, hits in zip(islice(ids, len(texts)), matcher.hits(texts)):
                        found += [(doc_id, matcher.items.ids[item], *hit) for item, *hit in hits]
                if found:
                    kinds = [pa.int64()] * 2 + [pa.float64()] + [pa.int32()] * 5
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                        ["doc_id", "item_id", "score", "item_from", "item_to", "doc_from", "doc_to", "seeds"],
                    )

        hits = rows.mapInArrow(run, HITS)
        out = hits if out is None else out.unionByName(hits)
    return docs.sparkSession.createDataFrame([], HITS) if out is None else out


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no test item is found."""
    schema, place = docs.schema, docs.columns.index("text")
    for matcher in matchers(docs, benchmark, **options):

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = chunks(batch.column(place).to_pylist())
                yield batch.filter(pa.array([not hits for texts in parts for hits in matcher.hits(texts)], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
