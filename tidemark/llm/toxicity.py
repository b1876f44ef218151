"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Fitting takes a bounded sample of labelled rows as the examples: of each class, in the order of a hash of the id, up to
``MAX_EXAMPLES`` rows and ``MAX_POSTINGS`` different words in them. Every word of an example is indexed. A word weighs
(1 + ln tf) * idf * (dependence + ``LEAST``): document frequencies are counted over *all* documents, dependence is the
log-likelihood ratio between the word's presence in the examples and their label. No word is left out; without the last
factor the neighbours are those of the same subject, whatever their label. Words that no example holds can't match and
take no part in a text's length.

Every document is a query on an inverted index of the examples. Examples are cut into blocks of ``BLOCK_ROWS``, those
with the same strongest word together; the index keeps each word's largest weight, over all and in each block. Words are
read in the order of what they can add for each entry of their lists. Once the words left can add little, only the examples
that they can still lift to the k-th best sum are kept; if those are many, the block maxima of the words left bound every
block, and blocks below that sum are not opened. The few that remain get their whole cosine from their own words. The
result is the exact top k.
Documents come in slices. The longest lists, at most ``LONG_LISTS``, are held as rows of a matrix too; documents with much
to read in them get their sums over these lists from one matrix product a slice, and start from there. Words of a slice are
found and looked up together, each different word once.
Votes are weighted by nearness and turned into calibrated scores by isotonic regression on votes that leave each
example's own label out, weighted back to the class shares of all labelled rows. The neighbours are the evidence.

Index, vocabulary and calibration are bounded by the sample, so they travel to the tasks with the function.

Defined cases: null and empty texts, and texts without any word of the examples, have no neighbour and get the
calibrated share of toxic rows among such examples; ties in cosine go to the earlier example of the index (by strongest
word, then hash order); repeated rows are scored one by one; without any labelled row every score is 0; other columns
pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, release_memory, whole_text
from tidemark.session import cut_lineage

# Labelled rows of each class that may become examples.
MAX_EXAMPLES = 4000
# Different words of the examples of each class, added up over the examples.
MAX_POSTINGS = 2_000_000
# Added to a word's dependence on the label, so that words without any count as well.
LEAST = 0.01
NEIGHBOURS = 15
# Examples of one block of the index.
BLOCK_ROWS = 64
# So many examples are finished from their own words; with more the blocks are bounded, then the next words are read.
FINISHED = 32
# Words are read until those left can add this share of what all could; then this share of that, and so on.
LEFT = 0.01
# Lists that are held as rows of a matrix too, if an example in ``LONG_SHARE`` is in them.
LONG_LISTS = 512
LONG_SHARE = 16
# Entries of a matrix product that take as long as one entry of a list.
DENSE_SPEED = 256
# Above twice what sums of ``LONG_LISTS`` products in single precision can be wrong by.
SLACK = 1e-4
# Documents, and characters in them, whose words are looked up together; queries of one matrix product.
SLICE_ROWS = 1024
SLICE_CHARS = 1 << 19
QUERIES = 128

_WORD = re.compile(r"[^\W\d_]+")
_WORDS = _WORD.findall


# Latin-1 in lower case; bytes that no word holds are spaces.
_LATIN = bytes(ord(chr(b).lower()) if _WORDS(chr(b).lower()) else 32 for b in range(256))


class Terms:
    """Term numbers of texts."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        # By code point: whether words hold it. Worked out where a text needs it.
        self.letters: np.ndarray | None = None

    def __getstate__(self) -> tuple[str, np.ndarray]:
        # Words hold no line ends; one text takes far less memory to write and read than its words.
        return "\n".join(self.vocabulary), np.fromiter(self.vocabulary.values(), np.int64, len(self.vocabulary))

    def __setstate__(self, state: tuple[str, np.ndarray]) -> None:
        words, numbers = state
        self.__init__(dict(zip(words.split("\n"), numbers.tolist())))

    def of(self, text: str) -> Counter:
        _, terms, tf = self.of_all([text])
        return Counter(dict(zip(terms.tolist(), tf.tolist())))

    def of_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the text, number of the term and count of each known word, by text and term."""
        latin, wide = [], []
        for text in texts:
            try:
                latin.append(text.encode("latin-1").translate(_LATIN))
                wide.append(b"")
            except UnicodeEncodeError:
                latin.append(b"")
                wide.append(text.lower().encode("utf-32-le"))
        found = [self._known(np.frombuffer(b" ".join([*latin, b""]), np.uint8), latin, "latin-1")]
        if any(wide):
            found.append(self._known(np.frombuffer(b" \0\0\0".join([*wide, b""]), "<u4"), wide, "utf-32-le"))
        keys, tf = np.unique(np.concatenate(found), return_counts=True)
        return *np.divmod(keys, max(1, len(self.vocabulary))), tf

    def _known(self, units: np.ndarray, texts: list[bytes], encoding: str) -> np.ndarray:
        """Text and term, as one number, of each known word; ``units`` are the code points of all texts with a space
        behind each."""
        inside = units != 32 if encoding == "latin-1" else self._letters()[units]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts, sizes = edges[::2], np.diff(edges)[::2] * units.itemsize
        ends = np.append(0, np.cumsum(sizes)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(units[inside])])
        words = words.dictionary_encode()
        # Different words as one text, which is quicker than one by one.
        joined = pc.binary_join(
            pa.LargeListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int64()), words.dictionary),
            pa.scalar(" ".encode(encoding), pa.large_binary()),
        )[0].as_py()
        term_of = np.array([self.vocabulary.get(w, -1) for w in joined.decode(encoding).split()], dtype=np.int64)
        term = term_of[words.indices.to_numpy()]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) // units.itemsize + 1
        text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, np.append(0, np.cumsum(lengths)))))
        held = term >= 0
        return text[held] * max(1, len(self.vocabulary)) + term[held]

    def _letters(self) -> np.ndarray:
        if self.letters is None:
            self.letters = np.zeros(0x110000, dtype=bool)
            for found in _WORD.finditer("".join(map(chr, range(0x110000)))):
                self.letters[slice(*found.span())] = True
        return self.letters


def _slices(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch in pieces with their texts."""
    some, size, begin = [], 0, 0
    for i, text in enumerate(batch.column(text_at), 1):
        some.append(text.as_py() or "")
        size += len(some[-1])
        if len(some) == SLICE_ROWS or size >= SLICE_CHARS or i == batch.num_rows:
            yield batch.slice(begin, len(some)), some
            some, size, begin = [], 0, i


@dataclass
class Lists:
    """Numbered lists end to end: the numbers and weights of list i lie from starts[i] to starts[i + 1]."""

    starts: np.ndarray
    numbers: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, count: int, lists: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> Lists:
        order = np.lexsort((numbers, lists))
        starts = np.append(0, np.cumsum(np.bincount(lists, minlength=count)))
        # Numbers take as few bytes as they can.
        return cls(starts, numbers.astype(np.min_scalar_type(numbers.max(initial=0)))[order], weights[order])

    def sizes(self, chosen: np.ndarray) -> np.ndarray:
        return self.starts[chosen + 1] - self.starts[chosen]

    def places(self, chosen: np.ndarray) -> np.ndarray:
        """Where the entries of the chosen lists lie, list after list."""
        sizes = self.sizes(chosen)
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[chosen] - ends + sizes, sizes)

    def sums(self, chosen: np.ndarray, factors: np.ndarray, count: int) -> np.ndarray:
        """By number: the weights in the chosen lists, each times its list's factor."""
        at = self.places(chosen)
        return np.bincount(self.numbers[at], self.weights[at] * np.repeat(factors, self.sizes(chosen)), count)


@dataclass
class Model:
    terms: Terms
    # Weight of each term: idf times dependence.
    weights: np.ndarray
    # Examples by term; blocks by term with the largest weight in each; largest weight of all; terms by example.
    postings: Lists
    peaks: Lists
    tops: np.ndarray
    examples: Lists
    labels: np.ndarray
    mass: np.ndarray
    ids: list
    # Calibration: votes (ascending) and the score at each; score of a text without neighbours.
    votes: np.ndarray
    scores: np.ndarray
    empty_score: float
    # A query's weights by term while its cosines are worked out, zero otherwise.
    scratch: np.ndarray | None = None
    # Row of each term in the matrix of long lists, -1 for others, and the matrix: weights by list and example.
    long: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        # Tasks make their own.
        return self.__dict__ | {"scratch": None, "long": None}

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        terms = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        tf = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        return self.vectors(np.zeros(len(terms), dtype=np.int64), terms, tf, 1)[1:]

    def vectors(self, query: np.ndarray, terms: np.ndarray, tf: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, term and weight of each entry of ``count`` queries' vectors."""
        values = (1 + np.log(tf)) * self.weights[terms]
        length = np.sqrt(np.bincount(query, values * values, count))[query]
        held = length > 0
        return query[held], terms[held], values[held] / length[held]

    def _read_long(self, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> dict[int, np.ndarray]:
        """Sums over the long lists, for queries with so much in them that a matrix product is quicker."""
        n = len(self.labels)
        if self.long is None:
            sizes = np.diff(self.postings.starts)
            chosen = np.argsort(-sizes, kind="stable")[:LONG_LISTS]
            chosen = chosen[sizes[chosen] * LONG_SHARE >= n]
            place, matrix = np.full(len(sizes), -1), np.zeros((len(chosen), n), dtype=np.float32)
            place[chosen] = np.arange(len(chosen))
            at = self.postings.places(chosen)
            matrix[np.repeat(place[chosen], sizes[chosen]), self.postings.numbers[at]] = self.postings.weights[at]
            self.long = place, matrix
        place, matrix = self.long
        count = len(starts) - 1
        inside = place[terms] >= 0
        query, terms, weights = np.repeat(np.arange(count), np.diff(starts))[inside], terms[inside], weights[inside]
        entries = np.bincount(query, self.postings.sizes(terms), count)
        much = np.flatnonzero((entries > 0) & (entries * DENSE_SPEED >= matrix.size))
        row = np.full(count, -1)
        row[much] = np.arange(len(much))
        inside = row[query] >= 0
        factors = np.zeros((len(much), len(matrix)), dtype=np.float32)
        factors[row[query[inside]], place[terms[inside]]] = weights[inside]
        return dict(zip(much.tolist(), factors @ matrix))

    def nearest_all(
        self, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each query; the entries of query i lie from starts[i] to starts[i + 1]."""
        for first in range(0, len(starts) - 1, QUERIES):
            ends = starts[first : first + QUERIES + 1]
            ends, some = ends - ends[0], slice(ends[0], ends[-1])
            chosen, factors = terms[some].astype(np.int64), weights[some]
            sums = self._read_long(ends, chosen, factors)
            for i, (start, end) in enumerate(zip(ends[:-1], ends[1:])):
                yield self.nearest(chosen[start:end], factors[start:end], k, sums.get(i))

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, sums: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples with a cosine above 0 and their cosines, nearest first; ``sums`` over the long lists,
        where they are known."""
        n = len(self.labels)
        if sums is None:
            by_add, factors, sums = terms, weights, np.zeros(n)
        else:
            others = self.long[0][terms] < 0
            by_add, factors, sums = terms[others], weights[others], sums.astype(np.float64)
        adds = factors * self.tops[by_add]
        order = np.argsort(-adds / np.maximum(self.postings.sizes(by_add), 1), kind="stable")
        by_add, factors = by_add[order], factors[order]
        # What the words from each place on can add to an example at most.
        left = np.append(np.cumsum(adds[order][::-1])[::-1], 0.0)
        done, rest, rows = 0, min(left[0], 1.0), None
        while rows is None:
            rest *= LEFT
            upto = min(max(done + 1, len(left) - np.searchsorted(left[::-1], rest, side="right")), len(by_add))
            sums += self.postings.sums(by_add[done:upto], factors[done:upto], n)
            done = upto
            least = np.partition(sums, n - k)[n - k] if n > k else 0.0
            if done == len(by_add):
                rows = np.flatnonzero((sums > 0) & (sums >= least - SLACK))
            elif least > left[done] + SLACK:
                rows = np.flatnonzero(sums >= least - left[done] - SLACK)
                if len(rows) > FINISHED:
                    rows = self._open(sums, by_add[done:], factors[done:], least)
        return self._finish(rows, terms, weights, k)

    def _open(self, sums: np.ndarray, terms: np.ndarray, factors: np.ndarray, least: float) -> np.ndarray | None:
        """Examples that can reach ``least`` with the terms left; None if they are many."""
        n, first = len(sums), np.arange(0, len(sums), BLOCK_ROWS)
        bounds = self.peaks.sums(terms, factors, len(first))
        blocks = np.flatnonzero(np.maximum.reduceat(sums, first) + bounds >= least - SLACK)
        rows = (blocks[:, None] * BLOCK_ROWS + np.arange(BLOCK_ROWS)).ravel()
        rows = rows[rows < n]
        rows = rows[(sums[rows] > 0) & (sums[rows] + bounds[rows // BLOCK_ROWS] >= least - SLACK)]
        return rows if len(rows) <= FINISHED else None

    def _finish(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Whole cosines of examples that share a word with the query; the k largest, ties to the earlier example."""
        if not len(rows):
            return rows, np.zeros(0)
        if self.scratch is None:
            self.scratch = np.zeros(len(self.weights))
        query = self.scratch
        query[terms] = weights
        own = zip(self.examples.starts[rows].tolist(), self.examples.starts[rows + 1].tolist())
        numbers, by_term = self.examples.numbers, self.examples.weights
        cosines = np.array([query.take(numbers[a:b]) @ by_term[a:b] for a, b in own])
        query[terms] = 0.0
        top = np.lexsort((rows, -cosines))[:k]
        return rows[top], cosines[top]

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        # Nearness is 1 / distance; the small constant keeps exact copies finite.
        # Every example speaks for the labelled rows it was drawn from.
        near = self.mass[rows] / (1.0 - np.minimum(cosines, 1.0) + 0.05)
        return float((near * self.labels[rows]).sum() / near.sum())

    def score(self, text: str) -> tuple[float, np.ndarray, np.ndarray]:
        return next(self.score_all([text]))

    def score_all(self, texts: list[str]) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """Score of each text, its nearest examples and their cosines."""
        query, terms, weights = self.vectors(*self.terms.of_all(texts), len(texts))
        for rows, cosines in self.nearest_all(np.searchsorted(query, np.arange(len(texts) + 1)), terms, weights):
            if len(rows):
                yield float(np.interp(self.vote(rows, cosines), self.votes, self.scores)), rows, cosines
            else:
                yield self.empty_score, rows, cosines


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: distinct x ascending and the non-decreasing fit at each."""
    order = np.argsort(x, kind="stable")
    points, start = np.unique(x[order], return_index=True)
    w = np.add.reduceat(weight[order], start)
    v = np.add.reduceat((weight * y)[order], start) / w
    pools: list[list[float]] = []
    for value, mass in zip(v, w):
        pools.append([value, mass, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return points, np.repeat([p[0] for p in pools], [p[2] for p in pools])


def dependence(toxic: np.ndarray, has: np.ndarray, positive: float, n: float) -> np.ndarray:
    """Log-likelihood ratio between a word's presence and the label: ``has`` of n examples hold it, ``toxic`` of them
    are among the ``positive``. Unlike chi-squared it holds for rare words too."""

    def part(observed, share):
        expected = share / n if n else share
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1) / np.maximum(expected, 1e-300)), 0.0)

    negative, lacks, clean = n - positive, n - has, has - toxic
    ratio = part(toxic, has * positive) + part(clean, has * negative)
    ratio += part(positive - toxic, lacks * positive) + part(negative - clean, lacks * negative)
    return np.maximum(ratio, 0.0)


def _term_counts(vocabulary: dict[str, int]):
    """mapInArrow over texts: documents of the task that hold each term, and their number under term -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(vocabulary) + 1, dtype=np.int64)
        terms_of = Terms(vocabulary).of_all
        for batch in batches:
            for _, texts in _slices(batch, 0):
                seen[:-1] += np.bincount(terms_of(texts)[1], minlength=len(vocabulary))
                seen[-1] += len(texts)
        held = np.flatnonzero(seen)
        terms = np.where(held == len(vocabulary), -1, held)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(seen[held])], names=["term", "n"])

    return run


def _example_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [Counter(_WORDS(t.as_py().lower())) for t in batch.column(3)]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array([list(c.keys()) for c in counts], pa.list_(pa.string())),
                pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())),
                pa.array([len(c) for c in counts], pa.int64()),
            ],
            names=["id", "label", "ord", "words", "tf", "number"],
        )


def _entries(column: pa.ChunkedArray) -> pa.Array:
    """The entries of a list column, end to end."""
    return pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], column.type.value_type)


def fit(docs: DataFrame, labelled: DataFrame, id_column: str, text_column: str, label_column: str) -> Model | None:
    """A model from ``labelled`` (id, label 0/1); texts and document frequencies come from ``docs``."""
    known = labelled.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("__label")
    )
    known = known.groupBy("__id").agg(F.max("__label").alias("__label"))
    shares = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    if not shares:
        return None
    drawn = None
    for label in (0, 1):
        own = known.where(F.col("__label") == label).withColumn("__order", F.xxhash64("__id"))
        own = own.orderBy("__order", "__id").limit(MAX_EXAMPLES)
        drawn = own if drawn is None else drawn.unionByName(own)
    # At most 2 * MAX_EXAMPLES narrow rows.
    drawn = cut_lineage(drawn)
    texts = docs.select(F.col(id_column).alias("__id"), whole_text(text_column).alias("__text"))
    examples = texts.join(F.broadcast(drawn), "__id").dropDuplicates(["__id"]).select("__id", "__label", "__order", "__text")
    id_type = examples.schema["__id"].dataType.simpleString()
    worded = cut_lineage(
        examples.mapInArrow(_example_words, f"id {id_type}, label int, ord long, words array<string>, tf array<int>, number long")
    )
    # Windows over the drawn rows only.
    before = Window.partitionBy("label").orderBy("ord", "id").rowsBetween(Window.unboundedPreceding, -1)
    sized = worded.select("id", "label", "number", F.coalesce(F.sum("number").over(before), F.lit(0)).alias("before"))
    fits = sized.where((F.col("before") == 0) | (F.col("before") + F.col("number") <= MAX_POSTINGS)).select("id")
    held = worded.join(F.broadcast(fits), "id", "left_semi").orderBy("ord", "id").toArrow()
    coded = _entries(held["words"]).dictionary_encode()
    vocabulary = {w: i for i, w in enumerate(coded.dictionary.to_pylist())}
    terms, tf = coded.indices.to_numpy(zero_copy_only=False), _entries(held["tf"]).to_numpy(zero_copy_only=False)
    number, labels = held["number"].to_numpy(), held["label"].to_numpy().astype(np.float64)
    ids = held["id"].to_pylist()
    del coded, held
    pa.default_memory_pool().release_unused()
    counted = texts.select("__text").mapInArrow(_term_counts(vocabulary), "term int, n long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(vocabulary) + 1)
    df[counted["term"].to_numpy()] = counted["n"].to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    has = np.bincount(terms, minlength=len(vocabulary)).astype(np.float64)
    toxic = np.bincount(terms, np.repeat(labels, number), len(vocabulary))
    weights = idf * (dependence(toxic, has, labels.sum(), float(len(labels))) + LEAST)
    model = build(vocabulary, weights, ids, labels, np.repeat(np.arange(len(ids), dtype=np.int32), number), terms, tf, shares)
    # What building took and the model doesn't hold goes before the model is written for the tasks.
    del counted, df, has, idf, number, terms, tf, toxic
    release_memory()
    return model


def _strongest(n: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of each example, the last one of its terms by weight; -1 without terms."""
    by_weight = np.lexsort((-term, weight, row))
    last = np.flatnonzero(np.diff(row[by_weight], append=n))
    strongest = np.full(n, -1)
    strongest[row[by_weight][last]] = term[by_weight][last]
    return strongest


def _peaks(postings: Lists) -> Lists:
    """By term one entry for each block it occurs in, with the largest weight there."""
    blocks = postings.numbers.astype(np.int32) // BLOCK_ROWS
    change = np.diff(blocks, prepend=blocks[:1]) != 0
    change[postings.starts[:-1][np.diff(postings.starts) > 0]] = True
    first = np.flatnonzero(change)
    highest = np.maximum.reduceat(postings.weights, first) if len(first) else postings.weights
    held = blocks[first]
    return Lists(np.searchsorted(first, postings.starts), held.astype(np.min_scalar_type(held.max(initial=0))), highest)


def build(vocabulary, weights, ids, labels, row, term, tf, shares) -> Model:
    """Index and calibration from the terms' weights and the examples' words: example, term and count of each."""
    n = len(ids)
    drawn = {y: max(1, int((labels == y).sum())) for y in (0, 1)}
    weight = (1 + np.log(tf)) * weights[term]
    length = np.sqrt(np.bincount(row, weight * weight, n))
    weight = weight / length[row]
    order = np.argsort(_strongest(n, row, term, weight), kind="stable")
    place = np.empty(n, dtype=np.int32)
    place[order] = np.arange(n)
    row, labels = place[row], labels[order]
    mass = np.array([shares.get(int(y), 0) / drawn[int(y)] for y in labels])
    postings = Lists.of(len(vocabulary), term, row, weight.astype(np.float32))
    peaks = _peaks(postings)
    tops = np.zeros(len(vocabulary))
    np.maximum.at(tops, term, weight)
    examples = Lists.of(n, row, term, weight)
    model = Model(
        Terms(vocabulary), weights, postings, peaks, tops, examples, labels, mass, [ids[i] for i in order], np.zeros(1), np.zeros(1), 0.0,
    )
    del row, weight
    # Votes without the example itself: one neighbour more is asked for, and its own is left out.
    votes, voted, silent = [], [], []
    for i, (rows, cosines) in enumerate(model.nearest_all(examples.starts, examples.numbers, examples.weights, NEIGHBOURS + 1)):
        other = rows != i
        rows, cosines = rows[other][:NEIGHBOURS], cosines[other][:NEIGHBOURS]
        if len(rows):
            votes.append(model.vote(rows, cosines))
            voted.append(i)
        else:
            silent.append(i)
    model.scratch = model.long = None
    if voted:
        # Half an observation of either class at the ends keeps scores inside 0 and 1.
        x = np.concatenate([votes, [0.0, 1.0]])
        y = np.concatenate([labels[voted], [0.0, 1.0]])
        model.votes, model.scores = isotonic(x, y, np.concatenate([mass[voted], [0.5, 0.5]]))
    everyone = mass.sum()
    prior = float((mass * labels).sum() / everyone) if everyone else 0.0
    quiet = mass[silent].sum() if silent else 0.0
    model.empty_score = float(((mass * labels)[silent].sum() + prior) / (quiet + 1.0)) if silent else prior
    return model


def _scorer(model: Model | None, text_at: int):
    evidence = pa.struct([("id", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is not None:
            ids, labels = pa.array([str(i) for i in model.ids], pa.string()), model.labels.astype(np.int32)
        for batch in batches:
            for part, texts in _slices(batch, text_at):
                if model is None:
                    scores, near = [0.0] * len(texts), pa.array([[]] * len(texts), pa.list_(evidence))
                else:
                    scores, rows, cosines = zip(*model.score_all(texts))
                    ends = np.cumsum([0, *map(len, rows)])
                    rows = np.concatenate(rows)
                    entries = [ids.take(pa.array(rows)), pa.array(np.concatenate(cosines)), pa.array(labels[rows])]
                    entries = pa.StructArray.from_arrays(entries, fields=list(evidence))
                    near = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores, pa.float64()), near],
                    names=[*batch.schema.names, "score", "evidence"],
                )

    return run


def score(docs: DataFrame, model: Model | None, text_column: str = "text", score_as: str = "score", evidence_as: str = "evidence") -> DataFrame:
    """``docs`` with a score in 0..1 and its evidence: array<struct<id, cosine, label>>, nearest first."""
    types = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = plain.mapInArrow(
        _scorer(model, docs.columns.index(text_column)),
        f"{types}, score double, evidence array<struct<id: string, cosine: double, label: int>>",
    )
    return scored.toDF(*docs.columns, score_as, evidence_as)


def reject_toxic(docs: DataFrame, labels: DataFrame, training: Column, limit: float = 0.5, id_column: str = "doc_id",
                 text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``; ``training`` says which label rows may be learnt from."""
    mark, evidence = free_name(docs, "__score"), free_name(docs, "__evidence")
    scored = score(docs, fit(docs, labels.where(training), id_column, text_column, label_column), text_column, mark, evidence)
    # The tasks have the model; the driver keeps none.
    release_memory()
    return scored.where(F.col(mark) < limit).select(*docs.columns)
