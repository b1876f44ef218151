"""Language of a text by multinomial naive Bayes over hashed character n-grams.

A text is lower-cased; every run of signs that are no letters (or marks on letters) becomes one space, and a space stands
before and after the text. Its features are all runs of one to ``ORDERS`` characters, hashed into ``2**BITS`` places. A
language's log-probabilities come from the summed counts of its examples, smoothed, and its prior from the number of its
labelled rows. The matrix of log-probabilities is broadcast; a batch of texts becomes the entries of a sparse matrix (rows
are texts, columns places), which is multiplied with it in numpy.

Fitting takes a bounded sample: about ``MAX_EXAMPLES`` different labelled rows of each language, whole texts, drawn by a
hash of id and text. Their counts are added up by Spark, so the driver gets at most one number per language and place.
The matrix has four bytes per language and place, a quarter of a megabyte per language; more than ``MAX_LANGUAGES``
languages are refused.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; texts of any length are read whole, in
pieces; rows without a language teach nothing; repeated rows are scored one by one and teach once; where two languages
are equally likely the lesser name wins; without labelled rows all is ``und`` with score 0; other columns pass through,
whatever their names.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, whole_text
from tidemark.session import cut_lineage

MAX_EXAMPLES = 2000
MAX_LANGUAGES = 300
BITS = 16
ORDERS = 3
SMOOTHING = 0.5
UNKNOWN = "und"

# Characters hashed at a time; features of several short texts share one pass.
PIECE = 1 << 18
# Steps in which the hashes of labelled rows are told apart.
HASHES = 1 << 20
SPACE = ord(" ")

# Odd multipliers of the hash of a run: one for each character in it, one to mix.
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
_MIX = 0xD6E8FEB86659FD93

_letters: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    """Of every code point: 2 for a letter, 1 for a mark on one, 0 for all else. Worked out once per process."""
    if "kinds" not in _letters:
        kinds = {"L": 2, "M": 1}
        found = (kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1))
        _letters["kinds"] = np.fromiter(found, dtype=np.uint8, count=sys.maxunicode + 1)
    return _letters["kinds"]


def code_points(text: str) -> np.ndarray:
    """The text as features see it: lower-case letters, single spaces between and around; empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    kind = letters()[codes]
    if not (kind == 2).any():
        return np.zeros(0, dtype=np.uint32)
    kept = np.where(kind > 0, codes, SPACE).astype(np.uint32)
    kept = np.concatenate([[SPACE], kept, [SPACE]]).astype(np.uint32)
    space = kept == SPACE
    return kept[~(space & np.concatenate([[False], space[:-1]]))]


def runs(codes: np.ndarray, of: np.ndarray, seen: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, text) of the runs of ``codes`` within one text, a length of run at a time and in order of their texts.

    ``of`` numbers the texts, ascending; runs that end in the first ``seen`` characters are left out.
    """
    wide = codes.astype(np.uint64)
    mixed = np.zeros(len(wide), dtype=np.uint64)
    for n in range(1, ORDERS + 1):
        # The hash of a run is that of the run one shorter and of its last character.
        last = wide[n - 1 :] * np.uint64(_PLACES[n - 1])
        mixed = (mixed[: len(last)] ^ last) * np.uint64(_MIX)
        new = of[: len(last)] == of[n - 1 :]
        new[: max(0, seen - n + 1)] = False
        place = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(_MIX)) >> np.uint64(64 - BITS)
        yield place[new].astype(np.int64), of[: len(last)][new]


def sparse(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' features as entries (place, text) of a sparse matrix, some at a time, each part ascending by text.

    About ``PIECE`` characters are hashed together; a long text goes on in the next piece, which repeats its last
    ``ORDERS`` - 1 characters so that no run is lost.
    """
    codes, owner, held = [], [], 0
    for i, text in enumerate(texts):
        own = code_points(text) if text else np.zeros(0, dtype=np.uint32)
        for start in range(0, len(own), PIECE):
            again = min(start, ORDERS - 1)
            part = own[start - again : start + PIECE]
            if again:
                # What a long text has left is hashed apart from the texts before it.
                yield from runs(part, np.full(len(part), i), again)
                continue
            codes.append(part)
            owner.append(np.full(len(part), i))
            held += len(part)
            if held >= PIECE:
                yield from runs(np.concatenate(codes), np.concatenate(owner))
                codes, owner, held = [], [], 0
    if held:
        yield from runs(np.concatenate(codes), np.concatenate(owner))


@dataclass
class Model:
    """``logs``: (language, place) log-probabilities; ``priors``: log-priors; ``names``: the languages, ascending."""

    names: list[str]
    priors: np.ndarray
    logs: np.ndarray


def likeliest(texts: list[str | None], names: list[str], priors: np.ndarray, logs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Most likely language and its posterior probability, of each text."""
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    total = np.zeros((len(texts), len(names)))
    lettered = np.zeros(len(texts), dtype=bool)
    for place, row in sparse(texts):
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        if not len(starts):
            continue
        lettered[row[starts]] = True
        for j in range(len(names)):
            total[row[starts], j] += np.add.reduceat(logs[j][place], starts, dtype=np.float64)
    total += priors
    best = total.argmax(axis=1)
    odds = np.exp(total - total.max(axis=1, keepdims=True))
    score = np.where(lettered, 1.0 / odds.sum(axis=1), 0.0)
    return [names[b] if known else UNKNOWN for b, known in zip(best.tolist(), lettered.tolist())], score


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's examples, added up by language before they leave it."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        names, texts = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(1).to_pylist()
        for name in set(names.tolist()):
            sums = held.setdefault(name, np.zeros(1 << BITS, dtype=np.int64))
            for place, _ in sparse([texts[i] for i in np.flatnonzero(names == name)]):
                sums += np.bincount(place, minlength=1 << BITS)
    for name, sums in held.items():
        place = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(place), pa.string()), pa.array(place, pa.int32()), pa.array(sums[place], pa.int64())],
            names=["name", "place", "number"],
        )


def model_of(names: list[str], rows_of: list[int], sums: np.ndarray) -> Model:
    """A model from summed counts (language, place) and the number of labelled rows of each language."""
    smooth = sums + SMOOTHING
    logs = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    shares = np.array(rows_of, dtype=float)
    return Model(names, np.log(shares) - np.log(shares.sum()), logs.astype(np.float32))


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        max_examples: int = MAX_EXAMPLES) -> Model:
    """A model of the labelled rows; rows whose language is null are left out."""
    known = labelled.where(F.col(lang_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("name"), whole_text(text_column).alias("text"),
        F.xxhash64(F.col(id_column).cast("string"), F.col(text_column)).alias("order"),
    )
    languages = known.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("order").alias("different"))
    languages = cut_lineage(languages.limit(MAX_LANGUAGES + 1))
    rows_of = {r["name"]: r["rows"] for r in languages.collect()}
    if len(rows_of) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix of log-probabilities would not fit a broadcast")
    names = sorted(rows_of)
    if not names:
        return Model([], np.zeros(0), np.zeros((0, 1 << BITS), dtype=np.float32))
    # Hashes are even, so a language's share of them is its share of examples, and rows are drawn where they lie.
    drawn = known.join(F.broadcast(languages), "name").where(
        F.pmod("order", F.lit(HASHES)) * F.col("different") < F.lit(max_examples).cast("bigint") * HASHES
    )
    examples = cut_lineage(drawn.dropDuplicates(["name", "order"]).select("name", "text"))
    parts = examples.mapInArrow(_summed, "name string, place int, number bigint")
    summed = parts.groupBy("name", "place").agg(F.sum("number").alias("number")).toPandas()
    at = {name: i for i, name in enumerate(names)}
    sums = np.zeros((len(names), 1 << BITS))
    sums[[at[n] for n in summed["name"]], summed["place"]] = summed["number"]
    return model_of(names, [rows_of[n] for n in names], sums)


def predict(docs: DataFrame, model: Model, text_column: str = "text", lang_as: str = "lang_pred",
            score_as: str = "score") -> DataFrame:
    """``docs`` with the language of each text and its probability."""
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.priors, model.logs))
    text_at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = likeliest(batch.column(text_at).to_pylist(), *shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang", "score"],
            )

    types = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, f"{types}, lang string, score double").toDF(*docs.columns, lang_as, score_as)


def keep_languages(docs: DataFrame, model: Model, wanted: list[str], least: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` in one of the ``wanted`` languages with at least that probability."""
    lang, score = free_name(docs, "__lang"), free_name(docs, "__score")
    scored = predict(docs, model, text_column, lang, score)
    return scored.where(F.col(lang).isin(wanted) & (F.col(score) >= least)).select(*docs.columns)
