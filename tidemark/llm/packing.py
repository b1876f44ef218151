"""Best-fit packing of tokenised documents into sequences.

A sequence is a bin with three capacities: tokens, pieces and attention cost (the sum of squared piece lengths). Pieces
go in by decreasing length, each into the open bin that scores best among those with room in *every* capacity: by the
weighted dot product of the piece with what the bin has left, or by the weighted norm of what would be left.

Documents are tokenised where they lie. Pieces (a few numbers each, never the ids) are then dealt by hash into groups
of about ``GROUP_PIECES``, whatever their source or length, and every group is packed on its own; the last, partly
filled bins of all groups are packed again until one group holds them, so splitting costs a bin per round at most.

Defined cases: null text is empty and gives one piece holding only the end id; only documents longer than a sequence
are cut; repeated and null ids give one set of pieces per row; an empty table gives no sequences.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, whole_text
from tidemark.session import cut_lineage

# Tokens of a sequence; the piece and attention capacities that go with it never bind before the tokens do.
SEQUENCE_TOKENS = 4096
END_ID = 1
# Pieces that one task packs at a time.
GROUP_PIECES = 16_384
# Weights of tokens, pieces and attention cost in the score.
WEIGHTS = (1.0, 0.05, 0.25)
# Words a task remembers before it starts anew, at about 250 bytes each.
REMEMBERED = 400_000
# Characters of documents that are encoded together.
BATCH_CHARS = 2_000_000

PIECES = "__row long, piece int, start long, length long, ids_crc32 long"


class Numbering(dict):
    """Numbers what is looked up, in the order of first sight."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def byte_of_sign() -> dict[str, int]:
    """The byte each sign of a byte-level vocabulary stands for: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PlainEncoder:
    """The tokenizer's merges for plain words, as ranks for a faster encoder.

    The mark for a word's end becomes a byte that plain words don't have, after each word; its ranks come first, as
    the tokenizer starts from letters that carry the mark already.
    """

    END = "\x01"

    def __init__(self, tokenizer):
        import tiktoken

        signs, mark = byte_of_sign(), "</w>"
        ranks = {}
        for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
            body = token.removesuffix(mark)
            if all(c in signs for c in body):
                ranks[bytes(signs[c] for c in body) + (self.END.encode() if body != token else b"")] = number
        self.encoding = tiktoken.Encoding(
            "plain", pat_str=f"[^{self.END}]+{self.END}", mergeable_ranks=ranks, special_tokens={}
        )
        self.ends = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.ends[[n for t, n in ranks.items() if t.endswith(self.END.encode())]] = True

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, and how many each word has."""
        ids = np.array(self.encoding.encode_ordinary("".join(w + self.END for w in words)), dtype=np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        return ids, np.diff(stops, prepend=0)


class WordEncoder:
    """Ids of texts by way of their words.

    The tokenizer never joins what ASCII white space separates, nor letters with the signs that follow them, and it
    ignores case. So a text's ids are its words' ids in turn, a plain word's those of its lower-case letters and of its
    trailing signs. Words recur, so each is encoded once and remembered, up to a fixed number.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = PlainEncoder(self.tokenizer)
        self._forget()

    def _forget(self) -> None:
        # Words by number, each of two parts; parts by number, part 0 being the empty one.
        self.words, self.parts = Numbering(), Numbering({"": 0})
        self.halves = np.zeros((0, 2), np.int64)
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.begin = self.size

    def _learn(self) -> None:
        """Take in the words and parts numbered since the last time."""
        halves = []
        for word in islice(self.words, len(self.halves), None):
            plain = _PLAIN(word)
            # What is not plain is a part as it stands, told apart by a sign before it that no word has.
            halves.append((self.parts[plain[1].lower()], self.parts[plain[2]]) if plain else (self.parts[" " + word], 0))
        self.halves = np.concatenate([self.halves, np.array(halves, dtype=np.int64).reshape(-1, 2)])
        fresh = list(islice(self.parts, len(self.size), None))
        odd = [i for i, p in enumerate(fresh) if p[0] == " "]
        easy = [i for i, p in enumerate(fresh) if p[0] != " "]
        rest = [e.ids for e in self.tokenizer.encode_batch([fresh[i][1:] for i in odd], add_special_tokens=False)]
        ids, counts = self.plain.encode([fresh[i] for i in easy])
        size, begin = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        size[easy], size[odd] = counts, [len(r) for r in rest]
        begin[easy] = np.cumsum(counts) - counts
        begin[odd] = len(ids) + np.cumsum(size[odd]) - size[odd]
        self.begin = np.concatenate([self.begin, begin + len(self.flat)])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, ids, np.array([i for r in rest for i in r], dtype=np.uint32)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > REMEMBERED:
            self._forget()
        number, codes, counts = self.words, [], [0]
        for text in texts:
            # str.split would also split at separators that the tokenizer must see itself.
            own = [number[w] for w in _WORDS(text)]
            codes.extend(own)
            counts.append(len(own))
        if len(self.words) > len(self.halves):
            self._learn()
        parts = self.halves[codes]
        each = self.size[parts]
        ends = np.cumsum(each.sum(axis=1))
        parts, each = parts.ravel(), each.ravel()
        total = int(each.sum())
        ids = self.flat[np.repeat(self.begin[parts] - (np.cumsum(each) - each), each) + np.arange(total)]
        cuts = np.concatenate(([0], ends))[np.cumsum(counts)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


_WORDS = re.compile(WORD).findall
# Letters of Latin-1, which have one form and one lower case, and signs the tokenizer takes for a run of their own.
_PLAIN = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]*)([.,:;!?#$%&*|()]*)").fullmatch


def _cut(ids: np.ndarray, row: int, limit: int):
    whole = np.append(ids, np.uint32(END_ID)).astype("<u4")
    for k, start in enumerate(range(0, len(whole), limit)):
        piece = whole[start : start + limit]
        yield row, k, start, len(piece), zlib.crc32(piece.tobytes())


def piece_maker(path: str, limit: int):
    """A mapInArrow function from (id, row, text) to the pieces of each document."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            at, texts = 0, batch.column(2)
            while at < batch.num_rows:
                held, size, begin = [], 0, at
                while at < batch.num_rows and (not held or size < BATCH_CHARS):
                    held.append(texts[at].as_py())
                    size += len(held[-1])
                    at += 1
                cut = [x for k, ids in enumerate(encoder.encode(held)) for x in _cut(ids, begin + k, limit)]
                place, *numbers = zip(*cut)
                place = pa.array(place, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(place), batch.column(1).take(place)]
                    + [pa.array(x, t) for x, t in zip(numbers, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["__id", "__row", "piece", "start", "length", "ids_crc32"],
                )

    return pieces


def vector_best_fit(
    lengths: np.ndarray, capacities: tuple[float, float, float], weights=WEIGHTS, rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; ``lengths`` must not rise. ``rule`` is ``norm`` or ``dot``."""
    full = np.array(capacities, dtype=np.float64)
    scale = np.sqrt(np.array(weights)) / full
    n = len(lengths)
    left = np.empty((3, n))
    number = np.empty(n, dtype=np.int64)
    bins, offsets = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    open_bins = made = 0
    smallest = lengths[-1] if n else 0
    for i in range(n):
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size])
        at = -1
        if open_bins:
            rest = left[:, :open_bins] - need[:, None]
            fits = (rest >= 0).all(axis=0)
            if fits.any():
                if rule == "dot":
                    score = -((left[:, :open_bins] * (scale * scale * need)[:, None]).sum(axis=0))
                else:
                    score = np.square(rest * scale[:, None]).sum(axis=0)
                at = int(np.argmin(np.where(fits, score, np.inf)))
        if at < 0:
            at = open_bins
            left[:, at] = full
            number[at] = made
            open_bins, made = open_bins + 1, made + 1
        bins[i], offsets[i] = number[at], int(full[0] - left[0, at])
        left[:, at] -= need
        if left[0, at] < smallest or left[1, at] < 1:
            # Nothing that is still to come fits: close the bin, keeping the others in the order they were opened.
            left[:, at : open_bins - 1] = left[:, at + 1 : open_bins]
            number[at : open_bins - 1] = number[at + 1 : open_bins]
            open_bins -= 1
    return bins, offsets


def _packer(capacities, rule):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "__row", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = vector_best_fit(frame["length"].to_numpy(), capacities, WEIGHTS, rule)
        return frame.assign(bin=bins, offset=offsets)

    return pack


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: int = SEQUENCE_TOKENS,
    pieces: int | None = None,
    attention: float | None = None,
    rule: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``pieces`` and ``attention`` bound a sequence's pieces and its sum of squared lengths; by default every sequence
    the token capacity allows is allowed. Documents are cut so that each piece fits a sequence of its own.
    """
    capacities = (float(tokens), float(pieces or tokens), float(attention or tokens * tokens))
    limit = min(tokens, isqrt(int(capacities[2])))
    if limit < 1 or capacities[1] < 1:
        raise ValueError("a sequence must be able to hold one piece")
    keyed = docs.select(
        F.col(id_column).alias("__id"), F.monotonically_increasing_id().alias("__row"), whole_text(text_column).alias("__text")
    )
    id_type = keyed.schema["__id"].dataType.simpleString()
    made = cut_lineage(keyed.mapInArrow(piece_maker(tokenizer_path, limit), f"__id {id_type}, {PIECES}"))
    groups = max(1, -(-made.count() // group_pieces))
    dealt = made.withColumn("group", F.pmod(F.xxhash64("__row", "piece"), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", bin long, offset long"
    placed = cut_lineage(dealt.groupBy("group").applyInPandas(_packer(capacities, rule), schema))
    while groups > 1:
        # Bins left half empty are emptied and their pieces packed again, over ever fewer groups.
        filled = placed.groupBy("group", "bin").agg(F.sum("length").alias("__filled"))
        loose = filled.where(F.col("__filled") < tokens // 2).select("group", "bin")
        again = cut_lineage(placed.join(loose, ["group", "bin"], "left_semi").drop("bin", "offset", "group"))
        fewer = max(1, -(-again.count() // group_pieces))
        if fewer >= groups:
            break
        kept = placed.join(loose, ["group", "bin"], "left_anti")
        repacked = (
            again.withColumn("group", F.pmod(F.xxhash64("__row", "piece"), F.lit(fewer)))
            .groupBy("group")
            .applyInPandas(_packer(capacities, rule), schema)
        )
        # Bin numbers of a group stay below 2**32, so a round's groups get numbers of their own from its first one up.
        top = placed.agg(F.max("group")).first()[0] + 1
        placed = cut_lineage(kept.select(*repacked.columns).unionByName(repacked.withColumn("group", F.col("group") + top)))
        groups = fewer
    return placed.select(
        F.col("__id").alias(id_column),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.shiftleft(F.col("group"), 32) + F.col("bin")).alias("sequence_id"),
        "offset",
    )
