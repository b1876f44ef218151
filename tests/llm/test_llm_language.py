"""Language identification against a plain naive Bayes classifier and on held-out rows."""

import math
import unicodedata
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, queries

SCHEMA = "doc_id bigint, text string, lang string"
MASK = (1 << 64) - 1


def plain_features(text):
    """Hashed runs of one to three characters of the text, one by one."""
    cleaned = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    padded = " " + " ".join(cleaned.split(" ")).strip() + " "
    while "  " in padded:
        padded = padded.replace("  ", " ")
    out = Counter()
    for i in range(len(padded)):
        mixed = 0
        for n in range(language_id.ORDERS):
            if i + n >= len(padded):
                break
            mixed = ((mixed ^ (ord(padded[i + n]) * language_id._PLACES[n] & MASK)) * language_id._MIX) & MASK
            out[(((mixed ^ (mixed >> 29)) * language_id._MIX) & MASK) >> (64 - language_id.BITS)] += 1
    return out


def plain_model(rows):
    counts, number = {}, Counter()
    for _, text, lang in rows:
        if lang is not None:
            number[lang] += 1
            counts.setdefault(lang, Counter())
            if text and any(c.isalpha() for c in text):
                counts[lang].update(plain_features(text))
    return counts, number


def plain_prediction(text, counts, number):
    if not counts or not text or not any(unicodedata.category(c)[0] == "L" for c in text):
        return "und", 0.0
    size = 1 << language_id.BITS
    logs = {}
    for lang, found in counts.items():
        total = sum(found.values()) + size * language_id.SMOOTHING
        logs[lang] = math.log(number[lang] / sum(number.values())) + sum(
            n * math.log((found[place] + language_id.SMOOTHING) / total) for place, n in plain_features(text).items()
        )
    best = min(logs, key=lambda k: (-logs[k], k))
    return best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())


TEACH = [
    (1, "the cat sat on the mat", "en"), (2, "der Hund liegt auf der Matte", "de"), (3, "le chat est sur le tapis", "fr"),
    (4, "What's THE matter, 12 of them?", "en"), (5, "Über Größe läßt sich streiten", "de"), (6, None, "fr"),
    (7, "nobody says which", None), (8, "123 456", "de"),
]
ASK = [
    "the mat", "auf der Matte", "le tapis!", "", None, "12 + 4 = 16", "ß", "x", "ÉTÉ  été\n\tÉté", "日本語", "á", "́",
    "der the le",
]


@pytest.mark.parametrize("piece", [1, 2, 3, 50, 1 << 18])
def test_equals_plain_naive_bayes(spark, monkeypatch, piece):
    """However long texts are cut into pieces, no run of characters is lost or counted twice."""
    monkeypatch.setattr(language_id, "PIECE", piece)
    model = language_id.fit(spark.createDataFrame(TEACH, SCHEMA))
    assert model.names == ["de", "en", "fr"]
    ask = spark.createDataFrame([(i, t) for i, t in enumerate(ASK)], "doc_id bigint, text string")
    counts, number = plain_model(TEACH)
    for r in language_id.predict(ask, model).collect():
        lang, score = plain_prediction(ASK[r["doc_id"]], counts, number)
        assert (r["lang_pred"], r["score"]) == (lang, pytest.approx(score, abs=1e-4)), r


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    none = language_id.fit(empty)
    assert language_id.predict(empty, none).collect() == []
    some = spark.createDataFrame([(1, "hello there", None), (2, None, None)], SCHEMA)
    untaught = [(r["lang_pred"], r["score"]) for r in language_id.predict(some, language_id.fit(some)).collect()]
    assert untaught == [("und", 0.0)] * 2
    # Repeated rows teach once, and columns named like the results' pass through under their own names.
    twice = spark.createDataFrame(TEACH * 50, SCHEMA)
    model = language_id.fit(twice)
    assert (model.logs == language_id.fit(spark.createDataFrame(TEACH, SCHEMA)).logs).all()
    wide = some.withColumns({"c0": F.lit(5), "score": F.lit("mine"), "lang": F.lit("l")})
    out = language_id.predict(wide, model, lang_as="found", score_as="sure")
    assert out.columns == [*wide.columns, "found", "sure"]
    assert {r["score"] for r in out.collect()} == {"mine"}
    kept = language_id.keep_languages(wide.withColumn("__lang", F.lit(0)), model, ["en"], 0.3)
    assert [r["doc_id"] for r in kept.collect()] == [1]


def test_a_very_long_text_is_read_whole(spark):
    model = language_id.fit(spark.createDataFrame(TEACH, SCHEMA))
    long = "the cat " * 10 + "der Hund liegt auf der Matte " * 40_000
    got = language_id.predict(spark.createDataFrame([(1, long)], "doc_id bigint, text string"), model).first()
    assert got["lang_pred"] == "de" and got["score"] > 0.999


def test_examples_are_bounded_per_language(spark):
    many = spark.range(5000).select(
        "id", F.concat(F.lit("word "), F.col("id").cast("string"), F.lit(" abc")).alias("text"),
        F.when(F.col("id") % 10 == 0, "x").otherwise("y").alias("lang"),
    )
    model = language_id.fit(many, "id", max_examples=100)
    assert model.names == ["x", "y"] and model.priors.tolist() == pytest.approx([math.log(0.1), math.log(0.9)])


def test_held_out_languages_are_found(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_language"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    judged = [r for r in rows if r["held_out"] and truth[r["doc_id"]] is not None]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in judged) / len(judged) >= 0.98
