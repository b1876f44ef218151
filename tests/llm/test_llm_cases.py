"""Defined cases of each operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import tracemalloc
import weakref
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import ann, exact, html_text, labelled_pages, mixing, packing, quality, repeats, secrets, simhash, toxicity
from tidemark.llm.queries import tokenizer_path

CLASHING = ["__id", "__row", "__sha", "__key", "__text", "__hot", "__first", "__order", "__size", "key", "first", "score", "times"]
PASSAGE = "the river ran past the old mill and into the town where nobody had seen it rise so high before that winter "


@pytest.fixture
def odd(make_docs):
    """Null ids and texts, empty and blank texts, repeated rows and ids, one long text; with clashing column names."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    rows = [
        (1, "a b c"), (2, "a  b\tc"), (3, None), (4, ""), (5, " "), (6, long, None), (7, long.upper(), None),
        (8, "a b c", "t"), (8, "a b c", "t"), (8, "z " * 50, "t"), (None, "a b c"), (None, None, None), (9, "x" * 3000, "u"),
    ]
    docs = make_docs(rows)
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit(f"kept {name}"))
    return docs


def test_exact_dedup_of_odd_rows(odd):
    for hot in (64, 2):
        rows = exact.settle(odd, hot_rows=hot).collect()
        assert len(rows) == odd.count()
        same = [r for r in rows if r.text_sha256 == hashlib.sha256(b"a b c").hexdigest()]
        assert len(same) == 5 and {(r.keep_id, r.group_size) for r in same} == {(1, 5)}
        assert [r.doc_id for r in same if r.kept] == [1]
        empty = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
        assert sorted((r.doc_id is None, r.doc_id, r.kept) for r in empty) == [(False, 3, True), (False, 4, False), (True, None, False)]
        kept = exact.drop_exact_copies(odd, hot_rows=hot)
        assert kept.columns == odd.columns
        assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7, 8, 9]
        assert {r["__sha"] for r in kept.collect()} == {"kept __sha"}


def test_exact_dedup_names_hot_digests(spark):
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("d")
    )
    assert "hot" in [r.d for r in exact.frequent(rows, "d").collect()]


def test_near_groups_of_odd_rows(odd, spark):
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == odd.count()
    by_print = {}
    for r in rows:
        by_print.setdefault(r.fingerprint, set()).add(r.component_id)
    assert all(len(c) == 1 for c in by_print.values())
    assert by_print["0" * 16] == {3}
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 8, 9]
    assert simhash.near_groups(odd.limit(0)).count() == 0 and simhash.drop_near_copies(odd.limit(0)).count() == 0


def test_bit_sliced_distances():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    values = np.concatenate([base ^ np.uint64(rng.integers(0, 256)) << np.uint64(rng.integers(0, 56)) for _ in range(40)])
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    for radius in (0, 1, 2, 3, 5, 8):
        assert (simhash.within(values, values, radius) == (apart <= radius)).all()
    far = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    assert not simhash.within(far[:1], far[1:], 2).any()


def test_hot_keys_lose_no_link(spark):
    """All fingerprints share one half; chains of links must close whether or not the key is split."""
    rng = random.Random(8)
    values = [0]
    for _ in range(250):
        values.append(rng.choice(values) ^ 1 << rng.randrange(32))
    values = sorted(set(values + [rng.getrandbits(32) for _ in range(50)]))
    frame = spark.createDataFrame([(v,) for v in values], "__fp long")
    want = {v: v for v in values}

    def find(x):
        while want[x] != x:
            x = want[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin(a ^ b).count("1") <= 2:
                x, y = find(a), find(b)
                want[max(x, y)] = min(x, y)
    for limit in (4096, 10):
        links = simhash.link_fingerprints(frame, key_rows=limit)
        got = {r.node: r.root for r in simhash.components(links).collect()}
        assert {v: got.get(v, v) for v in values} == {v: find(v) for v in values}


def test_repeats_of_odd_rows(odd, make_docs):
    rows = repeats.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    by_size = {r.n_bytes: r for r in rows}
    # A run of one letter: only its first window's bytes stay once, the rest repeats.
    assert by_size[3000].kept == b"" or len(by_size[3000].kept) <= 100
    assert repeats.remove_repeats(odd.limit(0)).count() == 0
    long = [r for r in rows if r.n_bytes > 100_000]
    assert len(long) == 2 and all(len(r.kept) < r.n_bytes for r in long)


@pytest.mark.parametrize("hot", [2048, 3])
def test_repeats_against_brute_force(make_docs, hot):
    rng = random.Random(hot)
    words = ["alpha", "beta", "gamma", "delta ", "é", "0", "xy", "\n"]
    rows = []
    for i in range(60):
        parts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 60)))]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, 1), PASSAGE[: rng.randint(90, len(PASSAGE))])
        if rng.random() < 0.3:
            parts.append("abc" * rng.randint(1, 120))
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, "")]
    seen, want = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                mark[p : p + 100] = b"\1" * 100
            seen.add(window)
        want[i] = bytes(b for b, m in zip(data, mark) if not m)
    got = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(make_docs(rows), hot_regions=hot).collect()}
    assert got == want


def test_mix_of_odd_rows(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.taken <= 3 * r.size and r.taken == r.size * r.times for r in rows)
    assert sum(r.taken for r in rows) <= sum(r.size for r in rows)
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.times for r in rows)
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mixed(odd.limit(0)).count() == 0


def test_mix_targets_and_chunks(make_docs):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice(["a", "a", "b", "c", "d", None])) for i in range(400)]
    docs = make_docs(rows)
    whole = sorted(tuple(r) for r in mixing.mix(docs).collect())
    assert whole == sorted(tuple(r) for r in mixing.mix(docs.repartition(7), chunk_rows=13).collect())
    sources = {i: s for i, _, s in rows}
    size, target, taken = {}, {}, {}
    for doc_id, n, source_size, goal, took, _ in whole:
        s = sources[doc_id]
        size[s], target[s] = source_size, goal
        taken[s] = taken.get(s, 0) + took
    total = sum(size.values())
    # Refill by hand: share by weight, cap at three times the size, share the excess again.
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    goal, free, left = {}, set(weights), float(total)
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            goal |= share
            break
        for s in over:
            goal[s] = 3.0 * size[s]
            left -= goal[s]
        free -= over
    for s in weights:
        assert target[s] == pytest.approx(goal[s])
        assert abs(taken[s] - goal[s]) <= 80


def test_packing_of_odd_rows(odd):
    rows = packing.pack(odd, tokenizer_path(), tokens=64, group_pieces=50).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert packing.pack(odd.limit(0), tokenizer_path()).count() == 0


def test_packing_keeps_every_capacity(make_docs):
    rng = random.Random(9)
    docs = make_docs([(i, "word " * rng.randint(0, 60)) for i in range(300)])
    for rule in ("norm", "dot"):
        rows = packing.pack(docs, tokenizer_path(), tokens=64, pieces=3, attention=2000, rule=rule, group_pieces=64).collect()
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for places in bins.values():
            places.sort()
            assert len(places) <= 3 and sum(n for _, n in places) <= 64 and sum(n * n for _, n in places) <= 2000
            assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer_path(), attention=0.5)


def test_word_encoder_equals_the_tokenizer():
    encoder = packing.WordEncoder(tokenizer_path())
    texts = [
        "", "  ", "It's don't I'LL 'S", "<|endoftext|> a<|endoftext|>b <|startoftext|>", "ÉTÉ İstanbul ΑΣ. ΑΣ\tb",
        "a b c　d", "x́. y.́ (a)b", "Å ẛ̣ ﬁn 12a 1.5", "$$a|b|| \x0b\x0c\x1c\x1d z \x01a\x01", "日本語 テスト",
        "ä. ßẞ µ × ÷a ª", "A.B.C... ???", "Thndle, (und) straße! Übergröße; naïve: œuvre",
    ]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_toxicity_of_odd_rows(odd, spark, make_docs):
    labels = spark.createDataFrame([(1, 0, 1), (None, 1, 1), (4, 0, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, labels, "doc_id", "text", "toxic")
    rows = toxicity.score(odd, model, "text", "s", "e").collect()
    assert len(rows) == odd.count() and all(0 <= r.s <= 1 for r in rows)
    assert toxicity.fit(odd, labels.limit(0), "doc_id", "text", "toxic") is None
    assert {r.s for r in toxicity.score(odd, None, "text", "s", "e").collect()} == {0.0}
    kept = toxicity.reject_toxic(odd, labels, F.lit(True))
    assert kept.columns == odd.columns
    assert toxicity.reject_toxic(odd.limit(0), labels, F.lit(True)).count() == 0


def test_nearest_examples_equal_brute_force():
    rng = np.random.default_rng(6)
    counts = []
    from collections import Counter

    for _ in range(400):
        counts.append(Counter(rng.zipf(1.6, rng.integers(1, 12)).clip(1, 60).tolist()))
    vocabulary = {str(i): i for i in range(61)}
    idf = rng.uniform(0.5, 4, 61)
    labels = (rng.random(400) < 0.3).astype(float)
    row = np.repeat(np.arange(400), [len(c) for c in counts])
    term, tf = np.array([(t, n) for c in counts for t, n in c.items()]).T
    model = toxicity.build(vocabulary, idf, list(range(400)), labels, row, term, tf, {0: 280, 1: 120})
    dense = np.zeros((400, 61))
    for i, c in enumerate(counts):
        # Examples are indexed in another order; their ids say which is which.
        terms, weights = model.vector(c)
        dense[model.ids.index(i), terms] = weights
    for c in counts[:80]:
        terms, weights = model.vector(c)
        rows, cosines = model.nearest(terms, weights, 15)
        query = np.zeros(61)
        query[terms] = weights
        exact_cosines = dense @ query
        assert np.allclose(cosines, np.sort(exact_cosines)[::-1][: len(cosines)])
        assert np.allclose(exact_cosines[rows], cosines)
        assert len(rows) == min(15, (exact_cosines > 0).sum())


def test_toxicity_neighbours_of_whole_texts(spark):
    """Every word of the examples counts: neighbours of whole documents against cosines worked out from the texts."""
    import math
    from collections import Counter

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels.where(F.col("doc_id") % 3 != 0), "doc_id", "text", "toxic")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    label = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id % 3 and r.toxic is not None and r.doc_id in texts}
    words = {i: Counter(re.findall(r"[^\W\d_]+", t.lower())) for i, t in texts.items()}
    frequency = Counter(w for c in words.values() for w in c)
    has = Counter(w for i in label for w in words[i])
    toxic = Counter(w for i in label if label[i] for w in words[i])
    n, pos = len(label), sum(label.values())
    assert set(model.terms.vocabulary) == set(has)

    def weight(w):
        cells = [(toxic[w], has[w] * pos), (has[w] - toxic[w], has[w] * (n - pos)),
                 (pos - toxic[w], (n - has[w]) * pos), (n - pos - has[w] + toxic[w], (n - has[w]) * (n - pos))]
        ratio = sum(o * math.log(o * n / e) for o, e in cells if o)
        return (math.log((1 + len(texts)) / (1 + frequency[w])) + 1) * (max(ratio, 0) + toxicity.LEAST)

    weights = {w: weight(w) for w in has}

    def vector(counts):
        v = {w: (1 + math.log(c)) * weights[w] for w, c in counts.items() if w in weights}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    vectors = {i: vector(words[i]) for i in label}
    for i in sorted(texts)[:60]:
        query = vector(words[i])
        cosines = {j: sum(x * query.get(w, 0.0) for w, x in v.items()) for j, v in vectors.items()}
        _, rows, near = model.score(texts[i])
        want = sorted((c for c in cosines.values() if c > 0), reverse=True)[: toxicity.NEIGHBOURS]
        assert np.allclose(near, want) and np.allclose([cosines[model.ids[r]] for r in rows], near)


def test_words_of_a_slice_are_those_of_its_texts():
    """Texts looked up together, in Latin-1 and beyond, have the words of each text by itself."""
    from collections import Counter

    points = "".join(chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000)
    texts = ["", "a b A-b_c1d", "\u00c9t\u00e9 \u00b5m x\u00b2 stra\u00dfe", "\u039f\u0394\u039f\u03a3 \u0130x \u017f", "", points[:256], points, " it\u2019s A \u2126\u212b", "\U0001d400b\U0001f600c"]
    words = re.compile(r"[^\W\d_]+").findall
    vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts[1:] for w in words(t.lower())} - {"b"}))}
    terms = toxicity.Terms(vocabulary)
    want = [Counter({vocabulary[w]: n for w, n in Counter(words(t.lower())).items() if w in vocabulary}) for t in texts]
    text, term, tf = terms.of_all(texts)
    assert list(zip(text.tolist(), term.tolist(), tf.tolist())) == [(i, w, c[w]) for i, c in enumerate(want) for w in sorted(c)]
    assert [terms.of(t) for t in texts] == want
    assert not len(toxicity.Terms({}).of_all(texts)[0])


@pytest.mark.parametrize(("long_lists", "finished"), [(0, 32), (40, 32), (512, 32), (40, 1)])
def test_lists_of_frequent_words_are_read_for_many_texts_at_once(monkeypatch, long_lists, finished):
    """The longest lists are read by a matrix product a slice, and the neighbours stay those of brute force."""
    from collections import Counter

    rng = np.random.default_rng(9)
    monkeypatch.setattr(toxicity, "LONG_LISTS", long_lists)
    monkeypatch.setattr(toxicity, "FINISHED", finished)
    # The first three are alike, so ties occur.
    counts = [Counter(rng.zipf(1.3, rng.integers(20, 300)).clip(1, 2000).tolist()) for _ in range(600)]
    counts[1] = counts[2] = counts[0]
    labels = (rng.random(600) < 0.3).astype(float)
    row = np.repeat(np.arange(600), [len(c) for c in counts])
    term, tf = np.array([(t, n) for c in counts for t, n in c.items()]).T
    vocabulary = {f"w{'abcdefghij'[i // 1000]}{'abcdefghij'[i // 100 % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}": i for i in range(2001)}
    model = toxicity.build(vocabulary, rng.uniform(0.01, 4, 2001), list(range(600)), labels, row, term, tf, {0: 420, 1: 180})
    name = {i: w for w, i in vocabulary.items()}
    texts = [" ".join(name[t] for t, n in c.items() for _ in range(n)) for c in counts[:300]] + [""]
    dense = np.zeros((600, 2001))
    for i, c in enumerate(counts):
        terms, weights = model.vector(c)
        dense[model.ids.index(i), terms] = weights
    read = []
    plain = toxicity.Lists.sums
    monkeypatch.setattr(toxicity.Lists, "sums", lambda *a: (read.append(int(a[0].sizes(a[1]).sum())), plain(*a))[1])
    found = list(model.score_all(texts))
    entries = sum(int(model.postings.sizes(np.array(list(c), dtype=np.int64)).sum()) for c in counts[:300])
    assert sum(read) < entries / 2 or long_lists < 512 or finished < 32
    for c, (_, rows, cosines) in zip(counts[:300], found):
        terms, weights = model.vector(c)
        query = np.zeros(2001)
        query[terms] = weights
        want = dense @ query
        top = np.lexsort((np.arange(600), -want.round(12)))[:15]
        assert np.allclose(cosines, want[top]) and sorted(model.ids[r] for r in rows) == sorted(model.ids[r] for r in top)
    assert found[-1][0] == model.empty_score and not len(found[-1][1])


def test_quality_of_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (9, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, labels, "doc_id", "text", "quality")
    rows = quality.score(odd, model, "text", "s").collect()
    assert len(rows) == odd.count() and all(0 <= r.s <= 1 for r in rows)
    assert quality.fit(odd, labels.limit(0), "doc_id", "text", "quality") == 0.0
    assert quality.fit(odd, labels.where("quality = 1"), "doc_id", "text", "quality") == 1.0
    assert quality.score(odd.limit(0), model, "text", "s").count() == 0
    assert quality.keep_good(odd, labels, F.lit(True)).columns == odd.columns
    taken = odd.withColumn("__quality", F.lit("mine"))
    assert quality.keep_good(taken, labels, F.lit(True)).columns == taken.columns


def test_hinge_loss_reaches_its_optimum():
    """At the optimum no dual variable can move: free ones have margin 1, zero ones at least 1, full ones at most 1."""
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 200, 30) + (100 if i % 2 else 0)) for i in range(80)]
    labels = np.arange(80) % 2
    ratios = quality.log_count_ratios(rows, labels)
    w, bias = quality.dual_coordinate_descent(rows, labels, ratios)
    margins = []
    for found, y in zip(rows, labels):
        x = ratios[found] / np.sqrt(np.square(ratios[found]).sum())
        margins.append((w[found] @ x + bias) * (1 if y else -1))
    assert min(margins) > 0


def test_secrets_of_odd_rows(odd, spark):
    model = secrets.train(secrets.made_findings(spark, 600))
    found = secrets.scan(odd.withColumn("text", F.concat_ws(" ", "text", F.lit("key = a1b2c3d4e5f6a7b8c9d0"))), model)
    assert found.count() >= odd.count()
    assert secrets.scan(odd.limit(0), model).count() == 0
    assert secrets.scan(odd.select("doc_id", "text"), model, path_column=None).where("doc_id = 1").count() == 0


def test_secrets_assigned_to_a_name(spark, make_docs):
    key = "ghp_a8Kd73kQpZx92LmNvB4tYwRs61Uc"
    lines = [
        (f"export\nAPI_KEY={key}\nDEBUG=1", key),
        ('password = "Tr0ub4dor&3"', "Tr0ub4dor&3"),
        ('secret = "QWERTyuiopASDFghjklZXCV"', "QWERTyuiopASDFghjklZXCV"),
        ('{"auth_token": "x9$kQz!p"}', "x9$kQz!p"),
        ("DB_PASSWORD=hV7#qLm2\n", "hV7#qLm2"),
        ("see /login?token=a1B2c3D4e5F6g7H8&next=home", "a1B2c3D4e5F6g7H8"),
        ("data a1B2c3D4e5F6g7H8i9== end", "a1B2c3D4e5F6g7H8i9=="),
    ]
    found = {}
    for r in secrets.scan(make_docs([(i, t, "deploy/.env") for i, (t, _) in enumerate(lines)])).collect():
        found.setdefault(r.doc_id, []).append(r)
    for i, (text, value) in enumerate(lines):
        assert [(r.candidate, r.start) for r in found[i]] == [(value, text.index(value))]
    assert all(found[i][0].secret for i in range(5))


@pytest.mark.parametrize("length", [10, 1_500, 1_000_000])
def test_secrets_of_any_length(make_docs, length):
    plain, mixed = ("a1B2c3D4e5" * (length // 10))[:length], ("a1B2&c3D4x" * (length // 10))[:length]
    cases = [
        (f'see token = "{plain}" there', plain), (f'see token = "{mixed}" there', mixed),
        (f"see password={plain} there", plain), (f"see password={mixed} there", mixed),
        (f"u?password={mixed}&name=x there", mixed), (f"see {plain} there", plain if length >= 16 else None),
    ]
    found = {}
    for r in secrets.candidates(make_docs([(i, t) for i, (t, _) in enumerate(cases)])).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.candidate, r.left, r.right))
    for i, (text, value) in enumerate(cases):
        want = [] if value is None else [(text.index(value), value)]
        assert [f[:2] for f in found.get(i, [])] == want
        for start, candidate, left, right in found.get(i, []):
            assert text[:start].endswith(left) and text[start + len(candidate) :].startswith(right)


def test_secrets_after_the_next_name_are_found(make_docs):
    text = "u?password=abc123x&token=zzz999y&amp&q=1&api_key=k&k&k&k7"
    got = [(r.start, r.candidate) for r in secrets.candidates(make_docs([(1, text)])).orderBy("start").collect()]
    assert got == [(text.index(v), v) for v in ("abc123x", "zzz999y&amp", "k&k&k&k7")]


def test_secrets_held_out_accuracy(spark):
    findings = secrets.made_findings(spark, 3000).withColumn("fold", F.pmod(F.xxhash64("candidate"), F.lit(4)))
    model = secrets.train(findings.where("fold > 0"))
    from pyspark.ml.feature import VectorAssembler

    test = secrets.with_features(findings.where("fold = 0"))
    scored = model.transform(VectorAssembler(inputCols=list(secrets.FEATURES), outputCol="features").transform(test))
    assert scored.select(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] > 0.95


def test_nearest_of_odd_vectors(spark):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]),
        (6, [float("nan"), 1.0, 0.0]), (7, [float("inf"), 1.0, 0.0]), (8, []), (9, [1.0, 2.0]), (50, [0.0, 1.0, 0.0]), (None, [1.0, 1.0, 1.0]),
    ]
    frame = spark.createDataFrame(rows, schema)
    got = sorted(tuple(r) for r in ann.search(frame, F.col("vec_id") % 50 == 0).collect())
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    assert [round(g[3], 12) for g in got] == [1.0, 1.0, 0.0, 0.0, 0.0, 0.0]
    assert ann.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.search(frame.where("vec_id = 0"), F.lit(True)).count() == 0


def test_nearest_of_tiny_vectors_and_repeated_queries(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    # The same directions at lengths whose squares vanish or overflow; query 0 stands there three times, two of them alike.
    rows += [(100 + i, (v * s).tolist()) for i, (v, s) in enumerate(zip(base[:4], (1e-200, 1e-300, 1e200, 1e-160)))]
    rows += [(0, base[0].tolist()), (0, base[7].tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.search(frame, F.col("vec_id") == 0).orderBy("query_id", "score").collect():
        got.setdefault(r["rank"], []).append((r["vec_id"], round(r["score"], 9)))
    assert sorted(got) == [1, 2, 3, 4, 5] and all(len(v) == 2 for v in got.values())
    assert {(100, 1.0), (7, 1.0)} == set(got[1])
    other = {r["query_id"]: r for r in ann.search(frame, F.col("vec_id") >= 101).where("rank = 1").collect()}
    assert {q: (r["vec_id"], round(r["score"], 9)) for q, r in other.items()} == {100 + i: (i, 1.0) for i in (1, 2, 3)}


def test_nearest_over_many_blocks(spark):
    rng = np.random.default_rng(12)
    vectors = rng.standard_normal((900, 70))
    vectors[300:600] = vectors[0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 50 == 0, query_block=7, vector_block=100).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = 0
    for query, found in got.items():
        cosine = np.round(units @ units[query], 12)
        cosine[query] = -2
        hits += len({v for _, v in found} & set(np.lexsort((np.arange(900), -cosine))[:5].tolist()))
    assert len(got) == 18 and hits / 90 >= 0.9
    assert [v for _, v in sorted(got[0])] == [300, 301, 302, 303, 304]


def test_pages_of_odd_rows(spark):
    deep = "<div>" * 3000 + "<p>deep text stands here, at last.</p>"
    rows = [
        (1, None), (2, ""), (3, "<<<>>> & &amp; <"), (4, deep), (5, "<article><p>One &lt;two&gt;\n\n three<br>four</p><p>five"),
        (6, "<script>var a = '<p>no</p>';</script><nav><a href=x>menu</a></nav>"), (6, "<p>again"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("mine")).withColumn("c0", F.lit(1))
    out = html_text.extract(frame, text_as="found")
    got = [(r.page_id, r.found, r.text, r.c0) for r in out.collect()]
    assert len(got) == len(rows) and {g[2:] for g in got} == {("mine", 1)}
    texts = dict((g[0], g[1]) for g in got[:5])
    assert texts[1] == texts[2] == "" and texts[5] == "One <two> three four\nfive"
    assert html_text.extract(frame.limit(0), text_as="found").count() == 0


@pytest.mark.parametrize(
    "html",
    [
        "<head><title>x</title><p>One two.</p><p>Three</p>",
        "<html><head><meta charset=utf-8><noscript><p>One two.</p></noscript><p>Three</p>",
        "<head><title>x</title>One two.<p>Three</p>",
        "<body><svg/><p>One two.</p><p>Three</p>",
        "<body><div><object data=a><p>One two.</p></div><p>Three</p>",
        *[f"<body><{t}{slash}><p>One two.</p><p>Three</p>" for t in ("svg", "object", "iframe", "noscript", "math") for slash in ("", "/")],
    ],
)
def test_unclosed_elements_hide_nothing(html):
    text = " ".join("".join(pieces) for _, pieces in html_text.read(html).segments)
    assert text.split() == ["One", "two.", "Three"]


def test_closed_elements_stay_unseen():
    page = html_text.read("<head><title>x</title><script>y</script></head><body><svg><title/><text>z</text></svg><p>One</p><noscript>n</noscript>")
    assert [pieces for _, pieces in page.segments] == [["One"]]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    parents = np.array([-1, 0, 0, 1, 1, 2])
    kinds = rng.integers(0, 3, 6)
    unary, pair = rng.standard_normal(6), rng.standard_normal((3, 2, 2))
    weights = np.zeros(64)
    for state in range(64):
        y = [state >> i & 1 for i in range(6)]
        weights[state] = sum(unary[i] * y[i] for i in range(6)) + sum(pair[kinds[i]][y[parents[i]], y[i]] for i in range(1, 6))
    chance = np.exp(weights) / np.exp(weights).sum()
    node, both, log_z = html_text.marginals(unary, pair, parents, kinds)
    assert log_z == pytest.approx(np.log(np.exp(weights).sum()))
    for i in range(6):
        assert node[i] == pytest.approx(sum(c for s, c in enumerate(chance) if s >> i & 1))
        if i:
            for a in (0, 1):
                for b in (0, 1):
                    want = sum(c for s, c in enumerate(chance) if s >> parents[i] & 1 == a and s >> i & 1 == b)
                    assert both[i, a, b] == pytest.approx(want)


def test_main_text_of_pages_not_trained_on():
    model = html_text.default_model()
    wrong = total = 0
    for page in labelled_pages.pages(90, seed=99):
        parsed = html_text.read(page)
        truth, main = html_text.labels(parsed), model.main(parsed)
        for node, _ in parsed.segments:
            total += 1
            wrong += (main[node] >= 0.5) != truth[node]
    assert wrong / total < 0.02


def test_unmatched_end_tags_take_linear_time():
    import time

    begin = time.process_time()
    page = html_text.read("<p>" + "<span>x " * 30_000 + "</b>" * 30_000 + "</p><p>end</p>")
    assert time.process_time() - begin < 10
    assert sum(node.words for node in page.nodes) == 30_001


def test_components_end_with_stars(spark, monkeypatch):
    """Links that are stars take no round, others no round beyond the one that makes them stars; roots are the least nodes.
    Of what the rounds write only the last stays."""
    from tidemark.llm import links

    written = []
    plain = links.cut_lineage

    def kept(df):
        out = plain(df)
        written.append(Path(out.inputFiles()[0].removeprefix("file:")).parent)
        return out

    monkeypatch.setattr(links, "cut_lineage", kept)
    rng = random.Random(4)
    path = [(i, i + 1) for i in range(40)]
    stars = [(9, 2), (7, 2), (7, 2), (5, -1), (6, 6)]
    tangle = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    for pairs, most in ((stars, 1), ([], 1), ([(3, 2), (2, 1)], 2), (path, 8), (tangle, 8)):
        root = {x: x for p in pairs for x in p if p[0] != p[1]}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            if a != b:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
        written.clear()
        got = links.components(spark.createDataFrame(pairs, "a long, b long")).collect()
        assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in root)
        assert len(written) <= most
        assert [p.exists() for p in written] == [False] * (len(written) - 1) + [True]


def held_mb():
    """Memory of this process alone, without mapped files."""
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(line.split()[1]) for line in f if line.startswith("Pss_Anon:")) / 1024


def test_freed_memory_goes_back():
    """Also where a small piece above what was freed is still held, which keeps it from going by itself."""
    from tidemark.llm.common import release_memory

    release_memory()
    before = held_mb()
    pieces = [bytes(60_000) for _ in range(2000)] + [b"x" * 600]
    pieces = [p for p in map(bytearray, pieces)]
    assert held_mb() - before > 100
    del pieces[:-1]
    release_memory()
    assert held_mb() - before < 20


def test_index_of_toxicity_is_built_in_little_more_than_it_takes():
    """Block maxima come from the lists as they lie: no sort of all entries, which took 75 bytes an entry at the peak."""
    rng = np.random.default_rng(8)
    n, words, each = 2000, 60_000, 300
    row = np.repeat(np.arange(n, dtype=np.int32), each)
    term = np.concatenate([rng.choice(words, each, replace=False) for _ in range(n)]).astype(np.int32)
    tf, labels = rng.integers(1, 4, len(term)).astype(np.int32), (np.arange(n) % 2).astype(float)
    vocabulary, weights = {f"w{i}": i for i in range(words)}, rng.uniform(0.1, 3, words)
    tracemalloc.start()
    try:
        model = toxicity.build(vocabulary, weights, list(range(n)), labels, row, term, tf, {0: n // 2, 1: n // 2})
        assert tracemalloc.get_traced_memory()[1] < 55 * len(term)
    finally:
        tracemalloc.stop()
    # The maxima, one by one.
    lists, blocks = model.postings, {}
    for t in range(0, words, 50):
        for k in range(lists.starts[t], lists.starts[t + 1]):
            at = (t, int(lists.numbers[k]) // toxicity.BLOCK_ROWS)
            blocks[at] = max(blocks.get(at, 0.0), lists.weights[k])
    peaks = model.peaks
    for t in range(0, words, 50):
        a, b = peaks.starts[t], peaks.starts[t + 1]
        assert {(t, int(x)): w for x, w in zip(peaks.numbers[a:b], peaks.weights[a:b])} == {k: w for k, w in blocks.items() if k[0] == t}


def test_the_driver_keeps_no_model_of_toxicity(spark, make_docs, monkeypatch):
    """What fitting freed goes back before the model is written for the tasks, and the model once it is."""
    models, held = [], []
    plain, build = toxicity.release_memory, toxicity.build

    def built(*args):
        model = build(*args)
        models.append(weakref.ref(model))
        return model

    monkeypatch.setattr(toxicity, "build", built)
    monkeypatch.setattr(toxicity, "release_memory", lambda: (held.append(models[-1]() is not None), plain()))
    docs = make_docs([(i, f"word{'ab'[i % 2]} other text") for i in range(20)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    kept = toxicity.reject_toxic(docs, labels, F.lit(True))
    assert held == [True, False]
    assert {r.doc_id % 2 for r in kept.collect()} == {0}
