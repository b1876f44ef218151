"""The registered queries of the subpackage: SQL where there is some, brute force where there is none."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry_module
import check
from tidemark.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    ok, note = check.compare(spark, check.connect(SF_DIR), SF_DIR, name)
    assert ok, note


def test_all_thirteen_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert "pipeline" in entry_module.queries()


def test_nearest_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], dtype=float)
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    found = {}
    for r in queries.QUERIES["op1_nearest"](spark, SF_DIR).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 50 == 0)
    hits = 0
    for query, got in found.items():
        at = int(np.flatnonzero(ids == query)[0])
        cosine = units @ units[at]
        cosine[at] = -2
        best = np.lexsort((ids, -cosine))[:5]
        got.sort()
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        for _, vec, score in got:
            assert score == pytest.approx(float(cosine[ids == vec][0]), abs=1e-12)
        hits += len({g[1] for g in got} & set(ids[best].tolist()))
    assert hits / (5 * len(found)) >= 0.9


def test_repeats_against_brute_force(spark, documents):
    seen, want = set(), {}
    for i in sorted(documents):
        data = (documents[i].text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                mark[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, m in zip(data, mark) if not m)
        spans = sum(1 for p in range(len(mark)) if mark[p] and (p == 0 or not mark[p - 1]))
        want[i] = (len(data), sum(mark), spans, hashlib.sha256(kept).hexdigest())
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in queries.QUERIES["op2_repeats"](spark, SF_DIR).collect()
    }
    assert got == want
    assert sum(w[1] for w in want.values()) > 0


def test_packing_is_whole_and_tight(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {i: [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1] for i, d in documents.items()}
    rows = queries.QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect()
    covered, sequences = {}, {}
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length
        assert zlib.crc32(np.array(piece, dtype="<u4").tobytes()) == r.ids_crc32
        covered.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(covered) == sorted(ids)
    for i, pieces in covered.items():
        pieces.sort()
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert [p[1] for p in pieces] == [4096 * k for k in range(len(pieces))]
        assert sum(p[2] for p in pieces) == len(ids[i])
    for places in sequences.values():
        places.sort()
        assert places[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(places, places[1:]))
        assert places[-1][0] + places[-1][1] <= 4096
    total = sum(map(len, ids.values()))
    assert len(sequences) <= -(-total // 4096) * 1.03 + 1


def test_simhash_against_brute_force(spark, documents):
    prints = {}
    for i, d in documents.items():
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in d.text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        n = min(3, len(words))
        shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) and hashes)
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(prints)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op7_simhash"](spark, SF_DIR).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in order}


@pytest.mark.parametrize(("name", "label", "least"), [("op6_toxicity", "toxic", 0.93), ("op10_quality", "quality", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, folder).collect()
    modulus, kept, limit = (5, 0, 0.5) if label == "toxic" else (4, 2, 0.7)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == kept) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= limit) for r in rows)
    judged = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in judged) / len(judged) >= least


def test_main_text_of_all_pages(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in queries.QUERIES["op3_main_text"](spark, SF_DIR).collect():
        # The pages at hand mark their article; the operator has to find it without knowing that.
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)
        assert r.text == want and r.n_chars == len(want)


def test_secrets_find_the_assigned_tokens(spark, documents):
    found = queries.QUERIES["op4_secrets"](spark, SF_DIR.replace("sf0.001", "sf0.01")).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/documents.parquet").collect()}
    got = {(r.doc_id, r.start) for r in found if r.secret}
    want = {(i, m.start(1)) for i, t in texts.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t or "")}
    assert want and got == want
    for r in found:
        piece = texts[r.doc_id][r.start : r.start + r.length]
        assert hashlib.sha256(piece.encode()).hexdigest() == r.candidate_sha256
