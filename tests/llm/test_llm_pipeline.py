"""Every stage of the pipeline against a plain version of itself, on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import toxicity
from tidemark.llm.common import remainder
from tidemark.llm.queries import tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(Path(folder) / name))
        docs = out[name] = spark.read.parquet(str(Path(folder) / name))
    return out


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns_stay(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "pack"]
    for name in ("toxicity", "exact_dedup", "near_dedup", "mix"):
        assert stages[name].columns == DOCUMENT


def test_toxic_documents_go(stages, spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(remainder(F.col("doc_id"), 5) != 0)
    model = toxicity.fit(stages["input"], labels, "doc_id", "text", "toxic")
    want = {i for i, r in rows(stages["input"]).items() if model.score(r.text or "")[0] < 0.5}
    assert set(rows(stages["toxicity"])) == want


def test_exact_copies_go(stages):
    first = {}
    for i, r in sorted(rows(stages["toxicity"]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), i)
    assert set(rows(stages["exact_dedup"])) == set(first.values())


def test_near_copies_go(stages):
    """Fingerprints and links worked out document by document, without the operator's own functions."""

    def fingerprint(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(3, len(words))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42) for k in range(len(words) - n + 1)] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: fingerprint(r.text) for i, r in rows(stages["exact_dedup"]).items()}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(prints)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(rows(stages["near_dedup"])) == {i for i in order if find(i) == i}


def test_the_mix_is_the_start_of_the_weighted_queue(stages):
    docs = rows(stages["near_dedup"])
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in docs.items()}
    sources = sorted({r.source for r in docs.values()}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    served = []
    for place, s in enumerate(sources):
        own = [i for i, r in docs.items() if r.source == s]
        own.sort(key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), size[i], i))
        total, upto = sum(size[i] for i in own), 0
        for i in own:
            upto += size[i]
            served += [((k * total + upto) / weight[s], place, k, hashlib.md5(str(i).encode()).hexdigest(), i) for k in range(3)]
    budget, want = sum(size.values()), Counter()
    for _, _, _, _, i in sorted(served):
        budget -= size[i]
        if budget < 0:
            break
        want[i] += 1
    assert Counter(r.doc_id for r in stages["mix"].collect()) == want


def test_packing_holds_every_mixed_document(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in stages["mix"].collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            piece = b"".join(i.to_bytes(4, "little") for i in ids[at : at + 4096])
            want[(r.doc_id, k, at, len(piece) // 4, zlib.crc32(piece))] += 1
    got, bins = Counter(), {}
    for r in stages["pack"].collect():
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for places in bins.values():
        places.sort()
        assert places[0][0] == 0 and places[-1][0] + places[-1][1] <= 4096
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))


def test_run_gives_the_last_stage(stages, spark):
    got = Counter(tuple(r[c] for c in ("doc_id", "piece", "length")) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == Counter(tuple(r[c] for c in ("doc_id", "piece", "length")) for r in stages["pack"].collect())
