"""The pipeline's stages, each against a plain version on its own input."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from loam.llm import mixing, simhash
from tests_llm_helpers import brute_components, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        got = spark.read.parquet(path)
        out.append((name, docs, got))
        docs = got
    return out


def test_names_and_columns(stages):
    assert [s[0] for s in stages] == ["quality", "dedup", "secrets", "mixing", "packing"]
    assert all(got.columns == before.columns for _, before, got in stages[:-1])


def test_quality_keeps_good_documents(spark, stages):
    _, before, got = stages[0]
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in got.collect()}
    assert kept <= {r["doc_id"] for r in before.collect()}
    assert np.mean([(d in kept) == bool(q) for d, q in good.items()]) > 0.9


def test_dedup(stages):
    _, before, got = stages[1]
    label = brute_components({r["doc_id"]: r["text"] for r in before.collect()}, simhash.NEAR_COPIES)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(label.values()))


def test_secrets_are_masked(stages):
    _, before, got = stages[2]
    after = {r["doc_id"]: r["text"] for r in got.collect()}
    token = re.compile(r'(?i)(token = ")[0-9a-f]{40}(?=")')
    for r in before.collect():
        assert after[r["doc_id"]] == token.sub(r"\1<SECRET>", r["text"])
    assert got.count() == before.count()


def test_mixing(stages):
    _, before, got = stages[3]
    sizes, text = defaultdict(int), {}
    for r in before.collect():
        sizes[r["source"]] += len(words_of(r["text"]))
        text[r["doc_id"]] = r["text"]
    rows, taken = got.collect(), Counter()
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
    for r in rows:
        assert r["text"] == text[r["doc_id"]]
        taken[r["source"]] += len(words_of(r["text"]))
    largest = max(len(words_of(t)) for t in text.values())
    assert all(abs(taken[s] - t) <= largest for s, t in mixing.targets(dict(sizes)).items())


def test_packing(stages):
    _, before, got = stages[4]
    encode = Tokenizer.from_file(corpus_pipeline.TOKENIZER).encode
    times, ids = Counter(), {}
    for r in before.collect():
        times[r["doc_id"]] += 1
        ids[r["doc_id"]] = np.array([*encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
    seen = {d: np.zeros(len(x), int) for d, x in ids.items()}
    for r in got.collect():
        part = slice(r["start"], r["start"] + r["length"])
        assert zlib.crc32(ids[r["doc_id"]][part].tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]][part] += 1
    assert all((x == times[d]).all() for d, x in seen.items())


def test_run_applies_the_stages(spark, stages):
    key = lambda df: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    whole = corpus_pipeline.run(spark, SF)
    total = lambda c: sum(n * k[2] for k, n in c.items())
    assert total(key(whole)) == total(key(stages[-1][2]))
