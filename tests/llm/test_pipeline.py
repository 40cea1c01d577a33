"""The corpus pipeline against a plain version of its stages."""

import hashlib
import random

import public_tokenizers as tokenizers
import pytest
from test_operators import brute_fingerprint, brute_windows

import corpus_pipeline
from transitloom.llm import bpe, quality
from transitloom.llm.queries import RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain(rows, good, items):
    """Ids and texts after the stages, of documents that the classifier keeps."""
    kept = [(i, t) for i, t in rows if (i, t) in good]
    words = [(t or "").lower().split() for _, t in kept]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    fp = [brute_fingerprint(t) for _, t in kept]
    group = [i for i, _ in kept]
    for _ in kept:
        for a in range(len(kept)):
            for b in range(len(kept)):
                if (fp[a] ^ fp[b]).bit_count() <= 2 or sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    kept = [(i, t) for (i, t), g in zip(kept, group, strict=True) if i == g]
    hit = {d for d, _ in brute_windows([t or "" for _, t in kept], items, 0.8)}
    kept = [x for d, x in enumerate(kept) if d not in hit]
    return [(i, (t or "").replace("password=hunter2Zq81x7", "password=[SECRET]")) for i, t in kept]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(6)
    folder = tmp_path_factory.mktemp("corpus")
    vocabulary = [f"w{k}" for k in range(300)]
    base = [" ".join(r.choices(vocabulary, k=r.randrange(60, 140))) for _ in range(30)]
    items = [" ".join(r.choices(vocabulary, k=40)) for _ in range(2)]
    texts = [*base, *base[:4], *(t + " tail" for t in base[4:8]), f"{base[8]} {items[0]}", base[9] + " password=hunter2Zq81x7 end", "", None, "||| !!! ###"]
    rows = list(enumerate(texts))
    spark.createDataFrame([(i, t, None, f"s{i % 2}", len(t or "")) for i, t in rows], SCHEMA).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(i, int(i < 30), 0) for i in range(len(rows))], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), rows, items


def test_pipeline_like_a_plain_run(spark, corpus):
    folder, rows, items = corpus
    scored = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    good = {x["doc_id"] for x in scored.filter("predicted = 1").collect()}
    want = plain(rows, {(i, t) for i, t in rows if i in good}, items)
    got = corpus_pipeline.run(spark, folder).collect()
    enc = bpe.encoder(tokenizers.path(RANKS), tokenizers.PATTERN)
    assert {x["doc_id"]: (x["n_tokens"], x["decoded_sha256"]) for x in got} == {i: (len(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in want}
    assert len(got) == len(want) < len(rows)


def test_stages_on_an_empty_table_and_its_columns(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
