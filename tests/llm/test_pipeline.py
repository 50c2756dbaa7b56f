"""Each stage of the pipeline against a brute-force version of its rule, on the smallest documents with odd rows."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gamegrain.llm import near, quality


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", None, "x", 1)], docs.schema)
    extra = [F.lit(1).alias(n) for n in ("kept", "keep", "digest", "_row", "class_id", "score")]
    return docs.unionByName(docs.limit(5)).unionByName(odd).select("*", *extra).checkpoint()


def run(spark, docs, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    return stage(spark, docs, sf_dir)


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "best-fit packing"]


def test_stages_keep_the_columns(spark, docs, sf_dir):
    rows = [tuple(r) for r in docs.collect()]
    low = {}
    for name in ("quality classifier", "exact dedup", "near dedup"):
        out = run(spark, docs, sf_dir, name)
        assert out.columns == docs.columns
        low[name] = [tuple(r) for r in out.collect()]
        assert not Counter(low[name]) - Counter(rows)

    def key(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")

    want = {}
    for r in rows:
        want[key(r[1])] = max(want.get(key(r[1]), -1), -1 if r[0] is None else r[0])
    assert Counter((key(r[1]), r[0]) for r in low["exact dedup"]) == Counter(want.items())
    shingles = near.Shingles()
    kept = [shingles(r[1] or "") for r in low["near dedup"]]
    assert all(near.similarity(a, b) == 0 for i, a in enumerate(kept) for b in kept[:i])
    every = [shingles(r[1] or "") for r in rows]
    assert len(kept) < len(every)


def plain_near_classes(rows):
    """All pairs: which rows links connect."""
    shingles = near.Shingles()
    grams = [shingles(r[1] or "") for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if np.array_equal(grams[i], grams[j]) or near.similarity(grams[i], grams[j]) > 0:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_near_dedup_keeps_one_of_each_class(spark, docs, sf_dir):
    rows = [tuple(r) for r in docs.collect()]
    classes = {}
    for row, label in zip(rows, plain_near_classes(rows), strict=True):
        classes.setdefault(label, []).append(row)
    want = [min(members, key=lambda r: (r[0] is None, r[0] or 0)) for members in classes.values()]
    kept = [tuple(r) for r in run(spark, docs, sf_dir, "near dedup").collect()]
    assert Counter(r[0] for r in kept) == Counter(r[0] for r in want) and not Counter(kept) - Counter(rows)


def test_quality_keeps_what_the_classifier_keeps(spark, docs, sf_dir):
    """The classifier is held against its definition in test_quality; the stage drops exactly what that rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    decided = Counter(r.doc_id for r in quality.classify(docs, labels).where("keep").collect())
    assert Counter(r[0] for r in run(spark, docs, sf_dir, "quality classifier").collect()) == decided


def test_packing_holds_every_token_once(spark, docs, sf_dir):
    """Pieces by a plain encoder; places without gap or overlap, and as few sequences as the simple bound allows + 5 %."""
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for row in docs.collect():
        ids = [*coder.encode(row.text or "", add_special_tokens=False).ids, 1]
        want.update((row.doc_id, at // 4096, at, len(ids[at : at + 4096])) for at in range(0, len(ids), 4096))
    out = run(spark, docs, sf_dir, "best-fit packing").collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in out) == want
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        ends = [0, *(at + n for at, n in sorted(pieces))]
        assert [at for at, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 4096
    assert len(places) <= 1.05 * -(-sum(r.length for r in out) // 4096) + 1


def test_stages_of_no_documents(spark, docs, sf_dir):
    for name, _ in corpus_pipeline.STAGES:
        assert run(spark, docs.limit(0), sf_dir, name).count() == 0


def test_whole_pipeline(spark, sf_dir):
    """Each stage works on what the one before has kept, so the documents packed are those of the stages by hand."""
    out = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(r.doc_id for r in docs.select("doc_id").collect())
