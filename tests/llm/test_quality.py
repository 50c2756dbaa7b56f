"""The Kneser-Ney tables sum to one, and the classifier keeps good text and drops junk."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamegrain.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, perplexity string, keep int"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(4)
    parts = ("th", "er", "on", "re", "at", "es", "ly", "ou", "in")
    words = ["the", "of", "and", "a", "in"] + [a + b + c for a in parts for b in parts for c in parts]

    def good(n):
        return " ".join(rng.choices(words, weights=[150] * 5 + [1] * 729, k=n)) + "."

    rows = [(i, good(rng.randint(3, 80)), "en", "s", "x", 0) for i in range(600)]
    junk = [(1000 + i, " ".join(w.upper() + "###" for w in good(40).split()), "en", "s", None, None) for i in range(20)]
    junk += [(1100 + i, " ".join([rng.choice(words)] * 50), "en", "s", None, None) for i in range(20)]
    odd = [(2000, None, None, None, None, None), (2001, "", "xx", "s", None, None), (None, good(50), "en", "s", None, None)]
    odd += [(2002, good(40_000), "zz", "s", None, None)] * 2
    docs = spark.createDataFrame(rows + junk + odd, SCHEMA).repartition(3)
    labels = [(i, 1, 0) for i in range(600)] + [(1000, 0, 0), (1001, 0, 1), (7, 1, 0), (None, 1, 0), (5, None, None)]
    return docs, spark.createDataFrame(labels, LABELS)


def test_every_context_sums_to_one(data):
    model = quality.fit(*data)["en"]
    ids = np.arange(len(model.first))
    assert abs(model.first.sum() - 1) < 1e-9
    rng = np.random.default_rng(1)
    seen = rng.choice(model.contexts3, 20)
    for context in [*seen.tolist(), (1 << quality.BITS) + 1, (7 << quality.BITS) + 0]:
        a, b = context >> quality.BITS, context & ((1 << quality.BITS) - 1)
        p = model.probability(np.full(len(ids), a), np.full(len(ids), b), ids)
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_keeps_good_and_drops_junk(data):
    out = quality.classify(*data)
    rows = out.collect()
    assert len(rows) == 600 + 40 + 5
    kept = {r.doc_id for r in rows if r.keep}
    assert set(range(600)) <= kept and None in kept and 2002 in kept
    assert not kept & set(range(1000, 1200))
    assert sum(r.doc_id == 2002 for r in rows) == 2
    again = {(r.doc_id, r.perplexity) for r in quality.classify(*data).collect()}
    assert again == {(r.doc_id, r.perplexity) for r in rows}


def test_empty_tables(spark, data):
    docs, labels = data
    assert quality.classify(docs.limit(0), labels).count() == 0
    rows = quality.classify(docs, labels.limit(0)).collect()
    assert len(rows) == 645 and all(r.keep and r.perplexity is None for r in rows)


def test_unknown_words_do_not_predict_each_other(spark, data):
    docs, labels = data
    ids = quality.trusted_rows(labels).where("fit").orderBy("doc_id").limit(1).collect()[0].doc_id
    number = F.when(F.col("doc_id") == ids, F.concat("text", F.lit(" +1 (887) 555-2355"))).otherwise(F.col("text"))
    rng = random.Random(5)
    junk = [(3000 + i, " ".join(f"{chr(97 + rng.randrange(26)) * rng.randint(2, 9)}***" for _ in range(60)), "en", "s", None, None)
            for i in range(20)]
    docs = docs.withColumn("text", number).unionByName(spark.createDataFrame(junk, SCHEMA))
    model = quality.fit(docs, labels)["en"]
    text = "+1 (887) 555-2355".split()
    assert quality.word_ids(text, model.words, {}).tolist()[2:-1] == [quality.UNKNOWN] * 3
    unknown = np.zeros(1, np.int64)
    assert model.probability(unknown, unknown, unknown)[0] == model.first[quality.UNKNOWN] < 0.01
    n = len(model.first)
    assert abs(model.probability(np.full(n, 9), np.zeros(n, np.int64), np.arange(n)).sum() - 1) < 1e-9
    kept = {r.doc_id for r in quality.classify(docs, labels).where("keep").select("doc_id").collect()}
    assert set(range(600)) <= kept and not kept & set(range(3000, 3020))


def plain_discounts(counts):
    n1, n2, n3, n4 = (sum(n == i for n in counts.values()) for i in range(1, 5))
    if not n1:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    cuts = [(i, i - (i + 1) * y * upper / lower if lower else 0.5 * i) for i, upper, lower in ((1, n2, n1), (2, n3, n2), (3, n4, n3))]
    return [max(min(cut, 0.95 * i), 0.05) for i, cut in cuts]


def plain_model(sequences, size):
    """P(c | a b) straight from the definition: counts, continuation counts, three discounts, interpolation."""
    tri = Counter(t for ids in sequences for t in zip(ids, ids[1:], ids[2:], strict=False))
    bi = Counter((b, c) for _, b, c in tri)
    uni = Counter((c,) for _, c in bi)

    def order(counts, below, blocked):
        cuts, total, freed = plain_discounts(counts), Counter(), Counter()
        for gram, n in counts.items():
            total[gram[:-1]] += n
            freed[gram[:-1]] += cuts[min(n, 3) - 1]

        def p(*gram):
            context = gram[:-1]
            if blocked and quality.UNKNOWN in context or not total[context]:
                return below(*gram[1:])
            n = counts[gram]
            own = (n - cuts[min(n, 3) - 1]) / total[context] if n else 0.0
            return own + freed[context] / total[context] * below(*gram[1:])

        return p

    first = order(uni, lambda *_: 1 / size, False)
    return order(tri, order(bi, first, True), True)


def test_tables_are_those_of_the_definition(data):
    model = quality.fit(*data)["en"]
    texts = [r.text for r in quality.fit_sample(*data, quality.SAMPLE).where("lang = 'en'").collect()]
    sequences = [quality.word_ids(text.split(), model.words, {}).tolist() for text in texts]
    p = plain_model(sequences, len(model.first))
    rng = random.Random(2)
    seen = sorted({t for ids in sequences for t in zip(ids, ids[1:], ids[2:], strict=False)})
    ids = [*range(len(model.first))]
    wanted = rng.sample(seen, 2_000) + [tuple(rng.choices(ids, k=3)) for _ in range(1_000)]
    wanted += [(a, b, rng.choice(ids)) for a, b, _ in rng.sample(seen, 1_000)] + [(0, 5, 9), (5, 0, 9), (0, 0, 0)]
    a, b, c = (np.array(x) for x in zip(*wanted, strict=True))
    assert np.allclose(model.probability(a, b, c), [p(*t) for t in wanted], rtol=1e-9, atol=0)


def test_thresholds_are_quantiles(data):
    """Scores and limits from the perplexities, by their definition, over the trusted rows that the model has not seen."""
    docs, labels = data
    rows = quality.classify(docs, labels).collect()
    unseen = {r.doc_id for r in quality.trusted_rows(labels).where("NOT fit").collect()}
    trusted = [r for r in rows if r.doc_id in unseen]
    loss = {id(r): math.log(r.perplexity) * r.n_tokens for r in rows}
    mean = sum(loss[id(r)] for r in trusted) / sum(r.n_tokens for r in trusted)
    score = {id(r): math.exp((loss[id(r)] + quality.PRIOR * mean) / (r.n_tokens + quality.PRIOR)) for r in rows}
    english = [r for r in rows if r.lang == "en"]
    assert all(math.isclose(r.score, score[id(r)], rel_tol=1e-9) for r in english)
    ordered = sorted(score[id(r)] for r in trusted)
    limit = ordered[math.ceil(quality.QUANTILE * len(ordered)) - 1] * quality.SLACK
    assert all(math.isclose(r.threshold, limit, rel_tol=1e-9) and r.keep == (r.score <= r.threshold) for r in english)


def test_languages_with_a_model_are_bounded(data, monkeypatch):
    docs, labels = data
    monkeypatch.setattr(quality, "LANGUAGES", 2)
    many = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit("en")).otherwise(F.concat(F.lit("x"), F.col("doc_id") % 40)))
    models = quality.fit(many, labels)
    assert len(models) == 3 and {"en", quality.POOLED} <= set(models)
    out = quality.classify(many, labels).collect()
    assert len(out) == docs.count() and sum(r.keep for r in out if r.doc_id is not None and r.doc_id < 600) > 590


def test_all_trusted_documents_are_counted(spark):
    """Of 2,400 trusted documents those of one half are in the model's counts, not some of each language."""
    rows = [(i, f"w{i % 7} w{i % 11}", "en", "s", None, None) for i in range(2_400)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, 1, 0) for i in range(2_400)], LABELS)
    half = [r.doc_id for r in quality.trusted_rows(labels).where("fit").collect()]
    assert len(half) > 1_000 and quality.fit_sample(docs, labels).count() == len(half)
    models, tri = quality.fit_tables(docs, labels)
    starts = tri.where(f"lang = 'en' AND k >> {quality.BITS} = {quality.START << quality.BITS | quality.START}")
    counted = {r.k & (1 << quality.BITS) - 1: r.n for r in starts.collect()}
    assert counted == Counter(models["en"].words[f"w{i % 7}"] for i in half)


def test_joined_scores_are_those_of_the_whole_model(data, monkeypatch):
    """Shards, packing and joins give what one dictionary with all trigrams gives, repeated and NULL rows included."""
    monkeypatch.setattr(quality, "SHARD_ROWS", 300)
    monkeypatch.setattr(quality, "HELD_ROWS", 50)
    docs, labels = data
    models = quality.fit(docs, labels)
    wanted = Counter()
    for row in docs.collect():
        model, words = models.get(row.lang, models[quality.POOLED]), (row.text or "").split()
        ids = quality.word_ids(words, model.words, {})
        loss = model.spelling(words, ids) - np.log(model.probability(ids[:-2], ids[1:-1], ids[2:])).sum()
        wanted[row.doc_id, len(ids) - 2, round(float(np.exp(loss / (len(ids) - 2))), 4)] += 1
    rows = quality.classify(docs, labels, F.struct("source").alias("more")).collect()
    assert Counter((r.doc_id, r.n_tokens, round(r.perplexity, 4)) for r in rows) == wanted
    assert all(r.more.source in ("s", None) for r in rows)




def test_rare_trigrams_are_joined_and_frequent_ones_broadcast(data, monkeypatch):
    """Whatever is broadcast, scores are the same; the answers to a pack of texts are one row for a shard, not one for a text."""
    docs, labels = data
    wanted = {(r.doc_id, r.n_tokens): r.perplexity for r in quality.classify(docs, labels).collect()}
    for hot in (0, 400):
        monkeypatch.setattr(quality, "HOT", hot)
        monkeypatch.setattr(quality, "SHARD_ROWS", 300)
        models, tri = quality.fit_tables(docs, labels)
        n, others = tri.count(), quality.with_hot(models, tri)
        held = sum(len(model.hot3) for model in models.values())
        assert held <= hot and others.count() == n - held and (held > 0) == (hot > 0)
        rows = quality.classify(docs, labels).collect()
        assert all(math.isclose(r.perplexity, wanted[r.doc_id, r.n_tokens], rel_tol=1e-7) for r in rows)


def test_pairs_are_found_by_bits():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 70, 900) << quality.BITS | rng.integers(0, 70, 900))
    pairs = quality.Pairs(rng.permutation(keys), 70)
    assert (pairs.keys() == keys).all()
    wanted = np.arange(70).repeat(70) << quality.BITS | np.tile(np.arange(70), 70)
    at, hit = pairs.places(wanted)
    assert (hit == np.isin(wanted, keys)).all() and (keys[at[hit]] == wanted[hit]).all()
    values, there = quality.Pairs(keys[:0], 70).look(np.zeros(0), wanted, np.ones(len(wanted)))
    assert (values == 1).all() and not there.any()


def test_kept_rows_are_those_of_the_classifier(data):
    docs, labels = data
    rows = quality.classify(docs, labels).where("keep").collect()
    found = quality.kept(docs, labels, F.col("doc_id").alias("id"), F.col("source"))
    assert found.columns == ["id", "source"]
    assert Counter(r.id for r in found.collect()) == Counter(r.doc_id for r in rows)


def test_trusted_texts_are_not_shuffled_whole(spark, data):
    """Texts that nobody trusts do not reach the join with the labels; what a filter lets through wrongly is taken out."""
    from gamegrain.llm import common

    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias(common.ROW))
    keys = rows.where("doc_id % 40 = 0").select("doc_id")
    some, none = (common.likely(rows, keys, "doc_id", how) for how in ("left_semi", "left_anti"))
    assert some.join(keys, "doc_id").count() == 1_000 and 1_000 <= some.count() < 1_100
    assert some.count() + none.count() == 40_000
    docs, labels = data
    twice = docs.where("doc_id = 7 OR doc_id IS NULL")
    sample = quality.fit_sample(docs.unionByName(twice), labels.unionByName(labels))
    half = {r.doc_id for r in quality.trusted_rows(labels).where("fit").collect()}
    assert sample.count() == len(half)


def test_counts_of_trigrams_travel_packed(spark):
    """Counts go to their parts in a few bytes each, and come back as they were."""
    keys = np.unique(np.random.default_rng(3).integers(0, 2_000, (100_000, 3)) @ [1 << 2 * quality.BITS, 1 << quality.BITS, 1])
    counts = np.arange(len(keys)) % 5 + 1
    rows = quality._pack_counts("en", keys, counts, keys % 3)
    assert [row[:2] for row in rows] == [("en", 0), ("en", 1), ("en", 2)]
    assert sum(len(row[3]) + len(row[4]) for row in rows) < 5 * len(keys)
    names = [column.split()[0] for column in quality.COUNTS.split(", ")]
    found = quality._unpack_counts(quality.pd.DataFrame(rows, columns=names))
    assert dict(zip(*found, strict=True)) == dict(zip(keys, counts, strict=True))


def test_ids_that_no_joined_trigram_needs_are_not_stored(data, monkeypatch):
    docs, labels = data
    monkeypatch.setattr(quality, "HOT", 20)
    models, tri = quality.fit_tables(docs, labels)
    quality.with_hot(models, tri)
    rows = quality.coded(docs, models, docs.sparkSession.sparkContext.broadcast(models)).collect()
    some = 0
    for row in rows:
        ids = np.frombuffer(row.ids, "<u2")
        asked = np.nonzero(np.unpackbits(np.frombuffer(row.asked, np.uint8), count=len(ids) - 2))[0]
        needed = {at + shift for at in asked.tolist() for shift in range(3)}
        assert not {at for at in range(len(ids)) if ids[at]} - needed
        some += len(needed)
    assert some


def test_rare_words_are_counted_as_themselves(data, monkeypatch):
    """Every repeated word is in the vocabulary, not some of them; how many words have their pairs held changes no score."""
    docs, labels = data
    models, _ = quality.fit_tables(docs, labels, words=10)
    model, whole = models["en"], quality.fit(docs, labels)["en"]
    assert len(model.words) <= 20 and model.words.size == whole.words.size == len(model.first) and model.sign == whole.sign
    texts = quality.fit_sample(docs, labels).where("lang = 'en'").collect()
    repeated = [word for word, n in Counter(word for row in texts for word in row.text.split()).items() if n > 1]
    ids = quality.word_ids(repeated[::7], model.words, {})[2:-1]
    assert len(repeated) > 500 and len({*ids.tolist()}) == len(ids) and (ids != quality.UNKNOWN).all()
    wanted = Counter((r.doc_id, r.n_tokens, round(r.perplexity, 4), r.keep) for r in quality.classify(docs, labels).collect())
    for hot, held in ((50, 10), (0, 3)):
        monkeypatch.setattr(quality, "HOT", hot)
        monkeypatch.setattr(quality, "SHARD_ROWS", 900)
        rows = quality.classify(docs, labels, words=held).collect()
        assert Counter((r.doc_id, r.n_tokens, round(r.perplexity, 4), r.keep) for r in rows) == wanted


def test_ids_of_any_size_are_counted():
    """Vocabularies of more words than a key has bits for: what it leaves out is kept beside it."""
    rng = np.random.default_rng(5)
    words = np.array([1, 2, 77, (1 << quality.BITS) + 77, 9 << quality.BITS, (1 << 31) - 1])
    a, b, c = words[rng.integers(0, len(words), (3, 900))]
    keys, high = quality.keys_of(a, b, c)
    assert all((x == y).all() for x, y in zip(quality.parts_of(keys, high), (a, b, c), strict=True))
    tri = Counter(zip(a.tolist(), b.tolist(), c.tolist(), strict=True))
    x, y, z, facts = quality._sum_contexts(a, b, c, np.ones(900, np.int64))
    found = [*zip(x.tolist(), y.tolist(), z.tolist(), strict=True)]
    assert dict(zip(found, facts["n"].tolist(), strict=True)) == tri
    after, times = quality._sum_pairs(y, z, facts["n"])
    for i, (p, q, r) in enumerate(found):
        behind = [n for t, n in tri.items() if t[:2] == (p, q)]
        assert [facts[name][i] for name in ("ones", "twos", "kinds")] == [behind.count(1), behind.count(2), len(behind)]
        assert after[i] == sum(t[1:] == (q, r) for t in tri)
    assert times.sum() == facts["total"].sum() == 900
    rows = quality._pack_facts("en", *quality.keys_of(x, y, z), z % 3, facts)
    again, upper, back = quality._unpack_facts(quality.pd.DataFrame(rows, columns=["lang", "part", "high", "size", "keys", *quality.FACTS]), quality.FACTS)
    assert Counter(zip(*(p.tolist() for p in quality.parts_of(again, upper)), back["n"].tolist(), strict=True)) == Counter(
        (*t, n) for t, n in tri.items())


def test_the_filter_loses_nothing(spark):
    keys = np.unique(np.random.default_rng(6).integers(0, 1 << 62, 5_000))
    rows = spark.createDataFrame([(int(k),) for k in keys], "k long")
    assert [r.h for r in rows.select(F.xxhash64("k").alias("h")).collect()] == quality.xxhash64(keys).tolist()
    bits, size = quality._filter(rows, len(keys)), 8 * 16_384
    assert len(bits) * 8 == size
    marked = np.unpackbits(bits, bitorder="little")
    assert marked[quality.xxhash64(keys) & size - 1].all() and marked.sum() <= len(keys)
