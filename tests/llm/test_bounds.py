"""Bounds and exactness of the trained and the drawing operators: many languages, very long texts, copies of labelled
and of mixed rows, and brute-force versions of naive Bayes and of the classifier chain."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlens.llm import language, mixing, toxicity
from martlens.llm.common import n_words
from martlens.llm.queries import CATEGORIES, QUERIES, table

random.seed(12)


# ----------------------------------------------------------------------------- language identification
def brute_force_bayes(train_rows, texts):
    """Multinomial naive Bayes over the same hashed grams, by loops."""
    counts, prior = defaultdict(Counter), Counter()
    for lang, text in train_rows:
        prior[lang] += 1
        counts[lang].update(np.concatenate(list(language._pieces(language.normalized(text))) or [np.zeros(0)]).astype(int).tolist())
    out = []
    for text in texts:
        codes = language.normalized(text)
        if not len(codes):
            out.append(("und", 0.0))
            continue
        grams = np.concatenate(list(language._pieces(codes))).tolist()
        logs = {}
        for lang in counts:
            total = sum(counts[lang].values()) + language.SMOOTHING * language.BUCKETS
            logs[lang] = math.log(prior[lang] / sum(prior.values())) + sum(math.log((counts[lang][g] + language.SMOOTHING) / total) for g in grams)
        best = max(logs, key=logs.get)
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


@pytest.mark.parametrize("group", [256, 3])
def test_naive_bayes_against_brute_force(spark, group):
    alphabets = {f"l{k}": "abcdefghijklmnopqrstuvwxyz"[k:k + 9] for k in range(8)}
    rows = [(n, "".join(random.choice(alphabets[lang]) if random.random() < .8 else " " for _ in range(60)), lang)
            for n, lang in enumerate(random.choice(sorted(alphabets)) for _ in range(160))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = [t for _, t, _ in rows[:60]] + [None, "", "12 34", "Zz"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = language.predict(asked, language.train(docs, group=group)).orderBy("doc_id").collect()
    for r, (lang, score) in zip(got, brute_force_bayes([(lang, t) for _, t, lang in rows], texts)):
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, rel=1e-3, abs=1e-9)


def test_three_hundred_languages_are_all_learned(spark):
    rng = random.Random(4)
    vocabulary = {f"lang{k:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for k in range(300)}
    rows = [(3 * k + j, " ".join(rng.choice(v) for _ in range(40)), lang) for k, (lang, v) in enumerate(vocabulary.items()) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language.train(docs)
    assert [len(m.langs) for m in models] == [256, 44]
    asked = spark.createDataFrame([(k, " ".join(rng.choice(v) for _ in range(40)), lang) for k, (lang, v) in enumerate(vocabulary.items())], "doc_id long, text string, lang string")
    got = language.predict(asked, models).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) == 300 and all(0 < r["score"] <= 1 for r in got)


def test_a_text_of_ten_million_characters_takes_bounded_memory():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefghijklmno pqrstuvwxyz"), 10_000_000))
    model = language.Model([f"l{k}" for k in range(256)], rng.random((language.BUCKETS, 256), dtype=np.float32), np.zeros(256))
    language.letters()
    tracemalloc.start()
    scores, lettered = language.batch_scores([text], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6 and lettered[0] and np.isfinite(scores).all()


# ----------------------------------------------------------------------------- mixing
def test_equal_rows_are_cut_one_by_one(spark):
    """50 equal rows of 4 words: the source's target lies inside the group."""
    rows = [(1, "a b c d", "x")] * 50 + [(2, "e f g h", "y")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for _ in range(2):
        got, report = mixing.mix(docs, n_words("text"), F.array("source"), lambda names: [1.0, 2.0], ["doc_id", "text"])
        taken = Counter()
        for r in got.collect():
            taken[r["source"]] += r["mix_copies"] * r["mix_size"]
        assert len(report) == 2 and {r["source"]: r["target"] for r in report} == pytest.approx({"x": 400 / 3, "y": 800 / 3})
        assert all(abs(taken[r["source"]] - r["target"]) <= 2 for r in report)


def test_the_cut_is_the_closest_sum_in_hash_order(spark):
    rng = random.Random(6)
    rows = [(k, " ".join("w" * rng.randint(1, 30)), "x") for k in range(300)] + [(1000 + k, "one two three", "y") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, report = mixing.mix(docs, n_words("text"), F.array("source"), lambda names: [1.0, 3.0], ["doc_id", "text"])
    hashed = F.xxhash64(F.lit(mixing.SEED), "doc_id", "text").alias("h")
    for r in report:
        own = got.where(F.col("source") == r["source"]).select(hashed, "mix_size", "mix_copies").orderBy("h").collect()
        words = sum(x["mix_size"] for x in own)
        epochs, rest = divmod(r["target"], words)
        sums = np.cumsum([0] + [x["mix_size"] for x in own])
        n = int(np.abs(sums - rest).argmin())
        assert [x["mix_copies"] for x in own] == [int(epochs) + (k < n) for k in range(len(own))]


# ----------------------------------------------------------------------------- toxicity
def labelled(spark, copies):
    bad = [f"bad{k}" for k in range(30)]
    fine = [f"fine{k}" for k in range(200)]
    rows = [(k, " ".join(random.sample(fine, 20) + (random.sample(bad, 6) if k % 4 == 0 else []))) for k in range(240)]
    docs = spark.createDataFrame(rows + [(4, "copied " + rows[4][1])] * copies + [(8, f"other {k} " + rows[8][1]) for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - int(k % 4 == 0), int(k % 4 == 0)) for k, _ in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_copies_of_a_labelled_id_stay_out_of_the_driver(spark, monkeypatch):
    docs, labels = labelled(spark, 500)
    sizes = []
    fit = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda rows, y, folds: sizes.append((len(rows), sum(len(at) for at, _ in rows))) or fit(rows, y, folds))
    chain = toxicity.train(docs, labels, CATEGORIES)
    toxicity.train(docs, labels, CATEGORIES, max_rows=30)
    toxicity.train(docs, labels, CATEGORIES, max_features=2_000)
    assert sizes[0][0] == 240 + 1 + 20 and sizes[1][0] == 30 and sizes[2][1] <= 2_000 and sizes[2][0] < sizes[0][0]
    toxicity.train(docs, labels, CATEGORIES, max_rows=2)
    assert sizes[3][0] == 2
    got = {r["doc_id"]: r["rejected"] for r in toxicity.classify(docs, chain, CATEGORIES).collect()}
    assert all(got[k] == (k % 4 == 0) for k in range(240))


def test_chain_scores_against_brute_force(spark):
    docs, labels = labelled(spark, 0)
    chain = toxicity.train(docs, labels, CATEGORIES)
    for r in toxicity.classify(docs.limit(60), chain, CATEGORIES).collect():
        p = []
        for c, model in enumerate(chain):
            z = model.bias + sum(float(w) * q for w, q in zip(model.chain, p))
            for word in {w for w in r["text"].lower().split()}:
                for part in [f"={word}", *(word[:n] for n in (4, 5, 6, 7) if n < len(word))]:
                    z += float(model.weights[zlib.crc32(part.encode()) % toxicity.BUCKETS])
            p.append(1 / (1 + math.exp(-z)))
            assert r[f"p_{CATEGORIES[c]}"] == pytest.approx(p[c], rel=1e-6)
        assert r["rejected"] == (p[-1] >= toxicity.THRESHOLD)
    assert len(chain[1].chain) == 1 and len(chain[0].chain) == 0


def test_later_models_train_on_out_of_fold_probabilities():
    """Category 1 is category 0's label, but only known to a model that has seen it: with in-fold probabilities the
    chain weight would be far larger than with out-of-fold ones."""
    rng = np.random.default_rng(2)
    rows = [(np.unique(rng.integers(0, toxicity.BUCKETS, 30)).astype(np.int32), np.ones(30, dtype=np.float32)) for _ in range(200)]
    rows = [(at, n[:len(at)]) for at, n in rows]
    y = rng.integers(0, 2, 200).astype(float)
    chain = toxicity.fit_chain(rows, np.column_stack([y, y]), np.arange(200) % toxicity.FOLDS)
    inside = toxicity.LinearModel(0).fit(rows, np.zeros((200, 0)), y, 100).predict(rows, np.zeros((200, 0)))
    direct = toxicity.LinearModel(1).fit(rows, inside[:, None], y, 101)
    assert abs(chain[1].chain[0]) < 0.5 * direct.chain[0]


def test_held_out_recall_of_toxicity(spark):
    """Trained without the labels of a fifth of the documents, judged on these."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    chain = toxicity.train(docs, labels.where(~held), CATEGORIES)
    rows = toxicity.classify(docs.join(labels.where(held), "doc_id", "left_semi"), chain, CATEGORIES).join(labels, "doc_id").collect()
    toxic, clean = [r["rejected"] for r in rows if r["toxic"] == 1], [r["rejected"] for r in rows if r["toxic"] == 0]
    assert len(toxic) >= 10 and sum(toxic) / len(toxic) >= 0.8 and sum(clean) / len(clean) < 0.02


def test_queries_keep_their_columns(spark, sf):
    assert QUERIES["op1_language_id"](spark, sf).columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert QUERIES["op3_mixing"](spark, sf).columns == ["doc_id", "size", "source_size", "target", "taken"]


# ----------------------------------------------------------------------------- substring dedup
def test_places_of_a_hot_text_do_not_grow_with_its_copies(spark, monkeypatch):
    """A 400-word text and a near copy of it: the places listed for a text stay below its words, however many copies."""
    from martlens.llm import substring
    base = [f"w{k}" for k in range(400)]
    near = base[:200] + ["other"] + base[200:]
    sizes = []
    keep = substring.materialize
    monkeypatch.setattr(substring, "materialize", lambda df, label: (sizes.append(keep(df, label)), sizes[-1])[1])
    for copies in (1, 300):
        rows = [(k, " ".join(base)) for k in range(copies)] + [(10_000, " ".join(near))]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
        sizes.clear()
        got = {r["doc_id"]: r["n_removed"] for r in substring.deduplicate(docs).collect()}
        assert got == {0: 0, **{k: 400 for k in range(1, copies)}, 10_000: 400}
        listed = next(df for df in sizes if df.columns == ["doc_id", "text_key", "places"])
        assert all(len(r["places"]) <= 401 and len(set(r["places"])) == len(r["places"]) for r in listed.collect())


def test_texts_that_share_a_key_are_not_copies(spark, monkeypatch):
    """Two texts under one 64-bit key: the second is not emptied, as their checks differ."""
    from martlens.llm import substring
    monkeypatch.setattr(substring, "_text_key", lambda text: 5)
    batch = spark.createDataFrame([(1, 1, " ".join(f"a{k}" for k in range(20))), (2, 2, " ".join(f"b{k}" for k in range(20)))], "doc_id long, text_hash long, text string").toArrow()
    (out,) = substring._rows(batch.combine_chunks().to_batches(), 13)
    assert out.column("text_key").to_pylist() == [5, 5] and len(set(out.column("text_check").to_pylist())) == 2


def test_places_are_united_text_by_text():
    import pyarrow as pa

    from martlens.llm import substring
    rng = np.random.default_rng(1)
    rows = sorted(((int(k), rng.integers(0, 50, rng.integers(1, 40)).astype(np.int32)) for k in rng.integers(0, 6, 3000)), key=lambda r: r[0])
    batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.int64()), pa.array([p for _, p in part], pa.list_(pa.int32()))], names=["text_key", "places"])
               for part in (rows[i:i + 70] for i in range(0, len(rows), 70))]
    got = {k: p for b in substring._united(batches) for k, p in zip(b.column("text_key").to_pylist(), b.column("places").to_pylist())}
    assert got == {k: sorted({int(x) for key, p in rows if key == k for x in p}) for k in {k for k, _ in rows}}
    assert list(substring._united([])) == []


def test_index_of_a_full_anchor_in_little_memory():
    """4,000 passages of one anchor, which is never cut: right answers, and less than 170 bytes a word held by the search."""
    import tracemalloc

    import pyarrow as pa

    from martlens.llm import substring
    rng = np.random.default_rng(3)
    vocabulary, window = [b"w%d" % k for k in range(6000)], 25
    words = [[vocabulary[i] for i in rng.integers(0, 6000, 12)] + vocabulary[:13] + [vocabulary[i] for i in rng.integers(0, 6000, 12)] for _ in range(3990)]
    words += [words[k] + [b"more"] for k in range(10)]  # the windows of earlier ones and one of their own
    texts = [b" ".join(w) for w in words]
    docs = rng.permutation(len(texts))
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([7] * len(part), pa.int64()), pa.array([str(k) for k in part]), pa.array(docs[part], pa.int64()),
         pa.array([texts[k] for k in part], pa.binary()), pa.array([len(texts[k]) / 4 for k in part])],
        names=["anchor", "passage_key", "first_doc", "passage", "size"]) for part in np.array_split(np.arange(len(texts)), 16)]
    tracemalloc.start()
    try:
        (out,) = substring._searched(iter(batches), window)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    first: dict = {}
    for doc, w in zip(docs.tolist(), words):
        for k in range(len(w) - window + 1):
            first[tuple(w[k:k + window])] = min(doc, first.get(tuple(w[k:k + window]), doc))
    got = dict(zip(out.column("passage_key").to_pylist(), out.column("firsts").to_pylist()))
    assert got == {str(k): [first[tuple(w[i:i + window])] for i in range(len(w) - window + 1)] for k, w in enumerate(words)}
    assert most < 170 * sum(len(w) + 1 for w in words)


# ----------------------------------------------------------------------------- nearest neighbours
@pytest.mark.parametrize("rows, queries, block", [(4096, 512, 1 << 26), (7, 3, 8 * 6 * 5)])
def test_the_exact_scan_finds_all_with_ties_copies_and_repeats(spark, monkeypatch, rows, queries, block):
    from martlens.llm import ann
    monkeypatch.setattr(ann, "SCAN_ROWS", rows)
    monkeypatch.setattr(ann, "SCAN_QUERIES", queries)
    monkeypatch.setattr(ann, "QUERY_BYTES", block)
    rng = np.random.default_rng(5)
    x = rng.integers(-2, 3, size=(160, 6)).astype(float) * 1e3 + 1e6  # many ties, and products that cancel
    x[40:120] = x[7]
    data = [(k, v.tolist()) for k, v in enumerate(x)] + [(3, x[3].tolist()), (3, x[9].tolist())]
    frame = spark.createDataFrame(data, "vec_id long, vec array<double>").repartition(3)
    asked = spark.createDataFrame([(k, x[k].tolist()) for k in range(0, 160, 9)], "vec_id long, vec array<double>")
    got = defaultdict(list)
    for r in ann._merge(ann._exact(frame, asked, 12, 6), 12).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    for q in range(0, 160, 9):
        near = {}
        for k, v in data:
            if k != q:
                near[k] = min(near.get(k, math.inf), float(np.sqrt(((np.array(v) - x[q]) ** 2).sum())))
        assert got[q] == sorted((s, k) for k, s in near.items())[:12]


def test_fewer_rows_than_asked_for(spark):
    from martlens.llm import ann
    frame = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 3.0])], "vec_id long, vec array<double>")
    assert [tuple(r) for r in ann._merge(ann._exact(frame, frame, 5, 2), 5).orderBy("query_id").collect()] == [(1, 1, 2, 2.0), (2, 1, 1, 2.0)]
