"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martlens.llm import (ann, embedding_dedup, language, mixing, ngram_join, packing, sharding, substring, token_counts,
                          toxicity)
from martlens.llm.common import local_components, n_words
from martlens.llm.components import connected_components
from martlens.llm.fm_index import FMIndex, WaveletMatrix
from martlens.llm.queries import QUERIES

random.seed(5)
WORDS = [f"w{k}" for k in range(400)]


def prose(n, words=WORDS):
    return " ".join(random.choice(words) for _ in range(n))


LONG = prose(60_000)
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, LONG), (6, "!!! 123"), (7, "a"), (7, "a"), (None, "b c d"), (9, "x" * 100_000)]


def by_id(df, column):
    return {r["doc_id"]: r[column] for r in df.collect()}


def test_language_cases(spark, documents):
    docs = documents(ODD).withColumn("lang", F.when(F.col("doc_id") == 4, "en").when(F.col("doc_id") == 9, "xx"))
    got = language.predict(docs, language.train(docs))
    assert set(docs.columns) < set(got.columns) and got.count() == len(ODD)
    pred = by_id(got, "lang_pred")
    assert [pred[k] for k in (1, 2, 3, 6)] == ["und"] * 4 and pred[4] == "en" and pred[9] == "xx"
    none = docs.where("false")
    assert language.predict(none, language.train(none)).count() == 0
    assert set(by_id(language.predict(docs, language.train(none)), "lang_pred").values()) == {"und"}


def test_language_slices_equal_whole(monkeypatch):
    codes = language.normalized(prose(500))
    whole = np.bincount(np.concatenate(list(language._pieces(codes))), minlength=language.BUCKETS)
    monkeypatch.setattr(language, "_CHUNK", 97)
    assert (np.bincount(np.concatenate(list(language._pieces(codes))), minlength=language.BUCKETS) == whole).all()


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k") for i, v in rows], "vec_id long, embedding array<float>, label int, class_id string")


BAD = [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 0.0]), (104, [float("nan"), 1.0, 0.0]), (105, [float("inf"), 1.0, 0.0])]


def test_embedding_cases(spark):
    rows = [(3, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (9, [1.0, 0.4, 0.0]), (8, [0.0, 0.0, -1.0]), (None, [1.0, 0.0, 0.0]), (7, [1.0, 0.0]), *BAD]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(vectors(spark, rows)).collect()}
    assert got[1] == (3, 1, True) and got[2] == got[3] == got[9] == (3, 1, False)
    assert got[8] == (0, 8, True) and got[7] == (0, 7, True) and got[None] == (0, None, False)
    assert all(got[i] == (0, i, True) for i, _ in BAD)
    assert embedding_dedup.near_duplicates(vectors(spark, [])).count() == 0


def test_embedding_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(1, 16)) + 0.02 * rng.normal(size=(60, 16)), rng.normal(size=(60, 16))]).astype(np.float32)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)])).collect()}
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    want = ((u @ u.T >= 0.9).sum(axis=1) - 1).tolist()
    assert [got[k] for k in range(len(x))] == want


def test_nearest_cases(spark):
    rows = [(0, [0.0, 0.0, 1.0]), (1, [0.0, 0.0, 2.0]), (2, [0.0, 0.0, 2.0]), (2, [0.0, 0.0, 2.0]), (200, [0.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (300, [1.0, 2.0]), *BAD]
    got = ann.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=2).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2), (200, 1, 0), (200, 2, 1)]
    assert got[0]["score"] == 1.0
    assert ann.nearest(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert ann.nearest(vectors(spark, BAD), F.lit(True)).count() == 0


def test_probe_order_is_by_cost():
    place = np.random.default_rng(1).random((3, 4))
    got = ann.probe_order(place, 50)
    for q in range(3):
        cost = lambda s: sum(0.0 if d == 0 else ((d - p) if d > 0 else (p - d - 1)) ** 2 for d, p in zip(s, place[q]))
        want = sorted(cost(s) for s in itertools.product(ann.STEPS.tolist(), repeat=4))[:50]
        assert np.allclose([cost(s) for s in got[q].tolist()], want)


def test_crowded_buckets_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 6)).astype(np.float32)
    got = ann.nearest(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)]), F.col("vec_id") % 50 == 0, k=3).collect()
    assert len(got) == 9 and all(r["vec_id"] != r["query_id"] for r in got)


def test_nearest_searches_every_width(spark):
    rng = np.random.default_rng(13)
    x, y = rng.normal(size=(90, 6)).astype(np.float32), rng.normal(size=(40, 4)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000 + k, v.tolist()) for k, v in enumerate(y)]
    got = {}
    for r in ann.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert sorted(got) == [*range(0, 90, 10), *range(1000, 1040, 10)] and all(len(v) == 3 for v in got.values())
    assert all((v < 1000) == (q < 1000) for q, near in got.items() for v in near)


def test_embedding_pairs_at_the_threshold_are_found(spark):
    """3000 planted pairs with cosine between 0.90 and 0.92 and no other way to meet."""
    rng = np.random.default_rng(21)
    a, b = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = rng.uniform(0.9001, 0.92, size=(3000, 1))
    x = np.concatenate([a, cosine * a + np.sqrt(1 - cosine ** 2) * b])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)])).collect()}
    assert got == {k: (1, k % 3000) for k in range(6000)}


def exact_nearest(x, q, k):
    d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(axis=1))
    return [v for _, v in sorted(zip(d.tolist(), range(len(x)))) if v != q][:k]


def test_nearest_of_mixed_norms(spark):
    """Queries far from the bulk find k rows, and the right ones; the fit alone sees only the bulk."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::100] *= np.where(np.arange(60) % 2, 1.0, 8.0)[:, None]
    x = x.astype(np.float32)
    got = {}
    for r in ann.nearest(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)]), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert sorted(got) == list(range(0, 6000, 100)) and all(len(v) == 10 for v in got.values())
    far = [q for q in got if q % 200 == 0]
    assert sum(len(set(got[q]) & set(exact_nearest(x, q, 10))) for q in far) >= 0.95 * 10 * len(far)


def test_nearest_is_exact_where_no_probes_reach_the_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "MAX_PROBES", 2)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 70)
    x = np.random.default_rng(12).normal(size=(600, 12)).astype(np.float32)
    rows = ann.nearest(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)]), F.col("vec_id") % 4 == 0).orderBy("query_id", "rank").collect()
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: exact_nearest(x, q, 10) for q in range(0, 600, 4)}


def mixed(docs, weights, sources=None):
    return mixing.mix(docs, n_words("text"), F.array("source") if sources is None else sources, weights, ["doc_id", "text"])


def test_mixing_cases(spark, documents):
    docs = documents(ODD).withColumn("source", F.when(F.col("doc_id") <= 4, "a"))
    got, report = mixed(docs, lambda names: [1.0] * len(names))
    assert [r["source"] for r in report] == ["a", None] and got.columns[:len(docs.columns)] == docs.columns
    rows = got.collect()
    assert len(rows) == len(ODD) and all(r["mix_copies"] == 0 for r in rows if not r["mix_size"])
    empty, report = mixed(docs.where("false"), lambda names: [1.0] * len(names))
    assert empty.count() == 0 and report == []
    bare, _ = mixed(docs, lambda names: [1.0] * len(names), F.lit(None).cast("array<string>"))
    assert {r["mix_copies"] for r in bare.collect()} == {0}


def test_mixing_overlapping_sources(spark, documents):
    rows = [(k, prose(20)) for k in range(600)]
    docs = documents(rows).withColumn("in", F.when(F.col("doc_id") < 200, F.array(F.lit("a"))).when(F.col("doc_id") < 400, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("b"))))
    got, report = mixed(docs, lambda names: [3.0, 1.0], F.col("in"))
    assert sum(r["target"] for r in report) == pytest.approx(12_000) and all(abs(r["flow"] - r["target"]) < 1e-6 for r in report)
    assert sum(r["mix_copies"] * r["mix_size"] for r in got.collect()) == pytest.approx(12_000, abs=60)


def test_min_cost_flow_prefers_first_epochs():
    flows = mixing.min_cost_flow([10, 10], [[0], [0, 1]], [15.0, 5.0])
    assert sum(flows[0].values()) == 10 and sum(flows[1].values()) == 10 and flows[1][1] == 5


def test_sharding_cases(spark, documents):
    docs = documents(ODD).withColumn("shard", F.lit("old"))
    got = sharding.shuffle_into_shards(docs, 4).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(i or 0 for i, _ in ODD)
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) in ([0, 1], [0, 1, 2])
    assert sharding.shuffle_into_shards(docs.where("false")).count() == 0


def test_communication_matrix_is_exact_and_hypergeometric():
    m = sharding.communication_matrix([7, 0, 93], [50, 25, 25])
    assert m.sum(axis=0).tolist() == [50, 25, 25] and m.sum(axis=1).tolist() == [7, 0, 93]
    rng = np.random.default_rng(2)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.15 and abs(np.var(draws) - 20 * .3 * .7 * 80 / 99) < 0.3
    assert 0 <= sharding.hypergeometric(rng, 4 * 10 ** 9, 6 * 10 ** 9, 1000) <= 1000


def test_packing_cases(spark, documents):
    got = packing.pack(documents(ODD), F.col("doc_id"), sequence=64, keep={"ids": F.col("ids")}).collect()
    for i, t in ODD[:3]:
        assert [r["doc_tokens"] for r in got if r["key"] == i] == [1 if not t else r["doc_tokens"] for r in got if r["key"] == i]
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 64 and sum(r["length"] for r in got if r["key"] == 7) == 4
    assert packing.pack(documents([]), F.col("doc_id")).count() == 0


def test_packing_meets_the_bound():
    rng = np.random.default_rng(4)
    for lengths in ({1000: 9, 1048: 9}, {int(k): int(n) for k, n in zip(rng.choice(700, 300, replace=False) + 1, rng.integers(1, 400, 300))}):
        _, n = packing.plan_sequences(lengths)
        assert n <= sum(k * v for k, v in lengths.items()) / 2048 * 1.02 + 2


def test_token_count_cases(spark, documents):
    rows = token_counts.context_table(token_counts.length_histogram(documents(ODD))).collect()
    zero = next(r for r in rows if r["context_limit"] == 0)
    assert zero["docs"] == 2 and zero["tokens_truncated"] == 0
    assert token_counts.context_table(token_counts.length_histogram(documents([]))).count() == 0


def test_same_ids_as_the_tokenizers_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    from martlens.llm.tokens import encoder, vocabulary_path
    own, other = encoder(vocabulary_path()), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in ("", " ", "a  b\n\nc\t d", "Übergrößenträger straße ñandú", "日本語 テスト 🙂🙂", "don't we'll x1y2", "  ​¼Ⅷ"):
        assert own.encode(text) == other.encode(text, add_special_tokens=False).ids


def test_added_tokens_as_in_the_tokenizers_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    from martlens.llm.tokens import encoder, vocabulary_path
    own, other = encoder(vocabulary_path()), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("<|endoftext|>", "a <|endoftext|> b", "one<|endoftext|><|endoftext|>\ntwo", "<|endoftext|", "x" * 1500 + " <|endoftext|> y"):
        assert own.encode(text) == other.encode(text, add_special_tokens=False).ids
    assert 50256 in own.encode("a<|endoftext|>")


def jaccard(a, b):
    def grams(t):
        w = (t or "").encode().split()
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x and y else 0.0


@pytest.mark.parametrize("block", [1024, 4])
def test_ngram_join_against_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 600 * block)
    base = [prose(60) for _ in range(4)]
    rows = []
    for k in range(80):
        w = base[k % 4].split()
        for _ in range(k % 5):
            w[random.randrange(len(w))] = random.choice(WORDS)
        rows.append((k, " ".join(w)))
    rows += [(100, "one two"), (101, "one two"), (102, None), (103, ""), (104, "  "), (105, LONG), (106, LONG + " end")]
    got = {r["doc_id"]: r for r in ngram_join.similar_groups(documents(rows)).collect()}
    links = {i: [j for j, u in rows if j != i and jaccard(t, u) >= 0.8] for i, t in rows}
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(v) for i, v in links.items()}
    for i in links:
        reach, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        assert got[i]["component_id"] == min(reach) and got[i]["kept"] == (min(reach) == i)


def test_ngram_join_cases(spark, documents):
    got = ngram_join.similar_groups(documents([(7, "a b"), (7, "a b"), (None, "a b")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"], r["kept"]) for r in got) == [(0, 0, False), (7, 1, True), (7, 1, True)]
    assert ngram_join.similar_groups(documents([])).count() == 0


def test_ngram_join_tells_texts_under_one_id_apart(spark, documents):
    near, alone, far = prose(60), prose(60), prose(60)
    rows = [(1, near), (5, near + " end"), (5, alone), (5, far), (8, far + " end"), (9, alone + " end"), (0, far + " more")]
    got = sorted((r["doc_id"], r["n_links"], r["component_id"], r["kept"]) for r in ngram_join.similar_groups(documents(rows)).collect())
    assert got == [(0, 2, 0, True), (1, 1, 1, True), (5, 1, 1, False), (5, 1, 5, True), (5, 2, 0, False), (8, 2, 0, False), (9, 1, 5, False)]


def test_near_duplicates_stage_keeps_one_row_a_group(spark, documents, sf):
    near, alone, lost = prose(60), prose(60), prose(60)
    rows = [(1, near), (1, near), (5, near + " end"), (5, alone), (None, lost), (None, lost), (None, lost + " end"), (None, near), (6, ""), (6, "")]
    got = corpus_pipeline.drop_near_duplicates(spark, documents(rows), sf).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got if r["doc_id"]) == sorted([(1, near), (5, alone), (6, ""), (6, "")])
    assert len([r for r in got if r["doc_id"] is None]) == 1


def test_bayesian_bound_keeps_similar_pairs():
    for n, least in ngram_join.least_matches(0.8, 1e-5):
        assert 0 < least < 0.8 * n


def removed(rows, window):
    """Brute force: for each distinct row (id, text) the words that stay."""
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("crowd,shard", [(20_000, 250_000), (1, 40)])
def test_substring_against_brute_force(spark, documents, monkeypatch, crowd, shard):
    monkeypatch.setattr(substring, "ANCHOR_PASSAGES", crowd)
    monkeypatch.setattr(substring, "SHARD_WORDS", shard)
    few = [f"v{k}" for k in range(3)]
    passages = [prose(30) for _ in range(3)]
    rows = [(k, " ".join([prose(15), random.choice(passages)[:random.randrange(40, 110)], prose(random.randrange(12), few), prose(9)])) for k in range(60)]
    rows += [(60 + k, prose(40, few)) for k in range(6)] + [(70, "z " * 50), (71, "z " * 30), (72, rows[5][1]), (73, rows[5][1]), (74, None), (75, ""), (76, LONG), (77, LONG)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.deduplicate(documents(rows)).collect()}
    assert got == removed(rows, 13)


def test_substring_cases(spark, documents):
    got = substring.deduplicate(documents([(5, "t " * 20), (5, "t " * 20), (None, "t " * 20), (6, "t " * 20)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (5, 0), (5, 0), (6, 20)]
    assert substring.deduplicate(documents([])).count() == 0


def test_fm_index_finds_foreign_matches():
    rng = np.random.default_rng(6)
    own = [rng.integers(1, 4, 30) for _ in range(5)]
    ids = np.concatenate([np.append(s, 0) for s in own])
    index = FMIndex(ids, np.repeat(np.arange(5), 31), 4)
    streams = [rng.integers(1, 5, 40) for _ in range(6)]
    flat = np.minimum(np.concatenate(streams), index.unknown)
    cuts = np.arange(7) * 40
    found, at = index.matches(flat, cuts[:-1], cuts[1:])
    for k, s in enumerate(streams):
        for p in range(37):
            holds = [d for d, o in enumerate(own) if any((o[q:q + 4] == s[p:p + 4]).all() for q in range(27))]
            assert found[at[k] + p] == (holds[0] if holds else np.iinfo(np.int64).max)


def test_wavelet_counts():
    s = np.random.default_rng(7).integers(0, 9, 500)
    w = WaveletMatrix(s, 9)
    at = np.arange(501)
    for c in range(9):
        assert (w.count(np.full(501, c), at) == np.append(0, np.cumsum(s == c))).all()


def test_toxicity_cases(spark, documents):
    rows = [(k, prose(20) + (" vile" if k % 3 == 0 else "")) for k in range(200)] + [(None, "vile"), (900, None), (901, "")]
    docs = documents(rows)
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(200)] + [(None, 1, 1), (900, None, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, labels, ["quality", "toxic"])
    got = toxicity.classify(docs, chain, ["quality", "toxic"])
    assert set(docs.columns) < set(got.columns) and got.count() == len(rows)
    flag = by_id(got, "rejected")
    assert all(flag[k] == (k % 3 == 0) for k in range(200)) and flag[None] and not flag[900] and not flag[901]
    none = toxicity.train(docs.where("false"), labels, ["quality", "toxic"])
    assert none == [] and not any(by_id(toxicity.classify(docs, none, ["quality", "toxic"]), "rejected").values())


def test_toxicity_trains_on_all_words():
    import pyarrow as pa
    text = " ".join(f"u{k}" for k in range(9000))
    batch = pa.RecordBatch.from_pydict({"id": [1], "text": [text]})
    (got,) = toxicity._features([batch])
    want = {f for w in toxicity.words(text) for f in toxicity.word_features(w)}
    assert set(got.column("features")[0].as_py()) == want


def test_toxicity_sample_holds_labelled_texts_only(spark, documents):
    docs = documents([(k, prose(20) + (" vile" if k % 3 == 0 else "")) for k in range(60)] + [(k, None) for k in range(60, 90)])
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(5000)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, labels, ["quality", "toxic"], max_rows=60)
    flag = by_id(toxicity.classify(docs, chain, ["quality", "toxic"]), "rejected")
    assert all(flag[k] == (k % 3 == 0) for k in range(60))


def test_components(spark):
    edges = [(a, a + 1) for a in range(1, 40)] + [(100, 200), (200, 300), (300, 100), (5, 5), (None, 3), (60, 50), (60, 50)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys((100, 200, 300), 100), 50: 50, 60: 50}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert local_components(5, np.array([4, 3]), np.array([3, 1])).tolist() == [0, 1, 2, 1, 1]


def test_pipeline_stages_survive_odd_rows(spark, documents, sf):
    docs = documents(ODD)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf)
        assert stage(spark, docs.where("false"), sf).count() == 0, name
        if name in ("toxicity", "near_duplicates", "substring_dedup"):
            assert {1, 2, 3, 6, 7, None} <= {r["doc_id"] for r in got.collect()}, name
        docs = got if name != "packing" else docs


def test_passages_are_cut_from_their_own_text(spark, documents):
    """Two texts of as many words under one id: only the one that repeats a passage loses it."""
    passage, own, other = (prose(30, [f"{c}{k}" for k in range(900)]) for c in "abc")
    docs = documents([(1, passage), (2, f"{passage} {own}"), (2, f"{other} {own}")])
    got = corpus_pipeline.cut_repeated_passages(spark, docs, "").where("doc_id = 2")
    assert sorted(r["text"] for r in got.collect()) == sorted([own, f"{other} {own}"])


def test_language_replaces_clashing_columns(spark, documents):
    docs = documents(ODD).withColumn("score", F.lit("old")).withColumn("lang_pred", F.lit(1)).withColumn("a.b", F.lit(2))
    got = language.predict(docs, language.train(docs))
    assert got.columns.count("score") == got.columns.count("lang_pred") == 1
    assert dict(got.dtypes)["score"] == "double" and {r["a.b"] for r in got.collect()} == {2}


def test_queries_survive_odd_tables(spark, documents, tmp_path):
    documents(ODD).write.parquet(f"{tmp_path}/documents.parquet")
    vectors(spark, [(0, [1.0, 0.0, 0.5]), (1, [1.0, 0.1, 0.5]), *BAD]).write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(4, 1, 0), (None, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a b c d"), (2, None), (None, "x"), (4, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).count() > 0, name
