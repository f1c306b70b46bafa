"""The registered queries against their SQL, or against brute force where SQL cannot express them."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from martlens.llm.oracle import ORACLE
from martlens.llm.queries import QUERIES, cyclic_weights, table
from martlens.testing import compare


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, sf, con, key):
    ok, msg = compare(QUERIES[key](spark, sf), con, ORACLE[key])
    assert ok, msg


def test_op1_held_out_accuracy(spark, sf):
    rows = QUERIES["op1_language_id"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == table(spark, sf, "documents").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.95


def test_op3_targets_and_sums(spark, sf):
    rows = QUERIES["op3_mixing"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "text", "source"), "doc_id").collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode().split())
        assert r["taken"] % max(r["size"], 1) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    names = sorted(sizes)
    left, open_, want = float(sum(sizes.values())), set(range(len(names))), {}
    w = cyclic_weights(names)
    while open_:
        unit = left / sum(w[i] for i in open_)
        over = {i for i in open_ if w[i] * unit > 3 * sizes[names[i]]}
        for i in over or open_:
            want[names[i]] = 3.0 * sizes[names[i]] if over else w[i] * unit
        left -= sum(want[names[i]] for i in over)
        open_ = open_ - over if over else set()
    longest = max(r["size"] for r in rows)
    for s in names:
        assert math.isclose(target[s], want[s], rel_tol=1e-9)
        assert abs(taken[s] - want[s]) <= longest
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)


def test_op3_reruns_agree(spark, sf):
    a, b = (sorted(map(tuple, QUERIES["op3_mixing"](spark, sf).select("doc_id", "taken").collect())) for _ in range(2))
    assert a == b


def test_op4_is_an_exact_round_trip(spark, sf):
    rows = QUERIES["op4_sharding"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    slots = defaultdict(list)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert sorted(slots) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(v) for v in slots.values()]
    assert max(counts) - min(counts) <= 1


def test_op5_is_an_exact_round_trip(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in table(spark, sf, "documents").collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op5_packing"](spark, sf).collect():
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, own in ids.items():
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at
            at += length
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(map(len, ids.values())) / (2048 * len(sequences)) > 0.97


def test_op6_against_brute_force(spark, sf):
    from martlens.llm.tokens import encoder, vocabulary_path
    encode = encoder(vocabulary_path()).encode
    n = np.array([len(encode(r["text"] or "")) for r in table(spark, sf, "documents").collect()])
    rows = QUERIES["op6_token_counts"](spark, sf).collect()
    assert sorted(r["context_limit"] for r in rows) == sorted(set(n.tolist()))
    for r in rows:
        limit = r["context_limit"]
        assert r["docs"] == (n == limit).sum() and r["docs_over"] == (n > limit).sum()
        assert r["docs_at_most"] == (n <= limit).sum() and r["tokens_at_most"] == n[n <= limit].sum()
        assert r["tokens_truncated"] == np.minimum(n, limit).sum() and r["tokens_lost"] == np.maximum(n - limit, 0).sum()
        assert math.isclose(r["quantile"], (n <= limit).mean())


def test_op8_recall(spark, sf):
    rows = table(spark, sf, "embeddings").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    found = defaultdict(list)
    for r in QUERIES["op8_nearest_neighbours"](spark, sf).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r)
    assert sorted(found) == [i for i in ids.tolist() if i % 100 == 0]
    hit = total = 0
    for q, got in found.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        best = [v for _, v in sorted(zip(d.tolist(), ids.tolist())) if v != q][:10]
        assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
        for r in got:
            assert r["score"] == d[ids == r["vec_id"]][0]
        assert [(r["score"], r["vec_id"]) for r in got] == sorted((r["score"], r["vec_id"]) for r in got)
        hit += len({r["vec_id"] for r in got} & set(best))
        total += len(best)
    assert hit / total >= 0.9


def test_op9_finds_labelled_rows(spark):
    # sf0.01: enough labelled rows of either kind to learn from
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op9_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    toxic, clean = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["toxic"] == 0]
    assert sum(r["rejected"] for r in toxic) / len(toxic) > 0.9 and sum(r["rejected"] for r in clean) / len(clean) < 0.02


def test_pipeline_stages(spark, sf):
    docs = before = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "substring_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).toPandas(), stage(spark, docs, sf).schema)
        ids = {r["doc_id"] for r in docs.collect()}
        own = {r["doc_id"]: r["text"] for r in before.collect()}
        assert ids <= set(own)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name in ("toxicity", "near_duplicates"):  # what stays is as it was
            assert all(own[r["doc_id"]] == r["text"] for r in docs.collect())
        if name == "near_duplicates":
            texts = [t for t in (r["text"] for r in docs.collect()) if t and t.split()]
            assert len(texts) == len(set(texts))
        if name == "substring_dedup":
            assert ids == set(own)
            seen = set()
            for r in docs.orderBy("doc_id").collect():
                w = (own[r["doc_id"]] or "").encode().split()
                grams = {tuple(w[k:k + corpus_pipeline.PASSAGE_WORDS]) for k in range(len(w) - corpus_pipeline.PASSAGE_WORDS + 1)}
                assert (r["text"] == own[r["doc_id"]]) == (not grams & seen)
                seen |= grams
        if name == "mixing":
            assert max(Counter(r["doc_id"] for r in docs.collect()).values()) <= 3
        before = docs
    assert docs.count() > 0
