"""Benchmark decontamination and ranked lexical search: odd cases, slices, and trees against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from martlens.llm import decontamination, lexical

random.seed(9)
WORDS = [f"t{k}" for k in range(300)]


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id int, text string")


PASSAGE = prose(30)
ITEMS = [(3, PASSAGE), (11, " ".join(PASSAGE.split()[5:25])), (3, "Short one!"), (None, "nameless item"), (4, None), (5, ""), (6, "?! --")]
DOCS = [(1, None), (2, ""), (3, "..."), (4, prose(20) + " " + PASSAGE.upper().replace(" ", "; ") + " " + prose(20)), (5, "a SHORT-one, b"), (5, "a SHORT-one, b"),
        (6, "the nameless\nitem."), (7, " ".join(PASSAGE.split()[:9])), (8, " ".join(PASSAGE.split()[:10])), (None, PASSAGE), (9, prose(50_000) + " " + PASSAGE),
        (10, "short"), (12, "é" + "short one"), (13, "ÀSHORT ONE short  one")]


def plain_words(text):
    import re
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, held = plain_words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    held |= windows[tuple(w[i:i + k])]
        out.append((doc or 0, len(w), len(hit), sorted(str(x) for x in held if x is not None), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("slice_words", [1 << 19, 1])
def test_decontamination_cases(spark, documents, slice_words):
    docs = documents(DOCS).withColumnRenamed("component", "n_hit").withColumnRenamed("n", "item_id")
    got = decontamination.decontaminate(docs, items_of(spark, ITEMS), slice_words=slice_words)
    assert got.columns == [c for c in docs.columns if c != "n_hit"] + decontamination.RESULTS
    rows = got.collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in rows) == brute_force(DOCS, ITEMS)
    clean = {r["doc_id"]: r["clean_text"] for r in rows}
    assert (clean[1], clean[3], clean[5], clean[6], clean[8], clean[None], clean[13]) == (None, "...", "a , b", "the .", "", "", "ÀSHORT ONE ")
    assert clean[4] == " ".join(DOCS[3][1].split()[:20]) + "  " + " ".join(DOCS[3][1].split()[-20:])
    for r in rows:
        assert all(s["start"] < s["end"] for s in r["spans"]) and all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_decontamination_without_rows(spark, documents):
    docs = documents(DOCS)
    none = decontamination.decontaminate(docs, items_of(spark, [(4, None)])).collect()
    assert len(none) == len(DOCS) and not any(r["contaminated"] for r in none) and {r["clean_text"] for r in none} == {t for _, t in DOCS}
    assert decontamination.decontaminate(docs.where("false"), items_of(spark, ITEMS)).count() == 0


def test_equal_hashes_alone_never_count(monkeypatch):
    monkeypatch.setattr(decontamination, "window_hashes", lambda w, k: ((n, np.zeros(len(w) - n + 1, dtype=np.uint64)) for n in range(1, min(k, len(w)) + 1)))
    windows = decontamination.Windows([("1", [b"a", b"b"])], 10)
    assert windows.find([b"c", b"a", b"b", b"d"], decontamination.WordHashes()) == ([(1, 3)], {"1"})


def ranked(docs, items, k=20):
    tf = [Counter(plain_words(t)) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    n_docs, n_terms = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        asked = Counter(plain_words(text))
        scores = []
        for (doc, _), own, size in zip(docs, tf, n):
            m = 75 + 25 * size * n_docs // n_terms if n_terms else 0
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * own[t] // (1000 * own[t] + 12 * m))
                    for t, times in asked.items() if own[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item or 0, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("cells", [1 << 22, 1])
def test_search_cases(spark, documents, cells):
    docs = DOCS + [(100 + k, "equal texts tie") for k in range(30)] + [(None, "equal texts tie")]
    items = ITEMS + [(20, "texts tie tie unheard"), (21, prose(40)), (22, "unheard of")]
    frame = documents(docs).withColumnRenamed("component", "score").withColumnRenamed("n", "item_id")
    got = lexical.search(frame, items_of(spark, items), cells=cells)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((r["item_id"] or 0, r["rank"], r["doc_id"] or 0, r["score"]) for r in got.collect()) == ranked(docs, items)


def test_search_without_rows(spark, documents):
    assert lexical.search(documents([]), items_of(spark, ITEMS)).count() == 0
    assert lexical.search(documents([(1, None), (2, "")]), items_of(spark, ITEMS)).count() == 0
    assert lexical.search(documents(DOCS), items_of(spark, [(1, None), (2, "?")])).count() == 0


@pytest.mark.parametrize("leaf", [1, 7, 64])
def test_tree_search_is_exact_and_prunes(leaf):
    """Rows around a few centres: all k best rows are found though most rows are never scored."""
    rng = np.random.default_rng(4)
    width, rows = 60, []
    for c in range(8):
        base = rng.choice(width, 10, replace=False)
        rows += [np.unique(np.append(rng.choice(base, 8), rng.integers(width))) for _ in range(100)]
    start = np.cumsum([0, *map(len, rows)])
    cols = np.concatenate(rows)
    values = rng.integers(1, 1_000_000, len(cols))
    q = np.zeros((5, width), dtype=np.int64)
    for row in q:
        row[rng.choice(rows[rng.integers(800)], 4)] = rng.integers(1, 20_000, 4)
    scale = np.sqrt(q.sum(axis=0) / np.maximum((q > 0).sum(axis=0), 1))
    best = [lexical.Best(3) for _ in q]
    scored = lexical.search_block(best, q, q / np.where(scale > 0, scale, 1), scale, np.arange(800), np.zeros(800, dtype=bool), start, cols, values, leaf)
    dense = np.zeros((800, width), dtype=np.int64)
    dense[np.repeat(np.arange(800), np.diff(start)), cols] = values
    for own, scores in zip(best, (q @ dense.T)):
        want = sorted(((-s, False, k) for k, s in enumerate(scores.tolist()) if s > 0))[:3]
        assert own.rows == want
    assert scored < 5 * 800 * (0.6 if leaf < 64 else 1.01)


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(7)
    rows = [np.unique(rng.integers(0, 40, rng.integers(1, 12))) for _ in range(300)]
    start, cols = np.cumsum([0, *map(len, rows)]), np.concatenate(rows)
    x = rng.random(len(cols)) * 1e6
    balls = lexical.Balls(start, cols, x, 40, 10)
    assert sorted(balls.order.tolist()) == list(range(300))
    dense = np.zeros((300, 40))
    dense[np.repeat(np.arange(300), np.diff(start)), cols] = x
    q = rng.random((6, 40)) * (rng.random((6, 40)) < 0.3)
    for node, bound in enumerate(balls.bounds(q).T):
        assert (q @ dense[balls.order[balls.lo[node]:balls.hi[node]]].T <= bound[:, None]).all()
