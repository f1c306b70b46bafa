"""Cross-tokenizer alignment against brute force over bytes, and its odd cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from martlens.llm import alignment
from martlens.llm.queries import QUERIES, table


def brute_force(texts):
    """Rows in the order of ``texts``, by the two libraries named in the contract and plain loops."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = sorted(ByteLevel.alphabet())
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of_char = {chr(x): x for x in visible} | dict(zip((chr(256 + k) for k in range(256 - len(visible))), (x for x in range(256) if x not in visible)))
    assert sorted(of_char) == alphabet

    def b_bytes(piece):
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()

    rows, held = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(of_char[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [b_bytes(b.id_to_piece(i)) for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            rows.append((0, 0, [], Counter()))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b))
        groups, links, at_a, at_b = [], Counter(), 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
            links.update((x, y) for x in ids_a[at_a:to_a] for y in ids_b[at_b:to_b])
            at_a, at_b = to_a, to_b
        held.update(links.keys())
        rows.append((len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for n_a, n_b, groups, links in rows:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == best[p[0]]),
                    sum(n * held[p] for p, n in links.items()), hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    return out


def test_op13_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    want = dict(zip([r["doc_id"] for r in docs], brute_force([r["text"] for r in docs])))
    got = {r["doc_id"]: tuple(r[c] for c in alignment.RESULTS) for r in QUERIES["op13_cross_tokenizer_alignment"](spark, sf).collect()}
    assert got == want


LONG_WORD = "ß漢x" * 900
ODD = [(1, None), (2, ""), (3, " "), (4, "  \t\n two  blanks "), (5, "<|endoftext|> <s> </s> <unk> <0x41>"), (6, "a ▁ b"), (7, "same"), (7, "same"),
       (None, "no id"), (9, "x" * 5000 + " y"), (10, LONG_WORD), (11, "漢字かな交じり🙂🙃 Übergröße"), (12, "word " * 3000), (13, "\0\x01é́ ﬁ ²")]


@pytest.mark.parametrize("lane, large, slices", [(256, 64, 1 << 22), (4, 1, 50), (1, 0, 1)])
def test_alignment_cases(spark, documents, monkeypatch, lane, large, slices):
    monkeypatch.setattr(alignment.lanes, "__defaults__", (lane,))
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    texts = [t for _, t in ODD]
    rows = [(0 if i is None else i, t) for i, t in ODD]
    got_local = alignment._align_texts([t for t in texts if t], alignment.tokenizers(alignment.vocabulary_path(), alignment.piece_path()))
    want = brute_force(texts)
    assert list(zip(*(got_local[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")))) == [(*w[:4], w[6]) for t, w in zip(texts, want) if t]
    if lane == 1:
        return
    docs = documents(ODD[:8] + ODD[8:]).withColumnRenamed("component", "n_links")
    got = alignment.with_link_counts(alignment.align(docs), slices)
    assert [c for c in got.columns if c not in alignment.RESULTS] == [c for c in docs.columns if c not in ("text", "n_links")]
    assert sorted((r["doc_id"] or 0, *(r[c] for c in alignment.RESULTS)) for r in got.collect()) == sorted((i, *w) for (i, _), w in zip(rows, want))


def test_alignment_of_no_rows(spark, documents):
    assert alignment.with_link_counts(alignment.align(documents([]))).count() == 0
    assert [tuple(r[c] for c in alignment.RESULTS) for r in alignment.with_link_counts(alignment.align(documents([(1, None)]))).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_merge_finds_all_common_ends():
    rng = random.Random(3)
    for _ in range(200):
        ends = [sorted(rng.sample(range(1, 400), rng.randint(1, 300))) for _ in range(2)]
        a, b = (np.array(sorted({*e, 400})) for e in ends)
        doc_a = np.array([0])
        groups = alignment.merge(a, b, *alignment.lanes(a, b, doc_a, rng.choice([1, 3, 50, 1000])))
        cuts = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[groups[1] - 1].tolist() == cuts == b[groups[3] - 1].tolist()
        assert groups[0].tolist() == [0, *groups[1][:-1].tolist()] and groups[2].tolist() == [0, *groups[3][:-1].tolist()]


def test_other_normalisation_gives_no_tokens(monkeypatch):
    t = alignment.tokenizers(alignment.vocabulary_path(), alignment.piece_path())

    class Changed:
        def encode(self, texts, num_threads):
            return t.b.encode([x.lower() for x in texts], num_threads=1)

    class Other:
        a, b, bytes_a, bytes_b, written = t.a, Changed(), t.bytes_a, t.bytes_b, t.written

    got = alignment._align_texts(["lower", "Upper"], Other)
    assert got["n_a"][0] > 0 and got["n_a"][1] == 0 and got["groups_sha256"][1] == ""
