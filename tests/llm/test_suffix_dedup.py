"""Suffix arrays against sorting; removal against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from pktsieve.llm import queries
from pktsieve.llm import suffix_dedup as sd
from pktsieve.llm.hashing import batches, word_hashes, words_of


def test_suffix_array_equals_sorting():
    rnd = random.Random(1)
    for _ in range(400):
        x = [rnd.randint(1, rnd.choice([1, 2, 3, 9])) for _ in range(rnd.randint(0, 40))] + [0]
        assert sd.suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(r, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest(), len(kept), kept.decode("utf-8", "ignore")))
    return out


def corpus(rnd, n, length):
    passages = ["".join(rnd.choice("abcdéß ") for _ in range(rnd.randint(length - 3, 4 * length))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            if rnd.random() < 0.5:
                p = rnd.choice(passages)
                a = rnd.randint(0, len(p) // 2)
                p = p[a : rnd.randint(a, len(p))]
                if p and rnd.random() < 0.4:
                    k = rnd.randrange(len(p))
                    p = p[:k] + "#" + p[k + 1 :]
            else:
                p = "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 2 * length)))
            parts.append(p)
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("length,segments", [(20, 1000), (41, 1000), (20, 2)])
def test_removal_equals_brute_force(docs_of, monkeypatch, length, segments):
    monkeypatch.setattr(sd, "SEGMENTS", segments)  # 2: nearly all anchors go the way of hot ones
    rnd = random.Random(length)
    texts = corpus(rnd, 60, length) + ["a" * (3 * length), "a" * length, "", None, "ab" * length, "short"]
    texts += texts[:5]
    got = sd.dedup_digests(docs_of(texts), "doc_id", "text", length).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == dict(enumerate(brute(texts, length)))


def test_documents_keep_columns_and_clean_rows(docs_of):
    rnd = random.Random(3)
    clean = "".join(rnd.choice("abcdefgh") for _ in range(300))
    shared = "".join(rnd.choice("stuvwxyz") for _ in range(60))
    docs = docs_of([clean, "one " + shared, shared, None, ""], ids=[1, 2, None, None, 5])
    got = sd.dedup_documents(docs, "doc_id", "text", 50)
    assert got.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {(1, clean), (2, "one "), (None, None), (5, "")}


def brute_words(texts, words):
    cut = [[(m.group().lower(), *m.span()) for m in re.finditer("[^ \t-\r]+", t or "")] for t in texts]
    strings = [[tuple(w for w, _, _ in c[i : i + words]) for i in range(len(c) - words + 1)] for c in cut]
    held = Counter(s for each in strings for s in set(each))
    out = []
    for t, c, each in zip(texts, cut, strings):
        gone = {x for i, s in enumerate(each) if held[s] > 1 for x in range(c[i][1], c[i + words - 1][2])}
        left = "".join(ch for x, ch in enumerate(t or "") if x not in gone)
        out.append(left if left.strip() or not gone else None)
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_removal_by_words_equals_brute_force(docs_of, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(sd, "MAX_BROADCAST_ROWS", -1)
    rnd = random.Random(8)
    passages = [[rnd.choice(["ab", "Äb", "x", "of"]) + rnd.choice("abcdefg") for _ in range(rnd.randint(8, 40))] for _ in range(6)]
    texts = []
    for i in range(70):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 2)
            p = p[a : rnd.randint(a, len(p))]
            parts += [w.upper() if rnd.random() < 0.05 and w.isascii() else w for w in p]
            parts += [f"u{rnd.randrange(9999)}" for _ in range(rnd.randint(0, 12))]
        texts.append("".join(w + rnd.choice([" ", "\n", "  "]) for w in parts))
    own = " ".join(f"own{i}" for i in range(15))
    texts += [own + " and again " + own, "is " * 40, "is " * 12, "is " * 9, None, "", " ", texts[2], " ".join(passages[0][:10])]
    got = sd.dedup_documents(docs_of(texts), "doc_id", "text", 100_000, 10).collect()
    want = {i: t for i, t in enumerate(brute_words(texts, 10)) if t is not None}
    assert {r["doc_id"]: r["text"] or "" for r in got} == want
    assert sum(want.get(i) != (t or "") for i, t in enumerate(texts)) > 30 and want[70] == texts[70]


def test_query_tells_passages_of_over_50_words_below_400_bytes(spark, docs_of, tmp_path):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    passage, twice = " ".join(word() for _ in range(55)), " ".join(word() for _ in range(55))
    own = [" ".join(word() for _ in range(80)) for _ in range(4)]
    long = " ".join(word() for _ in range(90))
    assert len(passage) < 400 < len(long)
    texts = [
        own[0] + "\n" + passage, "é " + passage.upper().replace(" ", "\n ") + " " + own[1], own[2], twice + " " + own[3] + " " + twice,
        None, "", long + " a", long + " b", "c " + long + " c " + passage,
    ]
    docs_of(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op2_suffix_array_dedup(spark, str(tmp_path)).collect()}
    at = lambda i, p: [(a := texts[i].encode().index(p.encode()), a + len(p))]
    upper = passage.upper().replace(" ", "\n ")
    want = [at(0, passage), at(1, upper), [], [], [], [], at(6, long), at(7, long), at(8, long) + at(8, passage)]
    assert {i: [tuple(p) for p in r["passages"]] for i, r in got.items()} == dict(enumerate(want))
    assert {i: r["n_passage_bytes"] for i, r in got.items()} == {i: sum(b - a for a, b in w) for i, w in enumerate(want)}
    # the removal itself goes by strings of 400 bytes alone
    assert {i: tuple(r)[1:7] for i, r in got.items()} == dict(enumerate(brute(texts, 400)))


def test_segments_of_texts_read_together_are_those_of_each():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab \n") for _ in range(rnd.choice([0, 3, 19, 20, 21, 90]))) for _ in range(60)]
    for length, k in ((20, 5), (7, 1)):
        raws = [np.frombuffer(t.encode(), dtype=np.uint8) for t in texts]
        for parts in (raws, [words_of([t])[0] for t in texts]):
            counts = np.array([len(x) for x in parts])
            base = np.cumsum(counts) - counts
            alone = [
                (i, *(int(x) for x in (h, c, p + base[i], a + base[i], b + base[i])))
                for i, x in enumerate(parts) for _, h, c, p, a, b in zip(*sd.find_anchors(x, np.array([len(x)]), length, k))
            ]
            joined = sd.find_anchors(np.concatenate(parts), counts, length, k)
            assert [tuple(int(x) for x in row) for row in zip(*joined)] == alone and alone
    assert words_of(texts)[0].tolist() == [h for t in texts for h in word_hashes(t).tolist()]
    assert words_of(texts)[1].tolist() == [len(t.split()) for t in texts]
    assert list(batches([3, 4, 9, 1, 1], 7)) == [(0, 2), (2, 3), (3, 5)] and list(batches([])) == []


def test_copies_without_an_id_are_documents_of_their_own(docs_of):
    text = " ".join(f"w{i}" for i in range(20))
    docs = docs_of([text + " a", text + " a", text], ids=[None, None, None])
    assert sd.dedup_documents(docs, "doc_id", "text", 1_000, 10).collect() == []


def test_empty_table(docs_of):
    assert sd.dedup_digests(docs_of(["x"]).where("false")).count() == 0
