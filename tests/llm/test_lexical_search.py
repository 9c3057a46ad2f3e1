"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest

from pktsieve.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, ids, queries, k):
    docs = [Counter(terms(t)) for t in texts]
    held = [d for d in docs if d]
    n_docs, n_terms = len(held), sum(sum(d.values()) for d in held)
    df = Counter(t for d in held for t in d)
    out = []
    for q, text in queries:
        scores = []
        for i, d in zip(ids, docs):
            if not d:
                continue
            m = 25 + (75 * sum(d.values()) * n_docs) // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * d[t]) // (1000 * d[t] + 8 * m))
                for t in terms(text) if t in d
            )
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def corpus(rnd, n):
    words = [f"w{i}" for i in range(80)] + ["É", "é", "naïve", "Ünï", "日本", "x_y", "B2b", "<tag>", "don't"]
    texts = []
    for _ in range(n):
        size = rnd.choice([1, 3, 10, 10, 10, 40, 200])
        texts.append(rnd.choice([" ", "\n", ", ", "\x00"]).join(rnd.choice(words).title() if rnd.random() < 0.1 else rnd.choice(words) for _ in range(size)))
    return texts + [texts[0]] * 40 + [None, "", "... !", "w1 " * 5000]


@pytest.mark.parametrize("block, first, batch", [(1024, 20, 1000), (7, 1, 5)])
def test_equals_brute_force(spark, docs_of, monkeypatch, block, first, batch):
    rnd = random.Random(13)
    texts = corpus(rnd, 300)
    ids = rnd.sample(range(5000), len(texts))
    queries = [(i, rnd.choice(texts) if i % 3 else " ".join(rnd.choice(texts).split()[:4])) for i in range(17)]
    queries += [(90, None), (91, "!"), (92, "unheard of"), (93, "W1 w1 w2"), (94, texts[0])]
    monkeypatch.setattr(ls, "BLOCK", block)
    monkeypatch.setattr(ls, "FIRST", first)
    monkeypatch.setattr(ls, "QUERIES", batch)
    asked = spark.createDataFrame([(q, t, "z", 1) for q, t in queries], "item_id long, text string, doc string, q int")
    got = ls.ranked_search(docs_of(texts, ids=ids), asked).collect()
    want = brute(texts, ids, queries, 10)
    assert len(want) > 150
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_large_weights_stay_whole(spark, docs_of):
    """Scores beyond 2^53 are added as 64-bit integers."""
    texts = ["a b", "a c c", "d"] + [f"f{i}" for i in range(40)]
    query = "a " * 2_000_000 + "c"
    asked = spark.createDataFrame([(1, query)], "item_id long, text string")
    got = ls.ranked_search(docs_of(texts), asked).collect()
    assert got[0]["score"] > 1 << 53 or got[0]["score"] * 4 > 1 << 53
    assert sorted(tuple(r) for r in got) == sorted(brute(texts, list(range(len(texts))), [(1, query)], 10))


def test_null_ids_repeats_and_empty_tables(spark, docs_of):
    asked = spark.createDataFrame([(1, "a"), (1, "a")], "item_id long, text string")
    got = ls.ranked_search(docs_of(["a", "a", "a", "b"], ids=[None, 4, 4, 5]), asked, k=2).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in got) == [(1, 4), (1, 4), (2, 4), (2, 4)]
    assert ls.ranked_search(docs_of(["a"]).where("false"), asked).count() == 0
    assert ls.ranked_search(docs_of(["a"]), asked.where("false")).count() == 0
