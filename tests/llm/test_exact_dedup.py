"""Exact duplicates against grouping by the normalised text."""

import hashlib
import random
import re

from pktsieve.llm import exact_dedup as ed


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def corpus(rnd):
    texts = [None, "", None, " ", "\n\t", "a", "A", "a ", " a", "a\n\n", "é", "e\u0301", "a\u00a0b", "a b", "a\u2028b", "x" * 70 + "1", "x" * 70 + "2"]
    for _ in range(60):
        words = [rnd.choice("ab cd ef gh".split()) for _ in range(rnd.choice([1, 2, 3, 40]))]
        texts.append("".join(w + rnd.choice([" ", "  ", "\n", "\t ", "\x0b"]) for w in words))
    long = " ".join(rnd.choice(["alpha", "beta"]) for _ in range(60_000))
    return texts + [long, long.replace(" ", "\n", 7), long + "x", long]


def test_equals_grouping(spark, docs_of, monkeypatch):
    rnd = random.Random(11)
    texts = corpus(rnd)
    ids = rnd.sample(range(1000), len(texts))
    ids[2] = None
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault(normal(t), []).append(i)
    want = []
    for i, t in zip(ids, texts):
        held = [x for x in groups[normal(t)] if x is not None]
        keep = min(held) if held else None
        sha = hashlib.sha256(normal(t).encode()).hexdigest()
        want.append((str(i), keep, len(groups[normal(t)]), i == keep, sha))
    for most in (ed.MAX_BROADCAST_ROWS, 0):  # 0: nothing is broadcast, every text is hashed
        monkeypatch.setattr(ed, "MAX_BROADCAST_ROWS", most)
        got = ed.exact_groups(docs_of(texts, ids=ids), hash_all=True).collect()
        assert sorted((str(r[0]), r[1], r[2], r[3], r["text_sha256"]) for r in got) == sorted(want)
        kept = ed.distinct_documents(docs_of(texts, ids=ids)).collect()
        assert sorted(r["doc_id"] for r in kept) == sorted({w[1] for w in want})
        assert kept[0].__fields__ == docs_of(texts).columns


def test_only_survivors_are_hashed(docs_of):
    got = {r["doc_id"]: r for r in ed.exact_groups(docs_of(["aa", "bb", "bb ", "b b", "ccc", "bb\n"])).collect()}
    assert [got[i]["text_sha256"] is not None for i in range(6)] == [False, False, True, False, False, True]
    assert [got[i]["kept"] for i in range(6)] == [True, True, True, True, True, False]


def test_repeated_rows_keep_one(spark, docs_of):
    texts, ids = ["same"] * 5 + ["other"] * 2, [7, 7, 7, 9, None, None, None]
    got = ed.exact_groups(docs_of(texts, ids=ids)).collect()
    assert sorted(((str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"]) for r in got), key=str) == sorted(
        [("7", 7, 5, True), ("7", 7, 5, False), ("7", 7, 5, False), ("9", 7, 5, False), ("None", 7, 5, False),
         ("None", None, 2, True), ("None", None, 2, False)], key=str,
    )
    assert sorted(str(r["doc_id"]) for r in ed.distinct_documents(docs_of(texts, ids=ids)).collect()) == ["7", "None"]


def test_empty_table(docs_of):
    assert ed.exact_groups(docs_of(["x"]).where("false")).count() == 0
    assert ed.distinct_documents(docs_of(["x"]).where("false")).count() == 0
