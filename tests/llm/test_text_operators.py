"""Mixing, packing, token counts, language identification, HTML, licences and winnowing on small cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pktsieve.llm import html_text, langid, license_scan, mixing, packing, token_counts, winnowing
from pktsieve.llm.queries import tokenizer_path

ODD = [
    None, "", " ", "a", "it's  we'll\n\n x  \t y", "<|endoftext|>", "a<|endoftext|> b <|startoftext|>c", "é́ ÀÉ ß İı Σς", "日本語 text　x",
    "\x1c\x85 a\xa0b c", "12 345 a1b2 !!! ...", "x" * 3000, " lead", "trail ", "foo\n \nbar", "🙂 emoji 🙂", "a\x00b",
]


def random_texts(rnd, n):
    chars = "abdstlmrve cd  \n\t\r'.,!<|>12²¼ªÀß×é́Σ\xa0\xad日🙂\x1c\x85AB"
    return ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def library_ids(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_token_counts_equal_the_library(docs_of):
    texts = ODD + random_texts(random.Random(9), 400) + ["word " * 400, "word " * 400]
    want = [len(x) for x in library_ids("byte_bpe_50k.json", texts)]
    for hot in (1000, 3):
        got = token_counts.count_tokens(docs_of(texts), "doc_id", "text", tokenizer_path("byte_bpe_50k.json"), hot=hot).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == {
            i: (len((t or "").encode()), want[i]) for i, t in enumerate(texts)
        }
    assert token_counts.count_tokens(docs_of(["x"]).where("false"), "doc_id", "text", tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_packing_round_trip(docs_of):
    rnd = random.Random(6)
    texts = ODD + random_texts(rnd, 300) + ["some words " * 700]
    ids = [x + [2] for x in library_ids("word_bpe_49k.json", texts)]
    rows = packing.pack(docs_of(texts), "doc_id", "text", tokenizer_path("word_bpe_49k.json"), limit=64).collect()
    rebuilt, spans = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        doc = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(doc) and r["start"] == rebuilt.get(r["doc_id"], 0) and 0 < r["length"] <= 64
        piece = doc[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, dtype="<u4").tobytes())
        rebuilt[r["doc_id"]] = r["start"] + r["length"]
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert rebuilt == {i: len(x) for i, x in enumerate(ids)}
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(spans) <= sum(map(len, ids)) / 64 * 1.05 + 1
    assert packing.pack(docs_of(["x"]).where("false"), "doc_id", "text", tokenizer_path("word_bpe_49k.json")).count() == 0


def test_first_fit_decreasing_equals_scanning():
    rnd = random.Random(2)
    for _ in range(50):
        lengths = np.array(sorted((rnd.randint(1, 100) for _ in range(rnd.randint(0, 300))), reverse=True), dtype=np.int64)
        bins, offsets = packing.first_fit_decreasing(lengths, 100)
        used: list[int] = []
        for length, b, o in zip(lengths, bins, offsets):
            i = next((i for i, u in enumerate(used) if u + length <= 100), len(used))
            if i == len(used):
                used.append(0)
            assert (b, o) == (i, used[i])
            used[i] += length


def brute_targets(sizes, cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: float(i % 3 + 1) for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_meets_targets(docs_of):
    rnd = random.Random(4)
    names = ["b", None, "a", "é", "Z", "zero"]
    sources = [rnd.choice(names[:5]) for _ in range(300)] + ["zero", "zero"]
    texts = ["w " * rnd.choice([0, 1, 3, 10, 50, 400]) for _ in range(300)] + ["", None]
    docs = docs_of(texts, sources=sources).withColumn("th", F.xxhash64("text"))
    rows = mixing.mix(docs, ["doc_id", "th"], mixing.word_count("text")).collect()
    sizes, taken = {}, {}
    for r in rows:
        assert r["size"] == len((texts[r["doc_id"]] or "").split()) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    want = brute_targets(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.mix(docs.repartition(5), ["doc_id", "th"], mixing.word_count("text")).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
    assert mixing.mix(docs.where("false"), ["doc_id", "th"], mixing.word_count("text")).count() == 0


def test_mixed_documents_keep_columns(docs_of):
    docs = docs_of(["a b c"] * 4 + ["d e"] * 2 + [None], sources=["a", "a", "b", "b", "a", None, None], ids=[1, 1, 2, 3, None, 5, 6])
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert mixing.mixed_documents(docs.where("false")).count() == 0


LANGS = {"en": "the of and in that was with from", "de": "der die und das mit ist nicht ein", "fr": "le la les des une dans qui pour"}


def sentences(rnd, lang, n):
    return [" ".join(rnd.choice(LANGS[lang].split()) for _ in range(rnd.randint(5, 30))) for _ in range(n)]


def test_language_held_out(docs_of):
    rnd = random.Random(5)
    train = [(t, x) for x in LANGS for t in sentences(rnd, x, 40)]
    test = [(t, x) for x in LANGS for t in sentences(rnd, x, 30)]
    model = langid.fit(docs_of([t for t, _ in train], langs=[x for _, x in train]), centroids=3)
    odd = [None, "", "12 34 !!", "\n\t"]
    rows = langid.predict(docs_of([t for t, _ in test] + odd).select("doc_id", "text"), model).collect()
    for r in rows:
        if r["doc_id"] < len(test):
            assert r["lang_pred"] == test[r["doc_id"]][1] and 0 <= r["score"] <= 1 and not r["rejected"]
        else:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
    far = langid.predict(docs_of(["日本語のテキスト", "ҐҐҐ ѪѪѪ ҖҖҖ"]).select("doc_id", "text"), model).collect()
    assert all(r["rejected"] for r in far)
    empty = langid.fit(docs_of(["x"]).where("false"))
    assert langid.predict(docs_of(["abc"]).select("text"), empty).first()["lang_pred"] == "und"


PAGES = [
    (None, ""), ("", ""), ("<p>", ""), ("plain words", "plain words"),
    (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p><p>no';</script></head><body><header><h1>Site</h1></header>"
        "<nav><a href=x>Home</a></nav><div class='cookie-notice'>We use cookies</div><article><h1>Title &amp; more</h1><p>One <b>bold"
        "<br>line\n two.<p>Short.</p><div class=\"share\">Share this</div><form><input><p>Mail</p></form></article>"
        "<aside>Side</aside><section id=comments><p>I agree with the author of this and that.</p></section><footer>&copy; x</footer>",
        "Title & more\n\nOne bold line two.\n\nShort.",
    ),
    (
        "<body><ul><li><a href=/a>Home</a></li></ul><h2>Heading</h2><div>" + "It is the end of the day and we are in the house. " * 5
        + "</div><p>Yes.</p><div><a href=x>More links here</a> <a href=y>and here again</a></div>",
        "Heading\n\n" + ("It is the end of the day and we are in the house. " * 5).strip() + "\n\nYes.",
    ),
    ("<article><p>cut off &amp; gone <b>here</b> <foo", "cut off & gone here"),
    ("<article><!-- <p>no</p> --><p>a</p><!-- open", "a"),
]


def test_main_text(spark):
    rows = [(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.extract(df).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: t for i, (_, t) in enumerate(PAGES)}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(df.where("false")).count() == 0


def test_licences(spark, docs_of):
    plain = ["The cat sat on the mat and looked at the moon.", "He renewed his fishing license in May.", None, ""] * 10
    told = {
        "mit": "Some text.\nReleased under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.\nmore",
        "gpl": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc": "x\n\nLicensed under CC BY-NC 4.0.",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    }
    docs = docs_of(plain + list(told.values()) + ["Released under the MIT License."])
    got = {r["doc_id"]: r for r in license_scan.scan(docs, license_scan.fit(spark, docs)).collect()}
    n = len(plain)
    assert all(got[i]["families"] == "" for i in range(n))
    assert [got[n + i]["families"] for i in range(len(told))] == list(told)
    assert got[n + len(told)]["families"] == "mit"
    plan = license_scan.scan(docs, license_scan.fit(spark, docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_paragraphs_without_licence_words_are_scored(spark, docs_of):
    plain = ["The cat sat on the mat and looked at the moon.", "The river is wide and the boat is slow.", None, ""] * 10
    tails = {  # lines of wrapped notices
        "mit": "person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in",
        "bsd": "forms, with or without modification, are permitted provided that the following conditions are met",
    }
    assert not any(re.search(license_scan.CUE_PATTERN, t.lower()) for t in tails.values())
    model = license_scan.fit(spark, docs_of(plain))
    got = license_scan.scan(docs_of(plain + [f"A first line.\n{t}" for t in tails.values()] * 2), model).collect()
    rows = sorted((tuple(r) for r in got), key=lambda r: r[0])
    assert all(r[2:] == (0, 0, "", 0.0) for r in rows[: len(plain)])
    assert [r[1:5] for r in rows[len(plain) :]] == [(2, 1, 1, f) for f in tails] * 2
    assert license_scan.scan(docs_of(["x"]).where("false"), model).count() == 0


def test_winnowing(docs_of):
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 4, 11, 12, 60, 300]))) for _ in range(40)]
    texts += [None, "", "é" * 7, texts[-1], "a b c d " * 40]
    docs = docs_of(texts)
    rows = {r["doc_id"]: r for r in winnowing.fingerprints_with_edits(docs).collect()}
    n = len(texts)
    for i, t in enumerate(texts):
        t, nxt, m = t or "", texts[i - 1] or "", len(t or "") // 3  # the next in descending id; the last is followed by the first
        edited = t[: len(t) - m] + nxt[:m]
        assert rows[i]["n_chars"] == len(t) and rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert rows[n - 2]["fingerprint"] == rows[[i for i in range(n) if texts[i] == texts[n - 2]][0]]["fingerprint"]
    # selection by definition, from the ranks of all grams
    every = docs.select(
        "doc_id", winnowing.selected(F.coalesce("text", F.lit("")), 4, 8).alias("sel"), winnowing.selected(F.coalesce("text", F.lit("")), 4, 1).alias("all")
    ).collect()
    low = (1 << 32) - 1
    for r in every:
        ranks = {low - (x & low): x for x in r["all"]}
        grams = [ranks[p] for p in sorted(ranks)]
        want = {min(grams[i : i + 8]) for i in range(max(1, len(grams) - 7))} if grams else set()
        assert set(r["sel"]) == want
    assert winnowing.fingerprints_with_edits(docs.where("false")).count() == 0
