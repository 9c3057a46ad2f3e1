"""Token alignment against whole texts encoded by both libraries and aligned byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from pktsieve.llm import token_alignment as ta
from pktsieve.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def plain_groups(texts):
    """Groups of (ids of A, ids of B) of each text, [] where bytes differ."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = [chr(x) for x in [*range(33, 127), *range(161, 173), *range(174, 256)]]
    back = {c: ord(c) for c in alphabet}
    back |= {chr(256 + n): x for n, x in enumerate(x for x in range(256) if chr(x) not in alphabet)}
    out = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        if not text:
            out.append([])
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        by_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        by_b = []
        for i in ids_b:
            p = b.id_to_piece(i)
            by_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode())
        if b"".join(by_a) != raw or b"".join(by_b) != raw:
            out.append([])
            continue
        ends_a, ends_b, e = {}, {}, 0
        for n, x in enumerate(by_a):
            e += len(x)
            ends_a[e] = n + 1
        e = 0
        for n, x in enumerate(by_b):
            e += len(x)
            ends_b[e] = n + 1
        groups, p, q = [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            groups.append((ids_a[p : ends_a[end]], ids_b[q : ends_b[end]]))
            p, q = ends_a[end], ends_b[end]
        out.append(groups)
    return out


def brute(texts):
    every = plain_groups(texts)
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in every]
    count = Counter(p for held in links for p in held)
    most = defaultdict(int)
    for (x, _), c in count.items():
        most[x] = max(most[x], c)
    rows = []
    for g, held in zip(every, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(held.values()),
            sum(n for p, n in held.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in held.items()),
            hashlib.sha256(shown.encode()).hexdigest() if g else "",
        ))
    return rows, count


def corpus(rnd):
    words = ["the", "Hello,", "naïve", "caf\u00e9", "e\u0301", "日本語テキスト", "🙂🙂", "don't", "x_y=3.14159;", "aaaaaaaaaaaaaaa", "http://a.b/c?d=e",
             "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "Ünïcödé", "\u200b", "ﬁ", "½", "1234567890", "\t", "of", "and", "straße"]
    texts = [None, "", " ", "  ", "\n", " a", "a ", "a  b", "a\u00a0b", "a \u3000 b", "a\x00b", "a\rb", "\u2581", "a\u2581b", "\ufeffx", "\x1c \x1c", "a\x85 b", "<s>",
             "<|endoftext|>", "x <|endoftext|> y"]
    for _ in range(120):
        texts.append("".join(rnd.choice(words) + rnd.choice([" "] * 8 + ["\n", "  ", "", "\n\n", " \n", "\t "]) for _ in range(rnd.choice([1, 3, 10, 60]))))
    return texts + [texts[30]] * 30 + [" ".join(rnd.choice(words) for _ in range(20_000))]


@pytest.mark.parametrize("chunk, limit, units", [(4096, ta.RANGE, True), (64, 100, True), (256, 3000, False)])
def test_equals_whole_texts(spark, docs_of, monkeypatch, chunk, limit, units):
    rnd = random.Random(12)
    texts = corpus(rnd)
    ids = rnd.sample(range(5000), len(texts))
    want, count = brute(texts)
    assert sum(w[0] > 0 for w in want) > 100 and any(w[3] > w[0] for w in want)
    if chunk == 64:
        monkeypatch.setattr(ta, "CHUNK_BYTES", 2_000)  # many chunks
    got, pairs = ta.align_documents(docs_of(texts, ids=ids), "doc_id", "text", A, B, limit=limit)
    by_id = {r["doc_id"]: tuple(r)[1:] for r in got.collect()}
    for i, t, w in zip(ids, texts, want):
        assert by_id[i] == w, repr(t)[:200]
    assert {(r["a"], r["b"]): r["count"] for r in pairs.collect()} == count


def test_bitmaps_hold_documents_and_multiplicities():
    import numpy as np

    rnd = np.random.default_rng(2)
    pair, doc = rnd.integers(0, 30, 5000), rnd.integers(0, 700, 5000)
    doc[:200], pair[:200] = 3, 4  # many links of one pair in one document
    made = ta.inverted(pair, doc)
    want = Counter(zip(pair.tolist(), doc.tolist()))
    got = Counter()
    for j, at, word, bits in zip(made["plane"], made["at"], made["word"], made["bits"].view(np.uint64)):
        for low in range(64):
            if int(bits) >> low & 1:
                got[int(made["pair"][at]), int(word) * 64 + low] += 1 << int(j)
    assert got == want
    assert dict(zip(made["pair"].tolist(), made["held"].tolist())) == Counter(p for p, _ in want)


def test_null_ids_repeats_and_empty_table(docs_of):
    got, _ = ta.align_documents(docs_of(["a b", "a b", None], ids=[None, None, 3]), "doc_id", "text", A, B)
    rows = sorted((str(r["doc_id"]), r["n_a"], r["n_best"], r["count_sum"]) for r in got.collect())
    assert rows[0] == ("3", 0, 0, 0) and rows[1] == rows[2] == ("None", 2, 2, 4)
    got, pairs = ta.align_documents(docs_of(["a"]).where("false"), "doc_id", "text", A, B)
    assert got.count() == 0 and pairs.count() == 0
