"""The pipeline's stages on a small table: columns, decisions and order of work."""

import random
import weakref

import corpus_pipeline as cp
import numpy as np
from pktsieve.llm import common, stages


def test_stages_and_columns(spark, docs_of, tmp_path):
    rnd = random.Random(1)
    vocabulary = "the of and in that was with from this they".split()
    texts = [" ".join(rnd.choice(vocabulary) + rnd.choice(["", "s", "ed", "ing"]) for _ in range(rnd.randint(20, 200))) for _ in range(60)]
    passage = " ".join(rnd.choice(vocabulary) + rnd.choice("abcdefgh") for _ in range(120))
    texts[0:3] = [texts[0]] * 3  # copies
    texts[3], texts[4] = texts[3] + " " + passage, passage + " " + texts[4]
    texts += ["12345 67890", None, ""]
    docs = docs_of(texts, sources=["a", "b", "c"] * 21).select("doc_id", "text", "lang", "source", "n_chars")
    assert [n for n, _ in cp.STAGES] == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "mix_sources", "packing"]
    counts = []
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, "")
        path = str(tmp_path / name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if i < 4:
            assert out.columns == docs.columns
        rows = out.collect()
        ids = [r["doc_id"] for r in rows]
        if name == "language_id":
            assert sorted(ids) == list(range(60))
        if name == "ngram_jaccard_join":
            assert sorted(ids) == [0, *range(3, 60)]
        if name == "suffix_array_dedup":
            kept = {r["doc_id"]: r["text"] for r in rows}
            assert passage not in kept[3] and kept[10] == texts[10]
        counts.append(len(rows))
        docs = out
    assert counts[-1] > 0


def test_join_stage_keeps_one_of_near_copies_and_differing_texts_of_an_id(spark, docs_of):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    base = [rnd.choice(words) for _ in range(200)]
    cut = base[:90] + base[115:]  # 0.80 to 0.90 of the shingles
    other = [rnd.choice(words) for _ in range(30)]
    texts = [" ".join(base), " ".join(cut), " ".join(other), " ".join(other[:20]), None, None, "", " ".join(base), "same", "same"]
    ids = [1, 2, 3, 3, 5, 5, 6, 3, 9, 9]
    docs = docs_of(texts, ids=ids).select("doc_id", "text", "lang", "source", "n_chars")
    a, b = (len({tuple(t[i : i + 5]) for i in range(len(t) - 4)}) for t in (base, cut))
    assert 0.80 <= b / (a + 4) < 0.90
    rows = stages.ngram_jaccard_join(spark, docs, "").collect()
    got = sorted((r["doc_id"], r["text"] or "") for r in rows)
    assert got == sorted([(1, texts[0]), (3, texts[2]), (3, texts[3]), (5, ""), (6, ""), (9, "same")])


def test_empty_documents(spark, docs_of):
    docs = docs_of(["x"]).where("false").select("doc_id", "text", "lang", "source", "n_chars")
    for stage in (stages.language_id, stages.ngram_jaccard_join, stages.suffix_array_dedup, stages.mix_sources, stages.packing):
        assert stage(spark, docs, "").count() == 0


def test_suffix_stage_removes_passages_of_over_50_words_below_400_bytes(spark, docs_of):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    passage, twice = " ".join(word() for _ in range(55)), " ".join(word() for _ in range(55))
    own = [" ".join(word() for _ in range(80)) for _ in range(4)]
    assert len(passage) < 400
    texts = [own[0] + "\n" + passage, passage + " " + own[1], own[2], twice + " " + own[3] + " " + twice, passage]
    docs = docs_of(texts).select("doc_id", "text", "lang", "source", "n_chars")
    got = {r["doc_id"]: r["text"] for r in stages.suffix_array_dedup(spark, docs, "").collect()}
    assert got == {0: own[0] + "\n", 1: " " + own[1], 2: own[2], 3: texts[3]}


def test_suffix_stage_cuts_texts_once(spark, docs_of):
    docs = docs_of([f"{i} " + "the same words again " * 40 for i in range(4)])
    out = stages.suffix_array_dedup(spark, docs, "")
    # each ArrowEvalPython of a task holds a Python worker of its own
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert all("the same words again" not in r["text"] for r in out.collect())


def test_buffers_are_given_back_after_the_last_batch_is_freed(monkeypatch):
    held, alive = [], []

    def task(frames):
        for frame in frames:
            out = frame + 1
            held.extend((weakref.ref(frame), weakref.ref(out)))
            yield len(out)

    monkeypatch.setattr(common, "give_back", lambda: alive.append(sum(r() is not None for r in held)))
    assert list(common.giving_back(task)(np.zeros(n) for n in (1, 2, 3))) == [1, 2, 3]
    assert len(held) == 6 and alive == [0]
