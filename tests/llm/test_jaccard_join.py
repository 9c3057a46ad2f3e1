"""The similarity join against all pairs."""

import random
import re

from pktsieve.llm import jaccard_join as jj


def shingles(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(texts, ids, percent=90, width=3):
    sets = [shingles(t, width) for t in texts]
    comp = list(range(len(texts)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and ids[i] is not None and ids[j] is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                comp[max(x, y)] = min(x, y)
    least = {}
    for i in range(len(texts)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {(i, ids[i]): (len(sets[i]), None if ids[i] is None else least[find(i)]) for i in range(len(texts))}


def corpus(rnd, groups=12):
    words = [f"w{i}" for i in range(60)]
    common = [rnd.choice(words) for _ in range(25)]
    texts = []
    for g in range(groups):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 12, 40, 90, 400]))]
        if g % 3 == 0:
            base += common
        for _ in range(rnd.randint(1, 9)):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            texts.append(rnd.choice([" ", "\n", "  "]).join(t).title() if rnd.random() < 0.2 else " ".join(t))
    return texts + [None, "", " \n", "É é", "É É", "W1", "w1"]


def test_equals_all_pairs(docs_of, monkeypatch):
    rnd = random.Random(8)
    texts = corpus(rnd)
    ids = rnd.sample(range(10_000), len(texts))
    ids[3] = None
    # clusters cut into blocks; no list short; lists as stars
    for blocks, short, long in ((2048, 8, 10_000), (3, 8, 10_000), (2048, 1, 10_000), (2048, 1, 2)):
        monkeypatch.setattr(jj, "BLOCK_SETS", blocks)
        monkeypatch.setattr(jj, "SHORT", short)
        monkeypatch.setattr(jj, "LONG", long)
        want = brute(texts, ids)
        got = jj.link_documents(docs_of(texts, ids=ids)).drop("text_hash").collect()
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((k[1], *v)) for k, v in want.items())


def test_equals_all_pairs_at_five_words(docs_of):
    """At 80 % of five-word shingles: small sets listed by shingles, and near copies between 0.80 and 0.90."""
    rnd = random.Random(80)
    words = [f"v{i}" for i in range(400)]
    line = [rnd.choice(words) for _ in range(14)]  # a line that many small texts hold
    texts = corpus(rnd)
    for n in [4, 5, 6, 8, 12, 16, 24, 31, 40, 44, 48, 60, 90, 150, 300]:
        for _ in range(4):
            base = [rnd.choice(words) for _ in range(n)] + (line if n < 50 else [])
            for gone in (0, 1, 2, n // 10, n // 7):
                at = rnd.randrange(len(base) - gone + 1)
                texts.append(" ".join(base[:at] + base[at + gone :]))
            at = rnd.randrange(len(base))
            texts.append(" ".join([*base[:at], "new", *base[at + 1 :]]))
    ids = rnd.sample(range(10_000), len(texts))
    want = brute(texts, ids, 80, 5)
    near = sum(v[1] != k[1] for k, v in want.items())
    assert near > 150
    got = jj.link_documents(docs_of(texts, ids=ids), percent=80, width=5).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted((k[1], *v) for k, v in want.items())


def test_every_threshold_has_classes():
    for percent in range(50, 100):
        t = jj.Threshold(percent)
        for size in range(1, 5001):
            for k, n, spare in t.classes(size):
                apart = t.most_apart(t.bounds[k + 1] - 1)
                assert apart >= 1 and (n, spare) == (0, 0) or n == apart + 1 + spare <= 2 * apart + 8


def test_clusters_by_derived_answers_equal_all_pairs():
    import numpy as np

    rnd = random.Random(5)
    t = jj.Threshold(90)
    for _ in range(60):
        base = rnd.sample(range(1000), rnd.choice([8, 20, 60]))
        sets = []
        for _ in range(rnd.randint(2, 25)):
            s = set(base) - set(rnd.sample(base, rnd.choice([0, 1, 2, 4]))) | {rnd.randrange(5000) for _ in range(rnd.choice([0, 1, 3]))}
            sets.append(np.array(sorted(s), dtype=np.uint64))
        comp = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if t.links(both, len(sets[i]) + len(sets[j]) - both):
                    comp = [comp[j] if c == comp[i] else c for c in comp]
        own = list(range(len(sets)))
        for a, b in jj.link_cluster(sets, t):
            own = [own[b] if c == own[a] else c for c in own]
        same = lambda c: {frozenset(i for i, x in enumerate(c) if x == v) for v in c}
        assert same(comp) == same(own)


def test_linked_sets_share_a_list():
    import numpy as np

    rnd = np.random.default_rng(3)
    t = jj.Threshold(90)
    for size in [10, 19, 27, 41, 60, 100, 500, 3000]:
        for _ in range(20):
            x = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
            most = len(x) // 19
            y = np.unique(np.concatenate((x[rnd.permutation(len(x))[most:]], rnd.integers(0, 1 << 63, most, dtype=np.uint64))))
            both = len(np.intersect1d(x, y))
            if t.links(both, len(x) + len(y) - both):
                mine, theirs = dict(jj.signatures(x, t)), dict(jj.signatures(y, t))
                assert np.array_equal(x, y) or any(len(np.intersect1d(mine[k], theirs[k])) for k in mine.keys() & theirs.keys())


def test_bitmaps_never_part_linked_sets():
    import numpy as np

    rnd = np.random.default_rng(6)
    for percent in (60, 80, 90):
        t = jj.Threshold(percent)
        for size in [5, 20, 60, 300, 3000]:
            for _ in range(30):
                x = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
                drop, add = rnd.integers(0, 1 + len(x) * (100 - percent) // 100, 2)
                y = np.unique(np.concatenate((x[rnd.permutation(len(x))[drop:]], rnd.integers(0, 1 << 63, add, dtype=np.uint64))))
                both = len(np.intersect1d(x, y))
                if not t.links(both, len(x) + len(y) - both):
                    continue
                shared = {c[0] for c in t.classes(len(x))} & {c[0] for c in t.classes(len(y))}
                for k in shared | {jj.LOOSE}:
                    maps = np.frombuffer(jj.bitmap(x, t, k) + jj.bitmap(y, t, k), dtype=np.uint64).reshape(2, -1)
                    one = np.zeros(2, dtype=np.int64)
                    assert jj.feasible_pairs(one, np.array([7, 5]), np.array([len(x), len(y)]), maps, t) == {(5, 7)}


def test_long_lists_connect_what_can_link():
    import numpy as np

    rnd = np.random.default_rng(7)
    t = jj.Threshold(80)
    sets = []
    for g in range(6):
        base = rnd.integers(0, 1 << 63, 200, dtype=np.uint64)
        sets += [np.unique(np.concatenate((base[rnd.permutation(200)[:190]], rnd.integers(0, 1 << 63, 5, dtype=np.uint64)))) for _ in range(5)]
    k = t.classes(195)[0][0]
    maps = np.frombuffer(b"".join(jj.bitmap(s, t, k) for s in sets), dtype=np.uint64).reshape(len(sets), -1)
    pairs = jj.feasible_pairs(np.zeros(30, dtype=np.int64), np.arange(30), np.array([len(s) for s in sets]), maps, t)
    own = list(range(30))
    for a, b in pairs:
        own = [own[b] if c == own[a] else c for c in own]
    assert [own.index(c) // 5 for c in own] == [i // 5 for i in range(30)]


def test_empty_table(docs_of):
    assert jj.link_documents(docs_of(["x"]).where("false")).count() == 0
