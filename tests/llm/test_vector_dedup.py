"""Linked vectors against all pairs."""

import math
import random

import numpy as np

from pktsieve.llm import vector_dedup as vd


def brute(rows, threshold):
    def ok(r):
        i, v, label = r
        return None not in (i, v, label) and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links = {i: set() for i in range(n)}
    for i in range(n):
        for j in range(i):
            if ok(rows[i]) and ok(rows[j]) and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        c = None if rows[i][0] is None else min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(links[i]), c, rows[i][0] is None or rows[i][0] == c))
    return out


def vectors(rnd, n, dim=16):
    rows = []
    for _ in range(n):
        base = [rnd.gauss(0, 1) for _ in range(dim)]
        label = rnd.randint(0, 2)
        for _ in range(rnd.choice([1, 1, 2, 3, 12])):
            noise = rnd.choice([0, 0, 0.05, 0.1, 0.5])
            v = [float(np.float32(x + rnd.gauss(0, noise))) for x in base]
            rows.append((len(rows) * 7 % 1000, v, rnd.choice([label, label, 2])))
    nan, inf = float("nan"), float("inf")
    rows += [
        (2001, None, 1), (2002, [], 1), (2003, [0.0] * dim, 1), (2004, [nan] * dim, 1), (2005, [inf] + [1.0] * (dim - 1), 1),
        (2006, [None] + [1.0] * (dim - 1), 1), (2007, rows[0][1], None), (None, rows[0][1], rows[0][2]), (2008, [1.0, 2.0], 1), (2009, [1.0, 2.0], 1),
    ]
    return rows


def test_links_equal_all_pairs(spark, monkeypatch):
    rnd = random.Random(10)
    rows = vectors(rnd, 40)
    want = brute(rows, 0.93)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string")
    for bucket in (1500, 4):  # 4: buckets are cut into blocks
        monkeypatch.setattr(vd, "BUCKET", bucket)
        got = [tuple(r) for r in vd.link_vectors(df, tables=60).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_recall_and_no_false_links(spark):
    rnd = np.random.default_rng(1)
    base = rnd.standard_normal((300, 32))
    near = base + rnd.standard_normal((300, 32)) * 0.3
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(np.concatenate((base, near)))]
    want = {r[0]: r[1] for r in brute(rows, 0.93)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in vd.link_vectors(df).collect()}
    assert sum(got.values()) >= 0.95 * sum(want.values()) > 0
    assert all(got[i] <= want[i] for i in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vd.link_vectors(df).count() == 0
