"""The near-dedup stage of the pipeline against all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from loomspark.llm import near_copies, simhash

SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint"


def planted():
    """Originals, and copies with 1 to 12 scattered edits; some are alike enough, some are not."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for i in range(40):
        text = [word() for _ in range(rng.randint(60, 300))]
        rows.append((i, " ".join(text)))
        for k in range(4):
            copy = list(text)
            for _ in range(rng.randint(1, 12)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((1000 + 10 * i + k, " ".join(copy)))
    return rows + [(5000, rows[0][1]), (5001, ""), (5002, None), (5003, "One two"), (5004, "one  two"), (None, rows[0][1])]


def components(rows):
    """The smallest id of each group over all pairs, from sets of word tuples."""
    sets = {}
    for d, t in rows:
        w = (t or "").lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def test_edited_copies_leave_the_pipeline(spark):
    rows = planted()
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t in rows], SCHEMA).repartition(3)
    want = components([r for r in rows if r[0] is not None])
    assert 10 < sum(1000 <= d < 5000 and r != d for d, r in want.items()) < 150
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == want
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*want.values(), None}
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def large_group(n, length, edits, seed):
    """``n`` copies of one text, each with its own scattered edits, and some texts beside them."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(5000)}" for _ in range(length)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    return rows + [(100_000 + i, " ".join(f"x{rng.randrange(9000)}" for _ in range(50))) for i in range(20)]


@pytest.mark.parametrize("n, length, edits, nodes", [(500, 200, 3, 60), (500, 120, 2, 1024), (400, 120, 3, 1024), (400, 120, 3, 90)])
def test_every_link_of_a_large_group(spark, n, length, edits, nodes):
    """The components are those of all pairs, in one block and in many; the last two have a handful of links."""
    rows = large_group(n, length, edits, 1)
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t in rows], SCHEMA).repartition(3)
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs, nodes=nodes).collect()} == components(rows)


def test_five_thousand_copies(spark):
    rows = large_group(5000, 100, 2, 3)
    sets = [near_copies.shingles(t.encode()).tobytes() for _, t in rows[:5000]]
    alike = near_copies.resemblance(sets)
    links = near_copies.spanning(alike, list(range(5000)))
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t in rows], SCHEMA).repartition(8)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, nodes=700).collect()}
    assert sum(r != d for d, r in got.items()) >= 0.999 * len(links)


def test_resemblance_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(40)]
    got = near_copies.resemblance([s.tobytes() for s in sets], 0.5)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert got[i, j] == (len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.5)


def test_spanning_links():
    alike = np.zeros((6, 6), bool)
    for i, j in ((0, 1), (1, 2), (0, 2), (3, 4)):
        alike[i, j] = alike[j, i] = True
    assert len(near_copies.spanning(alike, [0, 1, 2, 3, 4, 5])) == 3
    # 2 and 3 are joined already: one link joins the rest of both
    assert len(near_copies.spanning(alike, [0, 1, 9, 9, 4, 5])) == 3
    assert near_copies.spanning(alike, [7, 7, 7, 8, 8, 9]) == []


def test_a_link_between_large_components(spark):
    """Two families of many blocks each with a single member between them."""
    rng = random.Random(8)
    left, right = ([f"{c}{rng.randrange(5000)}" for _ in range(200)] for c in "lr")
    middle = left[:100] + right[100:]
    rows = [(i, " ".join([*left[:i], f"e{i}", *left[i + 1 :]])) for i in range(40)] + [(100 + i, " ".join([*right[:i], f"f{i}", *right[i + 1 :]])) for i in range(40)]
    # steps of 20 words from left to right: neighbours are alike, the ends are not
    steps = [left[: 200 - k] + right[200 - k :] for k in range(10, 200, 10)]
    rows += [(200 + k, " ".join(s)) for k, s in enumerate(steps)] + [(500, " ".join(middle))]
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t in rows], SCHEMA)
    want = components(rows)
    assert len(set(want.values())) == 1
    for nodes in (7, 1024):
        assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs, nodes=nodes).collect()} == want


@pytest.mark.parametrize("seed", [23833, 100228522, 200040345, 500012865])
def test_pairs_that_only_fingerprints_join(spark, seed):
    """16 of 20 shingles in common, fingerprints at most three bits apart, and no shared variant of minimum hashes."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(24)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:20])), (3, "other words"), (4, None)]
    marks = [simhash.fingerprint(t.encode(), 5) for _, t in rows[:2]]
    assert (marks[0] ^ marks[1]).bit_count() <= 3
    signatures = np.array([near_copies.symbols(near_copies.shingles(t.encode())) for _, t in rows[:2]])
    assert not set.intersection(*(set(v) for v in near_copies.variants(signatures).tolist()))
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t in rows], SCHEMA)
    want = components(rows)
    assert want[2] == 1
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == want


def test_links_by_fingerprint(spark):
    """All that equal fingerprints and at most three different bits connect, and nothing else."""
    rng = random.Random(4)
    marks = [rng.getrandbits(64) for _ in range(30)]
    marks += [m ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for m in marks for _ in range(3)]
    nodes = [(i, int(np.uint64(m).view(np.int64))) for i, m in enumerate(marks)]
    got = near_copies.by_fingerprint(spark.createDataFrame(nodes, "node bigint, fp bigint")).collect()
    near = np.array([[(a ^ b).bit_count() <= 3 for b in marks] for a in marks])
    linked = np.eye(len(marks), dtype=bool)
    for r in got:
        linked[r.a, r.b] = linked[r.b, r.a] = True
    for m in (near, linked):
        for _ in range(7):
            m |= m @ m
    assert (near == linked).all()
