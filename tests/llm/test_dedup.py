"""Deduplication, fingerprints and search against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark import session
from loomspark.llm import components, iblt, induced_sorting, mtree, repeats, simhash, suffix_trees

RNG = random.Random(7)
WORDS = [f"w{i}" for i in range(400)]


def corpus():
    """Copies, near copies, shared passages, repeated lines, nulls, empties, repeated rows, ids in no order."""
    passage = " ".join(RNG.choice(WORDS) for _ in range(60))
    texts = [" ".join(RNG.choice(WORDS) for _ in range(RNG.randint(0, 300))) for _ in range(60)]
    texts += texts[:10] * 2
    texts += [t.replace(t.split()[5], "changed", 1) if len(t.split()) > 6 else t for t in texts[:20]]
    texts += [f"{a}\n{passage}\t{b}" for a, b in zip(texts[:25], texts[20:45], strict=True)]
    texts += ["same " * 150, "ab" * 500, "é" * 450, "x", None, "", None, "line one is here\n" * 90]
    ids = list(range(len(texts)))
    RNG.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    return rows + [rows[3], (rows[4][0], texts[70]), (None, texts[0]), (None, None), (None, passage)]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have the names that the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "s", 2, 3) for i, t in ROWS], "doc_id bigint, text string, mark int, spans string, fp int, keys int").repartition(5)


def bag(rows):
    return sorted(map(str, rows))


# -- words -------------------------------------------------------------------------------


def brute_words(rows, window=13):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("limits", [{}, {"group": 60}, {"group": 0, "chunk": 2000}])
def test_substring_dedup(docs, limits):
    got = suffix_trees.substring_dedup(docs, **limits).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert bag(map(tuple, got)) == bag(brute_words(ROWS))


def test_cut_repeats(spark, docs):
    out = suffix_trees.cut_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    want = Counter((d, n - gone) for d, n, gone, _ in brute_words(ROWS))
    assert Counter((r.doc_id, len((r.text or "").encode().split())) for r in out.collect()) == want
    clean = {r.doc_id: r.text for r in out.collect()}
    for (d, t), (_, _, gone, _) in zip(ROWS, brute_words(ROWS), strict=True):
        if gone == 0 and d is not None and d != ROWS[4][0]:
            assert clean[d] == t
    assert suffix_trees.cut_repeats(docs.limit(0)).count() == 0


def test_maximal_repeats():
    found = dict(suffix_trees.maximal_repeats([b"a b c d x", b"z a b c d y", b"b c d q"], 3))
    assert found == {b"a b c d": 2, b"b c d": 3}


def test_suffix_tree_order():
    strings = [np.array([RNG.randint(0, 2) for _ in range(RNG.randint(0, 12))]) for _ in range(30)]
    owner, start, nodes = suffix_trees.suffix_tree(strings, 3)
    suffixes = [tuple(strings[o][s:]) for o, s in zip(owner, start, strict=True)]
    for depth, a, b in nodes:
        assert len({s[:depth] for s in suffixes[a:b]}) == 1 and b - a > 1
    heads = Counter(tuple(strings[i][s : s + 3]) for i in range(30) for s in range(len(strings[i]) - 2))
    outer = {suffixes[a][:3]: b - a for _, a, b in suffix_trees._outermost(nodes)}
    # a string repeated below one branch shows as that deeper node
    assert all(heads[k] == n for k, n in outer.items()) and set(outer) == {k for k, n in heads.items() if n > 1}


# -- bytes -------------------------------------------------------------------------------


def brute_bytes(rows, window=400):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + window] for i in range(len(b) - window + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                edge[i] += 1
                edge[i + window] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("limits", [{}, {"group": 3000}, {"group": 0, "chunk": 5000}])
def test_byte_dedup(docs, limits):
    got = induced_sorting.byte_dedup(docs, **limits).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert bag(map(tuple, got)) == bag(brute_bytes(ROWS))
    assert induced_sorting.byte_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [2, 10_000])
def test_induced_sort(limit):
    """Order and common prefixes, with queues that spill all the time and with none that do."""
    for _ in range(300):
        t = [RNG.randint(1, RNG.choice((1, 2, 4))) for _ in range(RNG.randint(0, 30))]
        order, lcp = induced_sorting.induced_sort(t, limit)
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        for k in range(1, len(t)):
            a, b = t[order[k - 1] :], t[order[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert lcp[k] == n


@pytest.mark.parametrize("unit", [repeats.Words(13), repeats.Octets(40, 16)])
def test_texts_in_a_row(unit):
    """Texts that are hashed in a row get the runs and pieces that each gets alone; no window crosses a border."""
    random = np.random.default_rng(5)
    words = [b"w%d" % i for i in range(9)]
    texts = [random.choice([b" ", b"\t\n "]).join(random.choice(words, n).tolist()) for n in (0, 3, 12, 13, 14, 90, 1, 200, 13)]
    texts[5:5] = [b"\x0b ", b"a b " * 30]
    named = repeats.named_runs(unit, unit.flat(texts), pieces=True)
    first = unit.flat(texts).first
    for i, text in enumerate(texts):
        parts = unit.split(text)
        names = repeats.minimisers(unit, parts)
        start, end = repeats.runs(names)
        mine = named.owner == i
        assert np.array_equal(named.name[mine], names[start])
        assert np.array_equal(named.start[mine] - first[i], start) and np.array_equal(named.end[mine] - first[i], end)
        held = sorted(set(names.tolist()))
        assert sorted(set(named.pieces[1][named.pieces[0] == i].tolist())) == held
        grams = repeats.gram_hashes(unit.symbols(parts), unit.grams[0]) if len(names) else np.zeros(0, np.uint64)
        width = unit.window - unit.grams[0] + 1
        least = [p for p in range(len(grams)) if any(names[j] == grams[p] for j in range(max(0, p - width + 1), min(p + 1, len(names))))]
        assert int((named.pieces[0] == i).sum()) == len(least)


def test_minimisers_agree():
    """Equal windows have equal minimisers wherever they stand."""
    unit = repeats.Words(13)
    body = [w.encode() for w in WORDS[:40]]
    a = repeats.minimisers(unit, [b"x", b"y", *body])
    b = repeats.minimisers(unit, [*body, b"z"])
    assert a[2:].tolist() == b[:-1].tolist()


def test_large_groups(spark):
    """5,000 near copies of one text and 4,000 rows without an id, with groups that fit at once and with none that do."""
    rng = random.Random(3)
    base = [rng.choice(WORDS) for _ in range(60)]
    rows = []
    for i in range(5000):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    rows += [(None, f"{' '.join(base[:30])} n{i % 1000} {' '.join(base[30:])}") for i in range(4000)]
    many = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    for limits in ({}, {"group": 5000}):
        got = suffix_trees.substring_dedup(many, **limits).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert bag(map(tuple, got)) == bag(brute_words(rows))
        got = induced_sorting.byte_dedup(many, window=60, **limits).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert bag(map(tuple, got)) == bag(brute_bytes(rows, 60))


def test_rows_grow_with_the_group(spark):
    """Twice the near copies, twice the rows that go to the groups: no switch on the way."""
    counts = []
    for n in (900, 1800):
        rng = random.Random(4)
        rows = [(i, " ".join(f"x{rng.randrange(9)}" if rng.random() < 0.03 else f"w{k}" for k in range(200))) for i in range(n)]
        texts = repeats.identified(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
        spans = suffix_trees.word_flags(texts).collect()
        counts.append(sum(len(at) for r in spans for at in r.spans))
    assert counts[1] < 2.5 * counts[0]


# -- SimHash -----------------------------------------------------------------------------


def brute_components(rows, bits=3):
    marks = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for (d, _), m in zip(rows, marks, strict=True):
        least[find(m)].append(d)
    pick = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return [(d, m - (1 << 64) if m >> 63 else m, pick[find(m)]) for (d, _), m in zip(rows, marks, strict=True)]


@pytest.mark.parametrize("cap", [4096, 2])
def test_near_duplicates(docs, cap):
    got = simhash.near_duplicates(docs, group_cap=cap).collect()
    assert bag(map(tuple, got)) == bag(brute_components(ROWS))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_fingerprint_by_hand():
    import xxhash

    words = b"the cat sat on the mat".split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(4)]
    want = sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > 4)
    assert simhash.fingerprint(b"The  CAT sat\ton the\x0bmat") == want
    assert simhash.fingerprint(b" \n") == 0 and simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_dense_links(spark):
    """A dense group of near fingerprints is one component and gives few links, at every cap."""
    fps = sorted({RNG.getrandbits(64) for _ in range(50)} | {0b1011 << s for s in range(40)} | {1 << s for s in range(60)})
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    for cap in (4096, 3):
        found = simhash.links(df, group_cap=cap).collect()
        linked = {frozenset((r.a, r.b)) for r in found}
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in map(tuple, linked))
        parent = {f: f for f in fps}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in map(tuple, linked):
            parent[find(a)] = find(b)
        for a in fps:
            for b in fps:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                    assert find(a) == find(b)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (7, 7), (100, 200)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 200: 100, 300: 100}


@pytest.mark.parametrize("block", [8, 1 << 18])
def test_components_of_random_links(spark, block):
    """By rounds, where the links left are more than a block, and by one step."""
    rng = random.Random(3)
    edges = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(170)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5), block=block).collect()}
    assert got == {x: r for x, r in root.items() if x != r}


def test_few_links_take_few_jobs(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    spark.sparkContext.setJobGroup("few-links", "")
    assert components.connected_components(edges).where("root = 0").count() == 200
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-links")) <= 8


def test_shared_minimisers_take_few_files(spark, docs, monkeypatch):
    """Many partitions, as for a large input: results are the same, the table between the passes has fewer files."""
    files = []

    def kept(df, name):
        out = session.written(df, name)
        files.append((name, len(out.inputFiles())))
        return out

    want = bag(map(tuple, induced_sorting.byte_dedup(docs, 40).collect()))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(repeats, "written", kept)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert bag(map(tuple, induced_sorting.byte_dedup(docs, 40).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert dict(files)["shared"] <= 8


# -- sketches ----------------------------------------------------------------------------


def test_fingerprints(spark, docs):
    rows = {}
    for r in iblt.edited_fingerprints(docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    split = lambda t: set(re.findall(r"\S[^\n]*?[.!?](?=\s)|\S[^\n]*", t, re.ASCII))
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    texts = defaultdict(list)
    for d, t in ROWS:
        texts[d].append(t or "")
    ids = sorted(d for d in texts if d is not None)
    by_text = {}
    for k, d in enumerate(ids):
        after = min(texts[ids[(k + 1) % len(ids)]])
        want = []
        for t in texts[d]:
            h = len(t) // 2
            e = t[: len(t) - h] + after[:h]
            want.append((len(t), hashlib.sha256(e.encode()).hexdigest(), round(like(split(t), split(e)), 9), round(like(split(t), split(after)), 9)))
        assert bag((r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows[d]) == bag(want)
        for r in rows[d]:
            if len(texts[d]) == 1:
                assert by_text.setdefault(texts[d][0], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len({frozenset(split(t)) for t in by_text})
    assert len(rows[None]) == 3
    assert iblt.edited_fingerprints(docs.limit(0)).count() == 0


@pytest.mark.parametrize("common,left,right", [(0, 0, 0), (5, 0, 0), (3, 4, 5), (40, 30, 20), (10, 150, 100), (5, 1500, 900)])
def test_peeling(spark, common, left, right):
    """Every size of difference, from none to more than the largest sketch holds."""
    keys = lambda a, n: F.transform(F.sequence(F.lit(a), F.lit(a + n - 1)), lambda x: F.xxhash64(x)) if n else F.array().cast("array<bigint>")
    df = spark.range(1).select(F.concat(keys(0, common), keys(10_000, left)).alias("l"), F.concat(keys(0, common), keys(20_000, right)).alias("r"))
    df = df.select("*", F.expr(iblt.cells("l", 8)).alias("lc"), F.expr(iblt.cells("r", 8)).alias("rc"))
    got = df.select(iblt.likeness("l", "r", "lc", "rc")).first()[0]
    assert got == pytest.approx(common / (common + left + right) if common + left + right else 1.0)


# -- search ------------------------------------------------------------------------------


def test_top_products(spark):
    rng = np.random.default_rng(5)
    vecs = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8)]) for i in rng.permutation(400)]
    vecs += [(1000 + i, vecs[0][1]) for i in range(150)] + [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (2200, [0.5] * 3), (2250, [0.25] * 3), (None, [1.0] * 8)]
    vecs += [(100, [float(x) for x in rng.normal(0, 0.3, 8)]), (100, vecs[3][1]), (150, vecs[5][1]), (150, vecs[5][1]), vecs[7], (300, [2.0] * 8), (300, [2.0] * 8)]
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in vecs], "vec_id bigint, embedding array<double>, v int, part int, copies int")
    scaled = mtree.scaled_vectors(df)
    asked = scaled.where(F.col("vec_id") % 50 == 0)
    ok = [(i, np.floor(np.array(v) * 256)) for i, v in vecs if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for n, (q, v) in enumerate(ok):
        if q % 50 == 0:
            scores = sorted((-int(v @ x), i) for m, (i, x) in enumerate(ok) if m != n and len(x) == len(v))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    for shard in (64, 100_000):
        got = mtree.top_products(scaled, asked, shard_vectors=shard, block=4).collect()
        assert bag(map(tuple, got)) == bag(want)
    assert mtree.top_products(scaled.limit(0), asked.limit(0)).count() == 0


def test_tree_skips_pages():
    """On clustered points the bounds leave most pages unread, and nothing is lost."""
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 100, (40, 6))
    points = np.floor(np.repeat(centers, 200, axis=0) + rng.normal(0, 1, (8000, 6)))
    tree = mtree.MTree(np.arange(8000), points, 6)
    leaves = sum(len(page[3]) for page in tree.pages)
    for q in points[::900]:
        exact = sorted(((-int(q @ x), i) for i, x in enumerate(points)))[:5]
        tree.leaves_read = 0
        assert [(-s, i) for s, i in exact] == tree.search(q, 5, None)
        assert 0 < tree.leaves_read <= leaves / 4
        tree.leaves_read = 0
        assert [(-s, i) for s, i in exact] == tree.search(q, 5, None, floor=float(-exact[4][0]))
        assert tree.leaves_read <= leaves / 4


def test_blocks_visit_few_shards(spark):
    """Between far clusters the roots' bounds leave most shards unvisited; the rows are those of all shards."""
    rng = np.random.default_rng(4)
    centers = rng.normal(0, 1, (12, 6))
    centers *= 200 / np.linalg.norm(centers, axis=1)[:, None]
    points = np.floor(np.repeat(centers, 100, axis=0) + rng.normal(0, 2, (1200, 6)))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, v array<double>")
    asked = df.where("vec_id % 50 = 0")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in mtree.top_products(df, asked, shard_vectors=100, block=8).collect()}
    for q in range(0, 1200, 50):
        exact = sorted((-int(points[q] @ x), i) for i, x in enumerate(points) if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in exact]
    placed = mtree._celled(df.withColumn("copies", F.lit(1).cast("bigint")), mtree._pivots(df, 12))
    shards = mtree._parts(placed, 100)
    n_shards = sum(n for _, n in shards.values())
    trees = mtree._packed(placed, shards, 7, lambda ids, values, *_: mtree.MTree(ids, values, 6))
    floors = placed.where("vec_id % 50 = 0").withColumn("floor", F.lit(38_000.0))
    blocks = mtree._packed(floors, mtree._parts(floors, 8), 13, lambda *rows: rows)
    assert n_shards >= 10 and mtree._routed(trees, blocks, shards).count() < 0.3 * blocks.count() * n_shards


def test_sentences_of_one_line_are_paragraphs(spark):
    """A text of one line whose sentences start with any letter shares what the edit left."""
    text = " ".join(f"{w} sentence number {i} here." for i, w in enumerate(["The", "When", "some", "It", "He", "She", "They", "x"]))
    docs = spark.createDataFrame([(1, text), (2, "Other words. " * 30)], "doc_id bigint, text string")
    near = {r.doc_id: r.near_edited for r in iblt.edited_fingerprints(docs).collect()}
    assert near[1] >= 0.25


def test_sketches_hold_filled_cells_only(spark):
    """A difference has at most three cells a differing digest, whatever the sketch's size; the fingerprint still has all cells."""
    df = spark.createDataFrame([(list(range(100, 140)), list(range(110, 150)))], "l array<bigint>, r array<bigint>")
    keys = {n: f"transform({n}, x -> xxhash64(x))" for n in "lr"}
    df = df.select(*(F.expr(k).alias(n) for n, k in keys.items()))
    for size in iblt.SIZES[1:]:
        apart = iblt._apart("l", "r", size)
        got = df.selectExpr(f"size({apart}) AS cells", f"{iblt._peeled(apart, size)} AS found").first()
        assert got.cells <= 60 and got.found == 20
    few = df.select(F.expr("slice(l, 1, 2)").alias("l"))
    sketch = few.select(F.expr(iblt.cells("l", 8)).alias("c"), iblt.fingerprint(iblt.cells("l", 8)).alias("f")).first()
    assert len(sketch.c) <= 6 and len(sketch.f) == 24 * 36
    assert [i for i in range(24) if sketch.f[i * 36 :][:36] != "0" * 36] == [x.s for x in sketch.c]
    none = spark.sql("SELECT array() :: array<bigint> AS l").select(iblt.fingerprint(iblt.cells("l", 8))).first()[0]
    assert none == "0" * (24 * 36)


def test_byte_dedup_returns_few_files(spark):
    """Many small partitions leave as a file for eight of them; every row is there."""
    docs = spark.createDataFrame([(i, f"{i} " + "same words. " * 40) for i in range(300)], "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 96)
    try:
        got = induced_sorting.byte_dedup(docs)
        assert got.rdd.getNumPartitions() == 12
        assert sorted(r.doc_id for r in got.where("n_removed > 0").collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
