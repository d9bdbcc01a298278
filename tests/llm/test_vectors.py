"""Vector codes and hard negatives against brute force."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.llm import codes, hardneg

BAD = [(9001, 1, None), (9002, 1, []), (9003, 1, [1.0, None] * 4), (9004, 1, [float("nan")] * 8), (9005, 1, [float("inf")] * 8)]


def bag(rows):
    return sorted(map(repr, rows))


def table(spark, rows):
    """Rows (vec_id, label, vector) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, x, v, 0, 1, 2.0) for i, x, v in rows], "vec_id bigint, label int, embedding array<float>, v int, code int, row double")


def floored(rows, width):
    return [(i, x, np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64)) for i, x, v in rows if v is not None and len(v) == width and all(c is not None and np.isfinite(c) for c in v)]


# -- codes -------------------------------------------------------------------------------


def brute_codes(rows, parts, entries, rounds):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    x = np.array([r[2] for r in rows]).reshape(len(rows), parts, -1)
    book = x[:entries].transpose(1, 0, 2).copy()
    near = lambda: np.array([[((p - book[k]) ** 2).sum(axis=1).argmin() for k, p in enumerate(r)] for r in x])
    for _ in range(rounds):
        code = near()
        for k in range(parts):
            for e in range(book.shape[1]):
                own = x[code[:, k] == e, k]
                if len(own):
                    book[k, e] = own.sum(axis=0) // len(own)
    code = near()
    error = [int(sum(((r[k] - book[k, c[k]]) ** 2).sum() for k in range(parts))) for r, c in zip(x, code, strict=True)]
    digest = hashlib.sha256(",".join(map(str, book.ravel())).encode()).hexdigest()
    return [(r[0], "".join(f"{c:02x}" for c in cs), e, sum(f for f, o in zip(error, rows, strict=True) if o[1] == r[1]), digest) for r, cs, e in zip(rows, code, error, strict=True)]


def test_codes(spark):
    """Ties, repeated rows and ids, null labels and ids, other lengths, fewer rows than entries."""
    rng = np.random.default_rng(3)
    rows = [(int(i), [None, 0, 1][i % 3], rng.choice([-0.25, 0.0, 0.25, 0.5], 8).tolist()) for i in rng.permutation(300)]
    rows += [rows[0], (rows[1][0], 2, rows[1][2]), (7, 5, [0.125] * 8), (None, 5, [0.5] * 8)] + [(1000 + i, 1, [0.25] * 8) for i in range(150)]
    odd = BAD + [(0, 1, [1.0] * 7), (9009, 1, [1.0] * 16)]
    df = codes.whole_vectors(table(spark, rows + odd), parts=4)
    for entries, rounds in ((16, 2), (5, 4), (256, 1)):
        got = codes.encoded(df, 4, entries, rounds).collect()
        assert bag(map(tuple, got)) == bag(brute_codes(floored(rows, 8), 4, entries, rounds))
    few = df.where("vec_id < 3")
    assert bag(map(tuple, codes.encoded(few, 4).collect())) == bag(brute_codes([r for r in floored(rows, 8) if r[0] is not None and r[0] < 3], 4, 64, 2))
    assert codes.encoded(df.limit(0), 4).count() == 0
    salted = codes._with_label_error(few.select("vec_id", "label", F.lit("").alias("code"), F.lit(2).cast("bigint").alias("error")), limit=0)
    assert bag((r.vec_id, r.label_error) for r in salted.collect()) == bag((i, 2 * sum(y == x for _, y, _ in few.collect())) for i, x, _ in few.collect())


def test_bounds_spare_scans():
    """On clustered parts most full scans fall away, and no code changes."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (4, 32, 4))
    x = np.stack([centres[k, rng.integers(0, 32, 4000)] + rng.integers(-3, 4, (4000, 4)) for k in range(4)], axis=1)
    book = x[:64].transpose(1, 0, 2).copy()
    code, upper, lower, scanned = codes.assign(x, book)
    assert scanned.all()
    for _ in range(6):
        new = book.copy()
        for k in range(4):
            for e in range(64):
                own = x[code[:, k] == e, k]
                if len(own):
                    new[k, e] = own.sum(axis=0) // len(own)
        moved = np.sqrt(((new - book) ** 2).sum(axis=2).astype(float)) * (1 + codes.SLACK)
        book = new
        code, upper, lower, scanned = codes.assign(x, book, moved, (code, upper, lower))
        away = ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3)
        assert (code == away.argmin(axis=2)).all()
        least = np.sort(away, axis=2)
        assert (upper >= np.sqrt(least[..., 0])).all() and (lower <= np.sqrt(least[..., 1])).all()
    assert scanned.mean() < 0.5


@pytest.mark.parametrize("query, sql", [(codes.op12_codes, codes.OP12_SQL), (hardneg.op13_hardneg, hardneg.OP13_SQL)])
def test_sql(spark, query, sql):
    data = "/root/testdata/sf0.001"
    got = query(spark, data).toArrow()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
    want = con.sql(sql).to_arrow_table().select(got.column_names)
    assert bag(tuple(r.values()) for r in got.to_pylist()) == bag(tuple(r.values()) for r in want.to_pylist())


# -- hard negatives ----------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=3, percent=(50, 95)):
    out = []
    for n, (q, label, v) in enumerate(rows):
        if q % 50:
            continue
        score = [(-int(v @ x), i, y == label) for m, (i, y, x) in enumerate(rows) if m != n]
        for s, i, _ in sorted(r for r in score if r[2])[:positives]:
            fit = sorted(r for r in score if not r[2] and percent[0] * -s <= 100 * -r[0] <= percent[1] * -s)[:negatives]
            out += [(q, i, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(fit)]
    return out


@pytest.mark.parametrize("clustered", [False, True])
def test_negatives(spark, clustered):
    """Ties, repeated rows, a hot vector, a label of few rows, negative scores, one cell or many."""
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 0.4, (8, 6)) if clustered else np.zeros((8, 6))
    rows = [(int(i), int(rng.integers(0, 4)), np.round(centres[i % 8] + rng.normal(0, 0.1 if clustered else 0.3, 6), 2).tolist()) for i in rng.permutation(600)]
    hot = rows[0][2]
    rows += [(2000 + i, i % 3, hot) for i in range(300)] + [rows[1], (100, 1, hot), (100, 1, hot), (5000, 77, [0.5] * 6), (5050, 78, [0.0] * 6), (5100, 9, [-0.5] * 6), (5101, 9, [0.5] * 6)]
    odd = [(i, x, v) for i, x, v in BAD] + [(50, None, [0.5] * 6), (None, 1, [0.5] * 6), (150, 1, [0.5] * 5)]
    df = hardneg.labelled_vectors(table(spark, rows + odd))
    fine = [(i, (x + 1) % 10 if i % 7 == 0 else x, v) for i, x, v in floored(rows, 6)]
    want = bag(brute_negatives(fine))
    assert want
    for options in ({}, {"pivots": 5, "block": 4, "slice_rows": 100}, {"pivots": 1, "block": 3}):
        assert bag(map(tuple, hardneg.mined(df, **options).collect())) == want
    assert hardneg.mined(df.limit(0)).count() == 0


def test_salted_bounds(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BOUNDS_LIMIT", 0)
    rng = np.random.default_rng(9)
    rows = [(i, int(rng.integers(0, 3)), np.round(rng.normal(0, 0.3, 4), 2).tolist()) for i in range(300)]
    fine = [(i, (x + 1) % 10 if i % 7 == 0 else x, v) for i, x, v in floored(rows, 4)]
    got = hardneg.mined(hardneg.labelled_vectors(table(spark, rows)), pivots=6, block=2).collect()
    assert bag(map(tuple, got)) == bag(brute_negatives(fine))


def test_far_candidates_do_not_travel(spark):
    """Between far clusters the bounds leave most candidates where they are."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 0.5, (16, 6))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    points = np.floor((centres[np.arange(1600) % 16] + rng.normal(0, 0.01, (1600, 6))) * 256)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "row bigint, v array<double>")
    top = float((points**2).sum(axis=1).max())
    far = hardneg.farthest_first(np.concatenate([points, np.sqrt(np.maximum(top - (points**2).sum(axis=1), 0))[:, None]], axis=1), 16)
    celled = hardneg._celled(df.withColumn("vec_id", F.col("row")).withColumn("label", F.lit(0).cast("bigint")), far, top, "row % 50 = 0")
    anchors = celled.where("asks")
    groups = hardneg._groups(anchors, [], 16, 2)
    wide = anchors.groupBy("own_cell").agg(F.max("own_d").alias("wide"))
    near = F.col("wide") + 40
    bounds = wide.join(groups, "own_cell").join(hardneg._pivot_distances(spark, far), "own_cell").groupBy("cell", "grp", "blocks")
    bounds = bounds.agg(F.min(F.col("apart") - near).alias("low"), F.max(F.col("apart") + near).alias("high"))
    n_groups = groups.select("grp").distinct().count()
    assert n_groups > 4
    assert hardneg._served(celled, bounds, []).count() < 0.5 * 1600 * n_groups
