"""Vector codes: each of a vector's parts by its nearest codebook entry, after Hamerly's Lloyd rounds.

With every vector travel, for each part, its entry, an upper bound on the distance to it
and a lower bound on the distance to the second nearest.  When the entries move, the
bounds move with them; only where the upper one is not strictly below the lower one are
all entries measured, in whole numbers, so a tie always goes to the lower index.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, read_table, spread, written
from .mtree import SCALE

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Labels up to which their error sums are broadcast; beyond, both sides are salted.
LABEL_LIMIT, LABEL_SALTS = 100_000, 16
#: Distances that are held at once in a full scan.
SCAN_CELLS = 1 << 22
#: Relative room of the bounds for rounding.
SLACK = 1e-6


def whole_vectors(table: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v array<bigint>)`` of floor(scale * x), see :func:`encoded` for what is kept."""
    doubles = table.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    fine = doubles.where(f"v IS NOT NULL AND size(v) > 0 AND size(v) % {parts} = 0")
    fine = fine.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return fine.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column, parts: int) -> np.ndarray:
    """A column of equal-length lists as (rows, parts, width)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), parts, -1)


def _scan(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lower index), its squared distance and the second nearest's, for rows of one part."""
    n = len(part)
    best, first, second = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    step = max(1, SCAN_CELLS // (len(book) * book.shape[1]))
    for at in range(0, n, step):
        away = ((part[at : at + step, None, :] - book[None]) ** 2).sum(axis=2)
        rows = np.arange(len(away))
        near = away.argmin(axis=1)
        best[at : at + step], first[at : at + step] = near, away[rows, near]
        if len(book) > 1:
            away[rows, near] = np.iinfo(np.int64).max
            second[at : at + step] = away.min(axis=1)
    return best, first, second


def assign(parts: np.ndarray, book: np.ndarray, moved: np.ndarray | None = None, state=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(code, upper, lower, scanned)`` of ``parts`` (rows, parts, width) by ``book`` (parts, entries, width).

    ``moved`` (parts, entries) is how far each entry went since ``state``, the last result's
    first three; without them every row is scanned.
    """
    n, p, _ = parts.shape
    entries = book.shape[1]
    if state is None:
        code, upper, lower = np.zeros((n, p), np.int64), np.full((n, p), np.inf), np.zeros((n, p))
    else:
        code, upper, lower = (s.copy() for s in state)
        at = np.arange(p)[None, :]
        upper = (upper + moved[at, code]) * (1 + SLACK)
        ordered = np.sort(moved, axis=1)
        widest, next_widest = ordered[:, -1], ordered[:, -2] if entries > 1 else ordered[:, -1]
        own_is_widest = (moved[at, code] == widest[None, :]) & (widest > next_widest)[None, :]
        lower = (lower - np.where(own_is_widest, next_widest[None, :], widest[None, :])) * (1 - SLACK)
    scanned = np.zeros((n, p), bool)
    for k in range(p):
        # half the way to the next entry bounds the second nearest as well
        gaps = ((book[k][:, None, :] - book[k][None]) ** 2).sum(axis=2).astype(float)
        np.fill_diagonal(gaps, np.inf)
        half = np.sqrt(gaps.min(axis=1)) / 2 * (1 - SLACK)
        open_ = np.flatnonzero(upper[:, k] >= np.maximum(lower[:, k], half[code[:, k]]))
        if len(open_) and state is not None:  # the true distance first
            true = np.sqrt(((parts[open_, k] - book[k][code[open_, k]]) ** 2).sum(axis=1).astype(float))
            upper[open_, k] = true * (1 + SLACK)
            open_ = open_[upper[open_, k] >= np.maximum(lower[open_, k], half[code[open_, k]])]
        if len(open_):
            best, first, second = _scan(parts[open_, k], book[k])
            code[open_, k] = best
            upper[open_, k] = np.sqrt(first.astype(float)) * (1 + SLACK)
            lower[open_, k] = np.sqrt(second.astype(float)) * (1 - SLACK)
            scanned[open_, k] = True
    return code, upper, lower, scanned


def distances(parts: np.ndarray, book: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Squared distance of every row to its entries, summed over parts."""
    return ((parts - book[np.arange(book.shape[0])[None, :], code]) ** 2).sum(axis=(1, 2))


def _assigned(rows: DataFrame, book: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """Rows with code, upper and lower, from rows (first round) or the last round's state."""
    p = book.shape[0]

    def run(cols):
        parts = _matrix(cols["v"], p)
        state = None
        if moved is not None:
            code, upper, lower = (np.frombuffer(b"".join(cols[c].to_pylist()), kind).reshape(-1, p) for c, kind in (("code", np.uint8), ("upper", np.float32), ("lower", np.float32)))
            state = (code.astype(np.int64), upper.astype(float), lower.astype(float))
        code, upper, lower, _ = assign(parts, book, moved, state)
        # narrow bounds are rounded outwards
        up, low = np.nextafter(upper.astype(np.float32), np.float32(np.inf)), np.nextafter(lower.astype(np.float32), np.float32(-np.inf))
        return {"vec_id": cols["vec_id"], "label": cols["label"], "v": cols["v"], "code": [r.tobytes() for r in code.astype(np.uint8)], "upper": [r.tobytes() for r in up], "lower": [r.tobytes() for r in low]}

    return map_arrow(rows, run, f"vec_id bigint, label {rows.schema['label'].dataType.simpleString()}, v array<bigint>, code binary, upper binary, lower binary")


def _next_book(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """Entries replaced by the floored mean of their parts; unused ones stay.

    Every batch is summed before the shuffle: at most one row for each part and entry.
    """
    p, entries, width = book.shape

    def run(cols):
        parts = _matrix(cols["v"], p)
        code = np.frombuffer(b"".join(cols["code"].to_pylist()), np.uint8).reshape(-1, p)
        slot = (code + np.arange(p)[None, :] * entries).ravel()
        counts = np.bincount(slot, minlength=p * entries)
        sums = np.zeros((p * entries, width), np.int64)
        np.add.at(sums, slot, parts.reshape(-1, width))
        used = np.flatnonzero(counts)
        return {"slot": used.tolist(), "n": counts[used].tolist(), "s": sums[used].tolist()}

    sums = map_arrow(state.select("v", "code"), run, "slot int, n bigint, s array<bigint>")
    added = sums.groupBy("slot").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("s")[i]) for i in range(width))).alias("s"))
    new = book.reshape(p * entries, width).copy()
    for r in added.collect():  # one row an entry
        new[r.slot] = np.array(r.s, np.int64) // r.n
    return new.reshape(book.shape)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame] | None:
    """The codebooks (parts, entries, width) after ``rounds`` and the rows' last state; None without rows."""
    first = vectors.where("vec_id IS NOT NULL").orderBy("vec_id", "v").limit(1).collect() or vectors.orderBy("v").limit(1).collect()
    if not first:
        return None
    rows = vectors.where(F.size("v") == len(first[0].v))
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    book = np.array([r.v for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    state, moved = spread(rows), None
    for _ in range(rounds):
        state = written(_assigned(state, book, moved), "vectorcodes")
        new = _next_book(state, book)
        moved, book = np.sqrt(((new - book) ** 2).sum(axis=2).astype(float)) * (1 + SLACK), new
    return book, _assigned(state, book, moved)


def encoded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` for every kept row of (vec_id, label, v).

    The codebook of a part starts as that part of the ``entries`` smallest ids' vectors (of
    equal ids the smaller vector first, null ids last); fewer rows give fewer entries.  Ties
    of distance go to the lower index, so of equal entries only the first is used.  Rows of a
    repeated id are rows of their own.  Null vectors, those with null or non-finite
    components, empty ones and those whose length does not divide into ``parts`` or is not
    that of the smallest id's vector leave before.  Null labels are one label.  Components
    must be below 2**24 in size, so that all sums are exact.  Further columns are ignored;
    an empty table gives no rows.  At most 256 entries and two hexadecimal digits each.

    Each round is one pass with the codebooks (parts x entries numbers, no more) as constants.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = vectors.sparkSession
    made = codebooks(vectors.select("vec_id", "label", "v"), parts, entries, rounds)
    out = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    if made is None:
        return spark.createDataFrame([], out)
    book, state = made
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()

    def run(cols):
        code = np.frombuffer(b"".join(cols["code"].to_pylist()), np.uint8).reshape(-1, parts)
        return {"vec_id": cols["vec_id"], "label": cols["label"], "code": [r.tobytes().hex() for r in code], "error": distances(_matrix(cols["v"], parts), book, code).tolist()}

    kind = vectors.schema["label"].dataType.simpleString()
    rows = written(map_arrow(state.select("vec_id", "label", "v", "code"), run, f"vec_id bigint, label {kind}, code string, error bigint"), "vectorerrors")
    return _with_label_error(rows).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _with_label_error(rows: DataFrame, limit: int = LABEL_LIMIT) -> DataFrame:
    """Rows with the error summed over their label; nulls are one label."""
    sums = written(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labelerrors")
    if sums.count() <= limit:
        return rows.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")))
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(LABEL_SALTS)).cast("int")
    copies = sums.withColumn("grain", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    return rows.withColumn("salt", salt).join(copies, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("grain")))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(whole_vectors(read_table(spark, sf_dir, "embeddings")))


def _sql_rounds(rounds: int = ROUNDS, entries: int = ENTRIES) -> str:
    """The rounds in SQL: one table of assignments and one of entries for each."""
    steps = []
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS (
  SELECT p.n, p.part, arg_min(b.entry, (d(p.x, b.x), b.entry)) AS entry, min(d(p.x, b.x)) AS away
  FROM p JOIN b{k} b ON p.part = b.part GROUP BY p.n, p.part
)"""
        )
        if k < rounds:
            steps.append(
                f"""b{k + 1} AS (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY i) AS x FROM (
      SELECT a.part, a.entry, g.i, CAST(floor(sum(p.x[g.i])::DOUBLE / count(*)) AS BIGINT) AS mean
      FROM a{k} a JOIN p ON a.n = p.n AND a.part = p.part CROSS JOIN (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS i) g GROUP BY 1, 2, 3)
    GROUP BY 1, 2) m ON b.part = m.part AND b.entry = m.entry
)"""
            )
    return ",\n".join(steps).replace("d(p.x, b.x)", "CAST(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)")


#: The same rows in DuckDB: every part against every entry, in each round.
OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {PARTS} = 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS n, * FROM kept
  WHERE len(v) = (SELECT len(v) FROM kept ORDER BY vec_id NULLS LAST, v LIMIT 1)
), p AS (
  SELECT n, k AS part, v[k * len(v) // {PARTS} + 1 : (k + 1) * len(v) // {PARTS}] AS x FROM v CROSS JOIN (SELECT unnest(range({PARTS})) AS k)
), b0 AS (
  SELECT part, n - 1 AS entry, x FROM p WHERE n <= {ENTRIES}
), {_sql_rounds()}, c AS (
  SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(away) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY n
), book AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN c USING (n) CROSS JOIN book
"""
