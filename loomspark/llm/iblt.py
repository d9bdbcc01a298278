"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame and SQL functions only.

A paragraph's 64-bit digest adds one to a cell of each of three subtables and is XORed,
with a check hash, into it.  Two versions' cells subtract; cells left with a single
digest are peeled, round by round, until the differing digests are all recovered or the
sketch proves too small and a larger one is tried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table, written

#: Cells of a subtable: the fingerprint's own, then those of the retries.
SIZES = (8, 32, 64, 128, 512)
ROUNDS = 24
#: A paragraph ends at a line end or at a sentence end: breaks that content alone decides, so that long lines have several.
PARAGRAPH = r"[^\\s][^\\n]*?[.!?](?=\\s)|[^\\s][^\\n]*"


def digests(text: str) -> Column:
    """The distinct digests of the paragraphs of a text column; white space before one is no part of it."""
    return F.expr(f"array_distinct(transform(regexp_extract_all({text}, '{PARAGRAPH}', 0), x -> xxhash64(x)))")


def _slot(key: str, table: str, size: int) -> str:
    """The cell of a subtable that a digest belongs in: another stretch of its bits for each subtable."""
    return f"CAST(shiftrightunsigned({key}, 20 * {table}) & {size - 1}L AS INT)"


def _entries(keys: str, size: int, n: int) -> str:
    """Entries (s, n, k, c) of a digest array, a list for each subtable: cell, count, digest, check hash."""
    entry = "transform({}, d -> named_struct('s', {} + {}, 'n', {}, 'k', d, 'c', xxhash64(d)))"
    return ", ".join(entry.format(keys, j * size, _slot("d", j, size), n) for j in range(3))


def _summed(entries: str) -> str:
    """The cells that lists of entries add up to, ascending: counts added, digests and check hashes XORed.

    Cells that no entry is in are not made, so the steps go by the entries and not by
    the size of the sketch.  Cells are entries too.
    """
    add = "named_struct('s', x.s, 'n', x.n + e.n, 'k', x.k ^ e.k, 'c', x.c ^ e.c)"
    cell = f"IF(z - a = 1, t[a], aggregate(slice(t, a + 2, z - a - 1), t[a], (x, e) -> {add}))"
    first = "filter(transform(t, (x, i) -> IF(i > 0 AND t[i - 1].s = x.s, -1, i)), i -> i >= 0)"
    # one-element arrays bind what is used more than once
    every = f"transform(slice(b, 1, size(b) - 1), (a, r) -> transform(array(b[r + 1]), z -> {cell})[0])"
    return f"transform(array(sort_array(concat({entries}))), t -> transform(array(array_append({first}, size(t))), b -> {every})[0])[0]"


def _filled(cells: str) -> str:
    """The cells that are not zero."""
    return f"filter({cells}, x -> x.n <> 0 OR x.k <> 0L OR x.c <> 0L)"


def cells(keys: str, size: int) -> str:
    """The sketch of a digest array."""
    return _summed(_entries(keys, size, 1))


def _holds(size: int) -> int:
    """Digests that three subtables of a size peel in nearly all cases."""
    return size * 9 // 4


def _less(left_cells: str, right_cells: str) -> str:
    """The difference of two sketches."""
    return _filled(_summed(f"{left_cells}, transform({right_cells}, x -> named_struct('s', x.s, 'n', -x.n, 'k', x.k, 'c', x.c))"))


def _apart(left: str, right: str, size: int) -> str:
    """The sketch of ``left`` less that of ``right``: cells are sums, so one pass with the right's entries negative makes both and subtracts."""
    return _filled(_summed(f"{_entries(left, size, 1)}, {_entries(right, size, -1)}"))


def _peeled(difference: str, size: int) -> str:
    """How many digests peeling recovers from the difference of two sketches; null if some cells stay filled.

    A round takes the digests that are alone in a cell out of all their cells; only cells
    that stay filled go to the next.
    """
    bits = size.bit_length() - 1

    def alone(n: int) -> str:
        own = f"shiftrightunsigned(x.k, 20 * shiftright(x.s, {bits})) & {size - 1}L = (x.s & {size - 1})"
        return f"array_distinct(transform(filter(v.cells, x -> x.n = {n} AND x.c = xxhash64(x.k) AND {own}), x -> x.k))"

    rest = _filled(_summed(f"v.cells, {_entries('q.more', size, -1)}, {_entries('q.less', size, 1)}"))
    # one-element arrays bind the peeled digests and the cells left once for all their uses
    over = "named_struct('cells', v.cells, 'found', v.found, 'over', true)"
    on = f"transform(array({rest}), w -> named_struct('cells', w, 'found', v.found + size(q.more) + size(q.less), 'over', size(w) = 0))[0]"
    peel = f"transform(array(named_struct('more', {alone(1)}, 'less', {alone(-1)})), q -> IF(size(q.more) + size(q.less) = 0, {over}, {on}))[0]"
    start = f"named_struct('cells', {difference}, 'found', 0, 'over', false)"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (v, i) -> IF(v.over, v, {peel}), v -> IF(size(v.cells) = 0, v.found, NULL))"


def likeness(left: str, right: str, left_cells: str, right_cells: str) -> Column:
    """Share of common digests among all of two digest arrays, from what peeling recovers.

    The base sketches are subtracted first, then larger ones are made until one peels;
    sets that differ in more than the largest holds are compared directly.  A sketch is
    not tried if the sizes rule it out, as the difference is at least theirs, or if by a
    stratum of the digests, a quarter of them by hash, it would not peel: an estimate that is
    too high costs a larger sketch, one that is too low another try.  Two empty sets are alike.
    """
    stratum = "filter({}, d -> (d & 3L) = 0L)"
    a, b = stratum.format(left), stratum.format(right)
    apart = f"(size({a}) + size({b}) - 2 * size(array_intersect({a}, {b})))"
    least = f"greatest(abs(size({left}) - size({right})), 4 * {apart})"
    tries = [f"IF(w > {_holds(SIZES[0])}, NULL, {_peeled(_less(left_cells, right_cells), SIZES[0])})"]
    tries += [f"IF(w > {_holds(size)}, NULL, {_peeled(_apart(left, right, size), size)})" for size in SIZES[1:]]
    direct = f"size(array_except({left}, {right})) + size(array_except({right}, {left}))"
    d = f"transform(array({least}), w -> coalesce({', '.join(tries)}, {direct}))[0]"
    both = f"(size({left}) + size({right}))"
    # d binds once: common = (both - d) / 2, all = (both + d) / 2
    return F.expr(f"transform(array({d}), d -> IF({both} + d = 0, 1.0D, CAST({both} - d AS DOUBLE) / ({both} + d)))[0]")


def fingerprint(base_cells: str) -> Column:
    """The base sketch, cell by cell, in hexadecimal, empty cells in zeros; equal texts have equal ones."""
    gap = lambda after, to: f"repeat('{'0' * 36}', {to} - {after} - 1)"
    cell = "concat(lpad(hex(x.n), 4, '0'), lpad(hex(x.k), 16, '0'), lpad(hex(x.c), 16, '0'))"
    every = f"transform({base_cells}, (x, i) -> concat({gap(f'IF(i = 0, -1, {base_cells}[i - 1].s)', 'x.s')}, {cell}))"
    last = f"IF(size({base_cells}) = 0, -1, {base_cells}[size({base_cells}) - 1].s)"
    return F.expr(f"lower(concat(array_join({every}, ''), {gap(last, 3 * SIZES[0])}))")


def successors(docs: DataFrame) -> DataFrame:
    """``(doc_id, half, next_id)`` over the distinct ids in ascending order, the last followed by the first.

    Ids alone are range-partitioned; a window per range finds the next id, and a table
    with one row a range links the ranges.  ``half`` is the most that any row of the id needs.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.expr("length(text) div 2")).cast("int").alias("half"))
    ranged = written(ids.repartitionByRange(n, "doc_id").withColumn("part", F.spark_partition_id()), "ids")
    own = Window.partitionBy("part").orderBy("doc_id")
    inside = ranged.withColumn("next_id", F.lead("doc_id").over(own))
    firsts = ranged.groupBy("part").agg(F.min("doc_id").alias("least"))
    every = Window.orderBy("part")  # one row a range: bounded by the number of partitions
    ring = firsts.select("part", F.coalesce(F.lead("least").over(every), F.min("least").over(Window.partitionBy())).alias("after"))
    return inside.join(ring, "part").select("doc_id", "half", F.coalesce("next_id", "after").alias("next_id"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``, a row for each input row.

    The edited text ends in the start of the next document's.  Null texts are empty; texts
    of any length are read whole.
    Rows of one id share their successor: the next larger id, of whose rows the one with
    the smallest text counts.  A null id has no next document, so its text is cut
    in half and its likeness to the next is that to an empty text.  One id alone is its
    own successor.  Further columns are ignored; an empty table gives no rows.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.withColumn("keys", digests("text"))
    # one exchange of texts and digests serves both joins, as both want non-null ids
    dealt = keyed.where("doc_id IS NOT NULL").repartition(n, "doc_id")
    first = Window.partitionBy("doc_id").orderBy("text")
    source = dealt.withColumn("nth", F.row_number().over(first)).where("nth = 1")
    wanted = successors(texts).select(F.col("doc_id").alias("for_id"), "half", F.col("next_id").alias("doc_id"))
    tails = source.join(wanted, "doc_id").select(F.col("for_id").alias("doc_id"), F.expr("substring(text, 1, half)").alias("tail"), F.col("keys").alias("next_keys"))
    both = dealt.join(tails, "doc_id", "left").unionByName(keyed.where("doc_id IS NULL"), allowMissingColumns=True)
    half = "length(text) div 2"
    cut = f"concat(substring(text, 1, CAST(length(text) - {half} AS INT)), coalesce(substring(tail, 1, CAST({half} AS INT)), ''))"
    edited = both.select("doc_id", "text", "keys", F.expr(cut).alias("edited"), F.coalesce("next_keys", F.array().cast("array<bigint>")).alias("next_keys"))
    hashed = edited.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "keys", digests("edited").alias("edited_keys"), "next_keys")
    base = {f"{k}_cells": F.expr(cells(f"{k}keys", SIZES[0])) for k in ("", "edited_", "next_")}
    sketched = hashed.select("*", *(c.alias(k) for k, c in base.items()))
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint("_cells").alias("fingerprint"), fingerprint("edited__cells").alias("edited_fingerprint"),
        likeness("keys", "edited_keys", "_cells", "edited__cells").alias("near_edited"), likeness("keys", "next_keys", "_cells", "next__cells").alias("near_next"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))
