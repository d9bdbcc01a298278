"""Freezing a load: checks, key figures, content hashes and a manifest, all below one folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import quality, sampling, writing
from loomspark.schemas import TABLES

from .key_figures import FIGURES

PHASES = {2: tuple(n for n in TABLES if n not in ("revision", "revision_text")), 3: tuple(TABLES)}


def freeze(spark: SparkSession, base: str, out: str, phase: int = 3, force: bool = False, snapshot: bool | None = None) -> dict:
    """Write key figures, the manifest and (by default in phase 2) a copy of the tables to ``out``.

    Every table of the phase must hold rows; an ``out`` that exists is only replaced with ``force``.
    """
    if writing._exists(spark, out) and not force:
        raise FileExistsError(out)
    tables = {n: writing.read_or_empty(spark, base, n) for n in TABLES}
    quality.require_rows({n: tables[n] for n in PHASES[phase]}, {n: TABLES[n].loader for n in TABLES})
    if phase == 3:
        quality.require_at_most(tables["revision_text"], tables["revision"], "revision_text")
    entries = {}
    for name in PHASES[phase]:
        rows, digest = quality.content_hash(tables[name])
        entries[name] = {"rows": rows, "hash": digest, "schema": TABLES[name].ddl}
        if snapshot if snapshot is not None else phase == 2:
            tables[name].write.mode("overwrite").parquet(f"{out}/tables/{name}")
    for name, figure in FIGURES.items():
        figure(tables).coalesce(1).write.mode("overwrite").parquet(f"{out}/figures/{name}")
    manifest = {"phase": phase, "spark": spark.version, "tables": entries}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/manifest")
    return manifest


def spot_check(texts: DataFrame, given: DataFrame, rows: int = 5) -> DataFrame:
    """Sampled stored texts whose hash differs from the given one; empty when all agree.

    ``given`` (rev_id, rev_text) comes from wherever the live text can be had.
    """
    drawn = sampling.spot_rows(texts, rows=rows).select("rev_id")
    return quality.text_mismatches(texts.join(drawn, "rev_id", "left_semi"), given.join(drawn, "rev_id", "left_semi"), "rev_id", "rev_text")


def count_drift(tables: dict[str, DataFrame], expected: dict[str, int], percent: int = 1) -> DataFrame:
    """``(tbl, n, expected, within)`` against published counts."""
    from loomspark.operators.counts import row_counts

    want = F.create_map(*(F.lit(x) for p in expected.items() for x in p))
    found = row_counts({n: tables[n] for n in expected}).withColumn("expected", F.element_at(want, F.col("tbl")).cast("bigint"))
    return found.withColumn("within", quality.within_share(F.col("n"), F.col("expected"), percent))
