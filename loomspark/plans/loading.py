"""Load jobs: from dump files to checked tables below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import quality, referential, transforms, writing
from loomspark.session import written
from loomspark.sources.history import read_history
from loomspark.sources.logging_xml import namespace_map, read_logitems, read_namespaces
from loomspark.sources.mysqldump import read_dump


def load_dump(spark: SparkSession, table: str, path: str, base: str, spread: int | None = None) -> DataFrame:
    """A SQL dump's table.  A gzip file is unpacked by one task; ``spread`` has its statements parsed by so many."""
    return writing.write(read_dump(spark, table, path, spread=spread), base, table)


def publish(spark: SparkSession, base: str, names: list[str]) -> None:
    """Loaded tables as tables of the catalog, with the column statistics that the optimiser uses."""
    for name in names:
        writing.publish(spark, base, name)


def load_logging(spark: SparkSession, path: str, base: str, limit: int | None = None, resume: bool = False) -> dict[str, int]:
    """Logging and actor tables of a logging XML; ``resume`` adds the ids not loaded yet."""
    parsed = transforms.parsed_logitems(read_logitems(spark, path, limit), namespace_map(read_namespaces(spark, path)))
    # not cached: a cached block moves as a whole, and one holds a whole gzip file
    parsed = written(parsed, "logitems")
    counts = {r.reject_reason: r.n for r in transforms.rejects(parsed).collect()}
    if resume:
        parsed = referential.not_loaded(parsed, writing.read_or_empty(spark, base, "logging"), "log_id")
    _, actors = transforms.logging_rows(parsed, writing.read_or_empty(spark, base, "actor"))
    # actors first: a load that stops here leaves ids that the next one finds
    rows, _ = transforms.logging_rows(parsed, writing.write(actors, base, "actor"))
    table = writing.write(rows, base, "logging", "append" if resume else "overwrite")
    return {"written": table.count(), **counts}


def load_revisions(spark: SparkSession, path: str, base: str, limit: int | None = None, append: bool = False) -> dict[str, int]:
    """Revision and actor tables of stub history files."""
    parsed = written(transforms.parsed_revisions(read_history(spark, path, limit)), "revisions")
    counts = {r.reject_reason: r.n for r in transforms.rejects(parsed).collect()}
    _, actors = transforms.revision_rows(parsed, writing.read_or_empty(spark, base, "actor"))
    rows, _ = transforms.revision_rows(parsed, writing.write(actors, base, "actor"))
    table = writing.write(rows, base, "revision", "append" if append else "overwrite")
    return {"written": table.count(), **counts}


def load_texts(spark: SparkSession, path: str, base: str, limit: int | None = None, append: bool = False, check: bool = True) -> dict[str, int]:
    """Wikitext of history files whose revision is known; others are counted and left out."""
    history = read_history(spark, path, limit)
    texts = transforms.revision_texts(history)
    revisions = writing.read_or_empty(spark, base, "revision")
    kept = referential.accepted(texts, revisions, "rev_id") if check else texts
    table = writing.write(kept, base, "revision_text", "append" if append else "overwrite")
    if check:
        quality.require_reference(table, revisions, "rev_id")
    seen = history.agg(F.count(F.lit(1)).alias("seen"), F.count_if("text_deleted").alias("suppressed")).first()
    stored = table.count()
    return {"seen": seen.seen, "suppressed": seen.suppressed, "yielded": seen.seen - seen.suppressed, "unmatched": seen.seen - seen.suppressed - stored, "written": stored}


def dry_run(spark: SparkSession, kind: str, path: str, limit: int | None = None) -> DataFrame:
    """What a load would parse, without writing: counts by reject reason or by file."""
    if kind == "logging":
        parsed = transforms.parsed_logitems(read_logitems(spark, path, limit), namespace_map(read_namespaces(spark, path)))
        return parsed.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    return transforms.parse_counts(read_history(spark, path, limit))
