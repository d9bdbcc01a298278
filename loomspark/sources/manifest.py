"""The dump run's manifest: one row a file, selection by phase, and verification of what is on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.columns import file_kind
from loomspark.operators.quality import file_state
from loomspark.session import ensure_importable

SCHEMA = "jobs map<string, struct<files: map<string, struct<size: bigint, sha1: string, md5: string, url: string>>>>"

#: Dumps that the first phase takes, and the job whose histories the third does (fixed names).
PHASE_TABLES = ("page", "page_restrictions", "protected_titles", "user_groups", "user_former_groups", "change_tag", "change_tag_def")
WIKITEXT_JOB = "metahistory7zdump"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(job, file, size, sha1)`` of a local status file; of a file named twice the last job counts."""
    raw = spark.read.option("multiLine", "true").schema(SCHEMA).json(path)
    jobs = raw.select(F.explode("jobs").alias("job", "body"))
    files = jobs.select("job", F.explode("body.files").alias("file", "f"))
    flat = files.select("file", F.struct("job", F.col("f.size").alias("size"), F.col("f.sha1").alias("sha1")).alias("row"))
    return flat.groupBy("file").agg(F.max("row").alias("row")).select("row.job", "file", "row.size", "row.sha1")


def select_files(files: DataFrame, phase: int, explicit: list[str] | None = None) -> DataFrame:
    """Files of all phases up to ``phase``, with the checksum lists there are; or just those named.

    The first phase has the SQL dumps and the logging XML, the second adds the stub
    histories, the third the wikitext histories of their job.  A file that is named, or
    that the first phase needs, and is not in the manifest is an error.
    """
    name = F.col("file")
    if explicit:
        lacking = sorted(set(explicit) - {r.file for r in files.where(name.isin(explicit)).select("file").collect()})
        wanted = name.isin(explicit)
    elif phase in (1, 2, 3):
        endings = [*(f"-{t}.sql.gz" for t in PHASE_TABLES), "-pages-logging.xml.gz"]
        there = files.agg(*(F.coalesce(F.bool_or(name.endswith(e)), F.lit(False)) for e in endings)).first()
        lacking = [e for e, found in zip(endings, there, strict=True) if not found]
        wanted = name.rlike("(md5|sha1)sums.*txt$")
        for e in endings:
            wanted = wanted | name.endswith(e)
        if phase >= 2:
            wanted = wanted | (name.contains("-stub-meta-history") & name.endswith(".xml.gz"))
        if phase >= 3:
            wanted = wanted | (name.contains("-pages-meta-history") & name.endswith(".7z") & (F.col("job") == WIKITEXT_JOB))
    else:
        raise ValueError(f"phase {phase}")
    if lacking:
        raise ValueError(f"not in the manifest: {', '.join(lacking)}")
    return files.where(wanted).withColumn("kind", file_kind("file"))


def hashed_files(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """``(path, size, sha1)`` of files that executors reach, hashed in chunks, a task's files one after the other."""
    import pyarrow as pa

    ensure_importable(spark)

    def run(batches):
        from loomspark.sources.files import filesystem, sha1_of

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                system, name = filesystem(path)
                info = system.get_file_info(name)
                there = info.is_file
                rows.append((path, info.size if there else None, sha1_of(path) if there else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["path", "size", "sha1"])

    return paths.select("path").mapInArrow(run, "path string, size bigint, sha1 string")


def verified(files: DataFrame, seen: DataFrame) -> DataFrame:
    """The manifest's files with their state: ok, mismatch, failed, partial or missing.

    ``seen`` has (file, size, sha1) of what is on disk.
    """
    s = seen.select("file", F.col("size").alias("seen_size"), F.col("sha1").alias("seen_sha1"))
    both = files.join(s, "file", "left")
    return both.withColumn("state", file_state(F.col("size"), F.col("sha1"), F.col("seen_size"), F.col("seen_sha1")))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Manifest rows by file: new ones replace old ones."""
    return new.unionByName(old.join(new.select("file"), "file", "left_anti"))


def to_markdown(rows: DataFrame) -> str:
    """The manifest table as a report; it has some hundred rows."""
    names = rows.columns
    body = ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.orderBy("file").collect()]
    return "\n".join(["| " + " | ".join(names) + " |", "|" + " --- |" * len(names), *body]) + "\n"


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """The rows of such a report as strings, empty cells as nulls; cells hold no bar."""
    head = spark.read.text(path).first()
    if head is None:
        raise ValueError(f"no table in {path}")
    line = F.col("value")
    cells = F.split(F.regexp_replace(line, r"^\| | \|$", ""), r" \| ")
    rows = spark.read.text(path).where(line.startswith("| ") & (line != F.lit(head.value)) & ~line.rlike(r"^\|( --- \|)+$")).select(cells.alias("c"))
    return rows.select(*(F.nullif(F.col("c")[k], F.lit("")).alias(n) for k, n in enumerate(head.value[2:-2].split(" | "))))


def stored_tables(spark: SparkSession, url: str, tables: list[str], properties: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Tables of an older load in a database, by JDBC."""
    return {t: spark.read.jdbc(url, t, properties=properties or {}) for t in tables}
