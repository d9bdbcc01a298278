"""Command line: ``python -m loomspark <step> ..``; exit 0 on success, 1 on a failed check, 2 on bad input."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from loomspark.operators import quality, writing
from loomspark.plans import freeze, key_figures, loading
from loomspark.schemas import TABLES
from loomspark.session import build_session
from loomspark.sources import download, manifest
from loomspark.sources.files import discover

DUMP_TABLES = [n for n, t in TABLES.items() if t.loader == "mysqldump"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomspark", description=__doc__)
    top.add_argument("--master", help="Spark master, where spark-submit sets none")
    top.add_argument("--workers", type=int, help="cores of a local master (default: all), and tasks that parse a dump")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, text: str, base: bool = True) -> argparse.ArgumentParser:
        p = steps.add_parser(name, help=text)
        if base:
            p.add_argument("--base", required=True, help="folder of the tables")
        return p

    p = step("files", "select a phase's files from a status file and verify those in a folder", base=False)
    p.add_argument("--status", required=True)
    p.add_argument("--folder")
    p.add_argument("--phase", type=int, choices=(1, 2, 3), default=3)
    p.add_argument("--files", nargs="*")
    p.add_argument("--status-url", help="fetch the status file from here if the one there is older than a day")
    p.add_argument("--refresh", action="store_true", help="fetch it in any case")
    p.add_argument("--download", metavar="URL", help="fetch the files from below this address into the folder")
    p = step("dump", "load SQL dumps")
    p.add_argument("--folder", required=True)
    p.add_argument("--tables", nargs="*", default=DUMP_TABLES)
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--publish", action="store_true", help="register the loaded tables in the catalog and analyse them")
    for name, text in (("logging", "load the logging XML"), ("stub", "load stub histories"), ("history", "load wikitext histories")):
        p = step(name, text)
        p.add_argument("--files", required=True, help="comma-separated files or globs")
        p.add_argument("--limit", type=int)
        p.add_argument("--dry-run", action="store_true")
        p.add_argument("--publish", action="store_true", help="register the loaded tables in the catalog and analyse them")
        if name == "logging":
            p.add_argument("--resume", action="store_true")
        else:
            p.add_argument("--no-truncate", action="store_true")
        if name == "history":
            p.add_argument("--skip-revision-check", action="store_true")
    p = step("figures", "print the key figures")
    p = step("freeze", "check, count and hash the tables")
    p.add_argument("--out", required=True)
    p.add_argument("--phase", type=int, choices=(2, 3), default=3)
    p.add_argument("--force", action="store_true")
    p = step("run", "load and freeze what a stage of the study needs, one step after the other")
    p.add_argument("stage", choices=[*LOADS, *STAGES])
    p.add_argument("--folder", required=True, help="folder of the dump files")
    p.add_argument("--out", help="folder of the frozen report, for stages that freeze")
    return top


#: What each part of a run calls; files are looked for in the folder.
LOADS = {
    "phase1": (["dump", "--folder", "{folder}"], ["logging", "--files", "{folder}/*-pages-logging.xml.gz"]),
    "phase2": (["stub", "--files", "{folder}/*-stub-meta-history*.xml.gz"],),
    "phase3": (["history", "--files", "{folder}/*-pages-meta-history*.7z"],),
    "freeze2": (["freeze", "--phase", "2", "--out", "{out}/phase2"],),
    "freeze3": (["freeze", "--phase", "3", "--out", "{out}/phase3"],),
}
STAGES = {"through_phase2": ("phase1", "phase2", "freeze2"), "through_phase3": ("phase3", "freeze3"), "all": ("phase1", "phase2", "freeze2", "phase3", "freeze3")}


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.step == "run":
        return _run(a)
    if a.step in ("logging", "stub", "history") and not discover(a.files):
        print(f"no files match {a.files}")
        return 0 if a.dry_run else 2
    cpus = a.workers or "*"
    spark = build_session(cpus) if a.master is None else build_session(cpus, spark__master=a.master)
    try:
        return STEPS[a.step](spark, a)
    except (quality.ConstraintError, FileExistsError) as e:
        print(e, file=sys.stderr)
        return 1
    except (ValueError, FileNotFoundError) as e:
        print(e, file=sys.stderr)
        return 2


def _run(a) -> int:
    """The parts of a stage in turn; the first that fails ends the run with its code."""
    parts = STAGES.get(a.stage, (a.stage,))
    if a.out is None and any(p.startswith("freeze") for p in parts):
        print("--out is needed to freeze", file=sys.stderr)
        return 2
    for part in parts:
        for command in LOADS[part]:
            argv = [w.format(folder=a.folder, out=a.out) for w in command] + ["--base", a.base]
            print(f"{part}: {' '.join(argv)}")
            if code := main([*(["--master", a.master] if a.master else []), *(["--workers", str(a.workers)] if a.workers else []), *argv]):
                return code
    return 0


def _files(spark, a) -> int:
    if a.download and not a.folder:
        raise ValueError("--download needs --folder")
    if a.status_url:
        download.fetch_manifest(a.status_url, a.status, a.refresh)
    chosen = manifest.select_files(manifest.read_manifest(spark, a.status), a.phase, a.files)
    print(manifest.to_markdown(chosen))
    total = chosen.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    print(f"{total.n} files, {total.bytes} bytes")
    if not a.folder:
        return 0
    if a.download:
        fetched = download.download(chosen, a.download, a.folder).collect()  # some hundred files
        for r in sorted(fetched):
            print(r.file, r.state, r.message)
        return int(any(r.state in ("mismatch", "failed") for r in fetched))
    paths = chosen.select(F.concat(F.lit(f"{a.folder}/"), "file").alias("path"))
    seen = manifest.hashed_files(spark, paths).withColumn("file", F.substring_index("path", "/", -1))
    states = {r.state: r.n for r in manifest.verified(chosen, seen).groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
    print(states)
    return int(bool(states.keys() & {"mismatch", "failed"}))


def _dump(spark, a) -> int:
    if unknown := sorted(set(a.tables) - set(DUMP_TABLES)):
        raise ValueError(f"unknown tables: {', '.join(unknown)}")
    plan = {t: ",".join(discover(f"{a.folder}/*-{t}.sql.gz")) for t in a.tables}
    if missing := [t for t, path in plan.items() if not path]:
        raise FileNotFoundError(f"no dump of {', '.join(missing)}")
    for t, path in plan.items():
        print(t, path if a.dry_run else loading.load_dump(spark, t, path, a.base, a.workers).count())
    if a.publish and not a.dry_run:
        loading.publish(spark, a.base, list(plan))
    return 0


def _load(spark, a) -> int:
    if a.dry_run:
        loading.dry_run(spark, "logging" if a.step == "logging" else "history", a.files, a.limit).show(1000, truncate=False)
    elif a.step == "logging":
        print(loading.load_logging(spark, a.files, a.base, a.limit, a.resume))
    elif a.step == "stub":
        print(loading.load_revisions(spark, a.files, a.base, a.limit, a.no_truncate))
    else:
        print(loading.load_texts(spark, a.files, a.base, a.limit, a.no_truncate, not a.skip_revision_check))
    if a.publish and not a.dry_run:
        loading.publish(spark, a.base, {"logging": ["logging", "actor"], "stub": ["revision", "actor"], "history": ["revision_text"]}[a.step])
    return 0


def _figures(spark, a) -> int:
    tables = {n: writing.read_or_empty(spark, a.base, n) for n in TABLES}
    for name, figure in key_figures.FIGURES.items():
        print(name)
        figure(tables).show(1000, truncate=False)
    return 0


def _freeze(spark, a) -> int:
    print(freeze.freeze(spark, a.base, a.out, a.phase, a.force))
    return 0


STEPS = {"files": _files, "dump": _dump, "logging": _load, "stub": _load, "history": _load, "figures": _figures, "freeze": _freeze}

if __name__ == "__main__":
    sys.exit(main())
