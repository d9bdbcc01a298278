import io

import pytest
from pyspark.sql import functions as F

from loomspark.operators import actors, quality, referential, writing
from loomspark.plans import freeze, key_figures, load_queries, loading
from loomspark.schemas import LEGACY, TABLES
from loomspark.sources import manifest
from loomspark.sources.files import discover, lines, sha1_of
from loomspark.sources.history import read_history
from loomspark.sources.logging_xml import read_namespaces
from loomspark.sources.mysqldump import read_dump
from loomspark.sources.sevenzip import ArchiveError, open_single

from . import fixtures as X


class Tables(dict):
    """Tables read anew on each access, as loads replace their files."""

    def __init__(self, spark, base):
        super().__init__((n, None) for n in TABLES)
        self.spark, self.base = spark, base

    def __getitem__(self, name):
        return writing.read(self.spark, self.base, name)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dumps")
    base = str(root / "tables")
    for t in X.DUMPS:
        with pytest.warns(UserWarning, match="columns of"):
            loading.load_dump(spark, t, X.write_gz(root / f"x-{t}.sql.gz", X.dump_sql(t)), base)
    log = X.write_gz(root / "pages-logging.xml.gz", X.logging_xml().encode())
    counts = loading.load_logging(spark, log, base)
    stub = X.write_gz(root / "stub-meta-history1.xml.gz", X.stub_xml().encode())
    revs = loading.load_revisions(spark, stub, base)
    (root / "pages-meta-history1.xml-p1p9.7z").write_bytes(X.seven_zip(X.history_xml(1, 2, 3).encode()))
    texts = loading.load_texts(spark, str(root / "*.7z"), base)
    return {"root": root, "base": base, "log": log, "counts": counts, "revs": revs, "texts": texts, "t": Tables(spark, base)}


def test_dump_tables(spark, loaded):
    t = loaded["t"]
    restrictions = {r.pr_id: r for r in t["page_restrictions"].collect()}
    assert restrictions[99].pr_page == 7 and restrictions[99].pr_expiry is None and restrictions[98].pr_cascade
    pages = {r.page_id: r for r in t["page"].collect()}
    assert bytes(pages[8].page_title) == "Café's".encode() and pages[8].page_touched is None and pages[8].page_random == 0.001
    assert bytes(t["change_tag"].where("ct_id = 1").first().ct_params) == "é".encode()


def test_logging(loaded):
    rows = {r.log_id: r for r in loaded["t"]["logging"].collect()}
    assert sorted(rows) == [7, 8, 12, 13, 14]
    assert loaded["counts"] == {"written": 5, "no id": 1, "no type": 1, "no timestamp": 1, "bad timestamp": 1}
    assert (rows[7].log_actor, rows[7].log_namespace, bytes(rows[7].log_title), rows[7].log_comment, rows[7].log_deleted) == (None, 3, b"Foo", None, 6)
    assert rows[8].log_params == '{"level":"sysop"}' and rows[8].log_comment == "why" and rows[8].log_page is None
    assert rows[12].log_action == "block" and bytes(rows[12].log_title) == b"X: Y" and rows[12].log_params == '{"0":"edit=sysop"}'
    assert rows[8].log_actor == rows[12].log_actor and rows[13].log_actor is not None
    assert rows[14].log_actor is None and rows[14].log_deleted == 0


def test_resume(spark, loaded):
    before = {r.log_id: r.log_actor for r in loaded["t"]["logging"].collect()}
    assert loading.load_logging(spark, loaded["log"], loaded["base"], resume=True)["written"] == 5
    assert {r.log_id: r.log_actor for r in writing.read(spark, loaded["base"], "logging").collect()} == before


def test_revisions(loaded):
    rows = {r.rev_id: r for r in loaded["t"]["revision"].collect()}
    assert sorted(rows) == [1, 2, 3, 6]
    assert loaded["revs"] == {"written": 4, "no contributor": 1, "bad timestamp": 1}
    assert rows[2].rev_minor and rows[2].rev_parent_id == 1 and rows[1].rev_parent_id is None and not rows[1].rev_minor
    assert rows[3].rev_actor is None and rows[3].rev_comment is None and rows[6].rev_comment == "hi"
    names = {(r.actor_user, bytes(r.actor_name)) for r in loaded["t"]["actor"].collect()}
    assert names == {(87, b"Imke"), (None, b"Tjark"), (310, b"Imke"), (None, b"127.0.0.1")}


def test_texts(spark, loaded, tmp_path):
    assert loaded["texts"] == {"seen": 3, "suppressed": 1, "yielded": 2, "unmatched": 0, "written": 2}
    assert {(r.rev_id, bytes(r.rev_text), r.rev_text_bytes) for r in loaded["t"]["revision_text"].collect()} == {(1, b"moss grows slowly", 17), (3, b"rain fell early", 15)}
    odd = tmp_path / "h.xml"
    odd.write_text(X.history_xml(9990, 9999, 9992).replace("moss grows slowly", "").replace("rain fell early", " grüß "))
    rows = {r.rev_id: r.text for r in read_history(spark, str(odd)).collect()}
    assert rows == {9990: None, 9999: None, 9992: " grüß "}
    assert [tuple(r)[1:] for r in loading.dry_run(spark, "history", str(odd)).collect()] == [(3, 2, 1)]
    assert read_history(spark, str(odd), limit=1).count() == 1


def test_key_figures(spark, loaded):
    t = loaded["t"]
    rows = {n: [tuple(r) for r in f(t).collect()] for n, f in key_figures.FIGURES.items()}
    assert dict(rows["kf01_row_counts"])["logging"] == 5 and len(rows["kf01_row_counts"]) == 10
    assert rows["kf02_pages_by_namespace"] == [(0, 1), (1, 1)]
    assert rows["kf06_protection_by_year"] == [(2021, "protect", 1)]
    assert rows["kf07_recent_protections"][0][1:] == (0, "Donald Trump", '{"level":"sysop"}')
    assert rows["kf08_revisions_by_year"] == [(2020, 4)]
    assert rows["kf09_actors"] == [(2, 2, 4)]
    assert rows["kf10_groups"] == [("sysop", 2), ("bot", 1)]
    assert rows["kf11_top_admins"] == [("Imke", 1)]
    assert [r[-1] for r in rows["kf12_protected_pages"]] == [None, None]
    assert key_figures.kf12_protected_pages(t, normalized=True).first().last_protect_event is not None
    assert key_figures.connection(spark).count() == 1


def test_freeze(spark, loaded, tmp_path):
    out = str(tmp_path / "frozen")
    m = freeze.freeze(spark, loaded["base"], out)
    assert m == freeze.freeze(spark, loaded["base"], out, force=True)
    with pytest.raises(FileExistsError):
        freeze.freeze(spark, loaded["base"], out)
    with pytest.raises(quality.ConstraintError, match="mysqldump"):
        freeze.freeze(spark, str(tmp_path / "none"), str(tmp_path / "o2"))
    texts = loaded["t"]["revision_text"]
    assert freeze.spot_check(texts, texts.select("rev_id", "rev_text")).count() == 0
    assert freeze.spot_check(texts, texts.select("rev_id", F.lit(bytearray(b"x")).alias("rev_text"))).count() == 2
    assert [r.within for r in freeze.count_drift(loaded["t"], {"logging": 5, "page": 3}).orderBy("tbl").collect()] == [True, False]


def test_constraints(spark, loaded, tmp_path):
    rows = loaded["t"]["user_groups"]
    with pytest.raises(quality.ConstraintError, match="2 times"):
        writing.write(rows.unionByName(rows), str(tmp_path), "user_groups")
    with pytest.raises(quality.ConstraintError, match="nulls"):
        writing.write(rows.withColumn("ug_group", F.lit(None).cast("string")), str(tmp_path), "user_groups")
    with pytest.raises(quality.ConstraintError, match="times"):
        writing.write(rows.limit(1), loaded["base"], "user_groups", mode="append")
    assert writing.read(spark, loaded["base"], "user_groups").count() == 3
    with pytest.raises(quality.ConstraintError):
        quality.require_reference(spark.createDataFrame([(5,)], "k int"), spark.createDataFrame([(6,)], "k int"), "k")


def test_actors(spark):
    keys = spark.createDataFrame([(123, b"Imke"), (123, b"Imke"), (None, b"127.0.0.1"), (None, b"127.0.0.1"), (None, b"Imke"), (5, None)], "actor_user bigint, actor_name binary")
    first = actors.assign_ids(actors.distinct_keys(keys), actors.empty_dimension(spark, keys))
    ids = {(r.actor_user, bytes(r.actor_name)): r.actor_id for r in first.collect()}
    assert len(ids) == 3 and sorted(ids.values()) == [1, 2, 3]
    back = actors.assign_ids(actors.distinct_keys(keys.orderBy(F.desc("actor_name"))), actors.empty_dimension(spark, keys))
    assert {(r.actor_user, bytes(r.actor_name)): r.actor_id for r in back.collect()} == ids
    more = keys.unionByName(spark.createDataFrame([(1, b"Zed")], "actor_user bigint, actor_name binary"))
    grown = {(r.actor_user, bytes(r.actor_name)): r.actor_id for r in actors.assign_ids(actors.distinct_keys(more), first).collect()}
    assert grown == ids | {(1, b"Zed"): 4}
    assert actors.unresolved(actors.join_ids(keys, first)).count() == 0


def test_referential(spark):
    have = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "z"), (2, "b"), (None, "m"), (1, "q")], "k int, v string")
    assert sorted(map(str, referential.insert_if_absent(have, new, ["k"]).collect())) == sorted(map(str, [*have.collect(), *new.where("v = 'b'").collect()]))
    ids = spark.createDataFrame([(1,), (5,), (None,)], "k int")
    assert referential.above_watermark(ids, ids.where("k = 1"), "k").count() == 2
    assert referential.above_watermark(ids, ids.where("false"), "k").count() == 3


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x\ny")
    assert list(lines(str(tmp_path / "a.txt"))) == ["x", "y"]
    for n in ("stub-meta-history10.xml", "stub-meta-history2.xml"):
        (tmp_path / n).write_bytes(b"")
    assert [p.rsplit("/")[-1] for p in discover(str(tmp_path / "stub*"))] == ["stub-meta-history2.xml", "stub-meta-history10.xml"]
    data = bytes(range(256)) * 5000
    assert open_single(io.BytesIO(X.seven_zip(data))).read() == data
    with pytest.raises(ArchiveError):
        open_single(io.BytesIO(X.seven_zip(b"x", files=2)))
    with pytest.raises(ArchiveError):
        open_single(io.BytesIO(b"0" * 64))
    with pytest.raises(Exception, match="no dump table"):
        read_dump(spark, "nope", str(tmp_path / "a.txt"), check=False)


def test_manifest(spark, tmp_path):
    (tmp_path / "good").write_bytes(b"abc")
    sha = sha1_of(str(tmp_path / "good"))
    status = '{"jobs": {"j1": {"files": {"w-page.sql.gz": {"size": 3, "sha1": "%s"}, "x": {"size": 1}}}, "j2": {"files": {"x": {"size": 9, "sha1": "s"}, "w-sha1sums.txt": {"size": 1}}}}}' % sha
    (tmp_path / "s.json").write_text(status)
    files = manifest.read_manifest(spark, str(tmp_path / "s.json"))
    assert {r.file: (r.job, r.size) for r in files.collect()} == {"w-page.sql.gz": ("j1", 3), "x": ("j2", 9), "w-sha1sums.txt": ("j2", 1)}
    assert [r.file for r in manifest.select_files(files, 1, ["x"]).collect()] == ["x"]
    with pytest.raises(ValueError, match="zzz"):
        manifest.select_files(files, 1, ["zzz", "x"])
    with pytest.raises(ValueError, match="user_groups.sql.gz.*pages-logging"):
        manifest.select_files(files, 1)
    paths = spark.createDataFrame([(str(tmp_path / "good"),), (str(tmp_path / "gone"),)], "path string")
    seen = manifest.hashed_files(spark, paths).withColumn("file", F.when(F.col("path").endswith("good"), "w-page.sql.gz").otherwise("x"))
    assert {r.file: r.state for r in manifest.verified(files, seen).collect()} == {"w-page.sql.gz": "ok", "x": "missing", "w-sha1sums.txt": "missing"}
    assert manifest.merged(files, files.limit(1)).count() == 3 and manifest.to_markdown(files).count("\n") == 5
    states = spark.createDataFrame([(3, "a", 3, "b"), (3, "a", 4, "a"), (3, "a", 2, "a")], "s int, h string, t int, g string").select(quality.file_state(*map(F.col, "shtg")))
    assert [r[0] for r in states.collect()] == ["mismatch", "failed", "partial"]


def test_phases(spark):
    """Each phase adds to the one before."""
    first = [f"w-{t}.sql.gz" for t in manifest.PHASE_TABLES] + ["w-pages-logging.xml.gz", "w-md5sums.txt"]
    second, third = ["w-stub-meta-history1.xml.gz"], ["w-pages-meta-history1.xml-p1p9.7z"]
    rows = [("a", f) for f in first + second + ["w-langlinks.sql.gz", "w-stub-meta-current1.xml.gz"]] + [(manifest.WIKITEXT_JOB, third[0]), ("other", "w-pages-meta-history2.xml-p1p9.7z")]
    files = spark.createDataFrame([(j, f, 1, "s") for j, f in rows], "job string, file string, size bigint, sha1 string")
    chosen = [sorted(r.file for r in manifest.select_files(files, k).collect()) for k in (1, 2, 3)]
    assert chosen == [sorted(first), sorted(first + second), sorted(first + second + third)]
    with pytest.raises(ValueError, match="phase 4"):
        manifest.select_files(files, 4)


def test_workspace_of_a_cluster():
    """Without a shared folder a cluster's session is refused, a local one is not."""
    from types import SimpleNamespace

    from loomspark.session import workspace

    conf = SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))


def test_legacy(spark):
    from datetime import datetime as dt

    pages = spark.createDataFrame([(1, "A", 1, None, False), (2, "B", 0, None, False)], LEGACY["pages"])
    row = lambda i, page, t, gone=False: (i, t, None, page, False, None, "x", 1, None, None, None, gone, False, False)
    revs = spark.createDataFrame([row(1, 1, dt(2020, 1, 1)), row(2, 1, dt(2020, 1, 1)), row(3, 1, dt(2021, 1, 1), None), row(4, 1, dt(2023, 1, 1)), row(5, 2, dt(2020, 1, 1))], LEGACY["revisions"])
    assert [r.revision_id for r in key_figures.latest_talk(pages, revs, "2022-01-01").collect()] == [2]
    assert sorted(r.revision_id for r in key_figures.latest_talk_with_ties(pages, revs, "2022-01-01").collect()) == [1, 2]


def test_stream(spark, tmp_path):
    from loomspark.sources.logging_xml import namespace_map
    from loomspark.streaming.incremental import load_stream, stream_logitems

    folder, base = tmp_path / "in", str(tmp_path / "t")
    folder.mkdir()
    (folder / "a.xml").write_text(X.logging_xml())
    spaces = namespace_map(read_namespaces(spark, str(folder / "a.xml")))
    for _ in range(2):
        load_stream(stream_logitems(spark, str(folder)), base, spaces, str(tmp_path / "c")).awaitTermination(120)
        (folder / "b.xml").write_text(X.logging_xml().replace("<id>14</id>", "<id>15</id>"))
    assert sorted(r.log_id for r in writing.read(spark, base, "logging").collect()) == [7, 8, 12, 13, 14, 15]
    assert writing.read(spark, base, "actor").count() == 2


def test_inserts_stay_short(spark):
    """More rows make more statements, not longer ones; every row stands in one."""
    lines = load_queries._inserts(spark.range(100_000), "page", [F.col("id"), F.lit("NULL")])
    rows = F.size(F.split("value", r"\),\("))
    got = lines.agg(F.max(rows).alias("most"), F.sum(rows).alias("all"), F.count_if(F.col("value").rlike(r"^INSERT INTO `page` VALUES \(.*\);$")).alias("whole"), F.count("value").alias("n")).first()
    assert got.most <= 1000 and got["all"] == 100_000 and got.whole == got.n


def test_spread_dump(spark, tmp_path):
    """The same rows from one task and from many, packed or plain, wherever a range's border falls."""
    statements = [f"INSERT INTO `user_groups` VALUES {','.join(f'({i * 7 + k},{chr(39)}g{k}é{chr(39)},NULL)' for k in range(1 + i % 4))};" for i in range(60)]
    body = ("-- head\n" + "\n".join(statements) + "\nINSERT INTO `other` VALUES (1);").encode()
    packed, plain = X.write_gz(tmp_path / "x.sql.gz", body), tmp_path / "x.sql"
    plain.write_bytes(body)
    want = sorted(map(repr, read_dump(spark, "user_groups", packed).collect()))
    assert len(want) == 60 + 15 * 6
    for parts in (1, 16):
        assert sorted(map(repr, read_dump(spark, "user_groups", packed, spread=parts).collect())) == want
    for size in (1, 17, 100, 10_000):
        from loomspark.sources.mysqldump import spread_dump

        assert sorted(map(repr, spread_dump(spark, "user_groups", str(plain), 3, range_bytes=size if size > 1 else 33).collect())) == want
    for size in (1, 2, 5, 7, 64):
        (tmp_path / "l.txt").write_bytes(b"ab\n\ncde\nf\n\n\ng")
        from loomspark.sources.files import ranges

        assert [x for a, b in ranges(str(tmp_path / "l.txt"), size) for x in lines(str(tmp_path / "l.txt"), a, b)] == ["ab", "", "cde", "f", "", "", "g"]


def test_statements_unpack_in_small_groups(spark, tmp_path):
    """A reader unpacks 4,096 rows or a row group: long statements lie in small groups, none is lost."""
    import pyarrow.parquet as pq

    from loomspark.sources.mysqldump import BATCH_BYTES, spread_dump

    statements = (f"INSERT INTO `user_groups` VALUES {','.join(f'({i * 1000 + k},{chr(39)}g{k}{chr(39)},NULL)' for k in range(1000))};" for i in range(2_000))
    written = spread_dump(spark, "user_groups", X.write_gz(tmp_path / "x.sql.gz", "\n".join(statements).encode()), 1).inputFiles()
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in written]
    assert sum(m.num_rows for m in files) == 2_000
    assert max(m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)) <= 2 * BATCH_BYTES


def test_write_makes_rows_once(spark, tmp_path):
    """The range layout reads its rows twice; what makes them runs once, and nothing is left beside the table."""
    seen = tmp_path / "seen"

    def noted(batches):
        for b in batches:
            with open(seen, "a") as f:
                f.write("x" * b.num_rows)
            yield b

    ids = spark.range(500, numPartitions=2).mapInArrow(noted, "id bigint")
    limits = ids.selectExpr("id AS pr_id", "id % 7 AS pr_page", "'edit' AS pr_type", "'sysop' AS pr_level", "false AS pr_cascade", "CAST(NULL AS timestamp) AS pr_expiry")
    assert writing.write(limits, str(tmp_path / "t"), "page_restrictions").count() == 500
    assert len(seen.read_text()) == 500
    assert not list((tmp_path / "t" / "_staging").iterdir())


def test_publish(spark, loaded):
    loading.publish(spark, loaded["base"], ["page", "actor"])
    assert spark.sql("SELECT count(*) FROM page").first()[0] == loaded["t"]["page"].count()
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED page").collect()}
    assert "rows" in described["Statistics"]
    assert spark.sql("DESCRIBE EXTENDED page page_id").where("info_name = 'distinct_count'").first().info_value != "NULL"
    loading.publish(spark, loaded["base"], ["page"])
    spark.sql("DROP TABLE page")
    spark.sql("DROP TABLE actor")
    assert loaded["t"]["page"].count() > 0


def test_listed_files(spark, tmp_path):
    (tmp_path / "done.csv").write_text("a.7z\n\n b.7z ,x\n")
    done = referential.listed_files(spark, str(tmp_path / "done.csv"))
    files = spark.createDataFrame([("a.7z",), ("c.7z",), ("b.7z",)], "file string")
    assert [r.file for r in referential.pending(files, done, "file").collect()] == ["c.7z"]
