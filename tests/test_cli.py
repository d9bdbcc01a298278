from loomspark.__main__ import main
from loomspark.plans import legacy

from . import fixtures as X


def test_commands(spark, tmp_path, capsys):
    base, dumps = str(tmp_path / "t"), tmp_path / "d"
    dumps.mkdir()
    for t in X.DUMPS:
        X.write_gz(dumps / f"w-{t}.sql.gz", X.dump_sql(t))
    X.write_gz(dumps / "w-pages-logging.xml.gz", X.logging_xml().encode())
    X.write_gz(dumps / "w-stub-meta-history1.xml.gz", X.stub_xml().encode())
    (dumps / "w-pages-meta-history1.xml-p1p9.7z").write_bytes(X.seven_zip(X.history_xml(1, 2, 3).encode()))
    assert main(["freeze", "--base", base, "--out", str(tmp_path / "f")]) == 1
    assert main(["dump", "--base", base, "--folder", str(dumps), "--tables", "nope"]) == 2
    assert main(["dump", "--base", base, "--folder", str(tmp_path)]) == 2
    assert main(["dump", "--base", base, "--folder", str(dumps)]) == 0
    assert main(["logging", "--base", base, "--files", f"{dumps}/*logging*", "--dry-run"]) == 0
    assert main(["logging", "--base", base, "--files", f"{dumps}/*logging*"]) == 0
    assert main(["stub", "--base", base, "--files", f"{dumps}/*stub*"]) == 0
    assert main(["history", "--base", base, "--files", f"{dumps}/none*", "--dry-run"]) == 0
    assert main(["history", "--base", base, "--files", f"{dumps}/none*"]) == 2
    assert main(["history", "--base", base, "--files", f"{dumps}/*.7z", "--dry-run"]) == 0
    assert main(["history", "--base", base, "--files", f"{dumps}/*.7z"]) == 0
    assert main(["figures", "--base", base]) == 0
    assert main(["freeze", "--base", base, "--out", str(tmp_path / "f")]) == 0
    assert main(["freeze", "--base", base, "--out", str(tmp_path / "f")]) == 1
    (tmp_path / "s.json").write_text('{"jobs": {"j": {"files": {"w-page.sql.gz": {"size": 1, "sha1": "x"}}}}}')
    assert main(["files", "--status", str(tmp_path / "s.json"), "--phase", "1"]) == 2  # most of the phase is not in the manifest
    assert main(["files", "--status", str(tmp_path / "s.json"), "--files", "w-page.sql.gz"]) == 0
    assert main(["files", "--status", str(tmp_path / "s.json"), "--files", "w-page.sql.gz", "--folder", str(dumps)]) == 1
    both = ["--base", str(tmp_path / "u"), "--folder", str(dumps)]
    assert main(["run", "through_phase2", *both]) == 2 and main(["run", "phase3", *both[:2], "--folder", str(tmp_path)]) == 2
    assert main(["run", "all", *both, "--out", str(tmp_path / "g")]) == 0
    assert main(["run", "freeze2", *both, "--out", str(tmp_path / "g")]) == 1  # frozen already
    assert "kf12_protected_pages" in capsys.readouterr().out


def test_legacy_tables(spark, tmp_path):
    (tmp_path / "h.xml").write_text(X.stub_xml())
    (tmp_path / "m.xml").write_text(X.history_xml())
    talk = legacy.talk_revisions(spark, f"{tmp_path}/h.xml,{tmp_path}/m.xml")
    made = legacy.merge({}, talk)
    assert {n: df.count() for n, df in made.items()} == {"users": 1, "pages": 1, "revisions": 6}
    again = legacy.merge(made, talk)
    assert {n: df.count() for n, df in again.items()} == {"users": 1, "pages": 1, "revisions": 6}
    assert made["revisions"].where("user_id IS NULL").count() == 4
