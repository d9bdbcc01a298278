"""Models on held-out rows, and the pipeline on a small corpus."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomspark.llm import langid, queries, secrets, toxicity
from loomspark.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF, "documents")


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_langid(spark, docs):
    rows = langid.op3_langid(spark, SF).toPandas()
    truth = docs.select("doc_id", "lang").toPandas().set_index("doc_id").lang
    assert (rows.held_out == rows.doc_id.map(lambda i: fold(i, 5) == 0)).all()
    held = rows[rows.held_out]
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.97
    assert rows.score.between(0, 1).all() and rows.rejected.mean() < 0.01


def test_langid_edges(spark, docs):
    model = langid.fit(langid.labelled_sample(docs, rows=200))
    odd = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "123 ²½ !!", 1.0), (None, "the and of the there", 1.0)], "doc_id bigint, text string, score double")
    rows = {r.doc_id: r for r in langid.predictions(odd, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[None].lang_pred == "en"
    for text in ("² " * 7, "² " * 8, "½²³ " * 5000, "1²" * 40):
        assert model.predict(text) == ("und", 0.0, True)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() >= docs.count() - 5
    assert langid.identify(docs.limit(0)).count() == 0
    assert langid.fit([]).predict("text") == ("und", 0.0, True) and langid.fit([("a b", "en")]).predict("x")[0] == "en"


def test_langid_learns_from_its_folds_only(docs):
    """The rows of fold 0 could say anything."""
    false = docs.withColumn("lang", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, "xx").otherwise(F.col("lang")))
    assert langid.labelled_sample(false) == langid.labelled_sample(docs)


def test_toxicity(spark, docs):
    rows = toxicity.op10_toxicity(spark, SF).toPandas()
    truth = read_table(spark, SF, "labels").toPandas().set_index("doc_id").toxic
    assert len(rows) == docs.count() and (rows.held_out == rows.doc_id.map(lambda i: fold(i, 3) == 1)).all()
    assert ((rows.score >= 0.7) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    held = rows[rows.held_out & rows.doc_id.isin(truth.index)]
    y = held.doc_id.map(truth)
    assert held[y == 0].predicted.mean() < 0.03
    assert held[y == 1].score.mean() > held[y == 0].score.mean() + 0.3


def test_toxicity_recall(spark):
    """Nine in ten held-out toxic documents at the larger size, and of the others next to none."""
    sf = SF.replace("0.01", "0.1")
    rows = toxicity.op10_toxicity(spark, sf).toPandas()
    truth = read_table(spark, sf, "labels").toPandas().set_index("doc_id").toxic
    held = rows[rows.held_out & rows.doc_id.isin(truth.index)]
    y = held.doc_id.map(truth)
    assert held[y == 1].predicted.mean() >= 0.9 and held[y == 0].predicted.mean() < 0.01


def test_threats_need_intent_and_target():
    g = toxicity.Grammar()
    score = lambda t: g.features(t)[2]
    assert score("i will kill you") > 0 and score("we are going to hurt them") > 0
    assert score("i will not kill you") < score("i will kill you") and score("he said i will kill you") < score("i will kill you")
    assert score("frost can kill plants") == score("i will kill time") == score("you will see") == 0


def brute_paths(machines, words):
    """Every path through the cascade, machine by machine."""
    import math

    def strings(machine, symbols):
        paths = [(machine.start, (), ())]
        for x in symbols:
            paths = [(to, (*out, o), (*ws, w)) for at, out, ws in paths for o, w, to in machine.step(at, x)]
        return [(out, ws) for at, out, ws in paths if machine.ends(at)]

    every = [(tuple(s for s, _ in words), (0.0,) * len(words))]
    for m in machines:
        every = [(out, tuple(map(sum, zip(ws, more, strict=True)))) for symbols, ws in every for out, more in strings(m, symbols)]
    marks = (toxicity.INSULT, toxicity.THREAT)
    return max((sum(v * math.exp(w) if o in marks else w for o, w, (_, v) in zip(out, ws, words, strict=True)) for out, ws in every), default=0.0)


def test_composition_against_all_paths():
    import random

    rng = random.Random(2)
    ct = toxicity.context_transducer
    machines = [toxicity.insult_transducer(), toxicity.threat_transducer(), ct(toxicity.TARGET, 3, 0.15, 0.3), ct(toxicity.NEGATION, 2, -0.9, 0.0), ct(toxicity.REPORT, 6, -0.7, -0.2)]
    for _ in range(300):
        words = [(rng.randrange(7), rng.choice((1.0, 2.5))) for _ in range(rng.randint(0, 9))]
        assert toxicity.best_path(toxicity.grammar(), words) == pytest.approx(brute_paths(machines, words))


def test_clauses_not_words():
    """Negation and reported speech weaken an insult, a target strengthens it."""
    g = toxicity.Grammar({"fool": 3.0})
    score = lambda t: g.features(t)[2]
    assert score("you are a fool") > score("a fool") > score("he said fool") > 0
    assert score("a fool") > score("not a fool") > 0 and score("nothing here") == 0
    assert score("never. a fool") == score("a fool")
    assert g.score(None) == g.score("") <= 0.5
    same = toxicity.Grammar({"fool": 3.0})
    same.__setstate__(g.__getstate__())
    assert same.score("fool") == g.score("fool")


def test_toxicity_edges(spark):
    odd = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (None, "fool", "c")], "doc_id bigint, text string, score string")
    assert toxicity.scores(odd, toxicity.Grammar()).count() == 3 and toxicity.scores(odd.limit(0), toxicity.Grammar()).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.fit(toxicity.labelled_sample(odd, labels)).score("x") < 0.7


def test_pipeline(spark, docs, tmp_path):
    base = docs.where("doc_id < 150")
    rows = base.unionByName(base.limit(20).withColumn("doc_id", F.col("doc_id") + 5000))
    rows = rows.unionByName(spark.createDataFrame([(9001, None, "en", "s", None), (9002, "", None, None, 0), (None, "words without an id here", "en", "s", 5), (9003, "password=abcdef123456 " + "fresh " * 3, "en", "s", 40)], docs.schema))
    seen = {}
    at = rows
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, at, SF), name)
        seen[name] = out
        if name != "packing":
            assert out.columns == docs.columns
        at = out
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in seen.items()}
    assert not {9001, 9002} & ids["language_id"] and None in ids["language_id"] and len(ids["language_id"]) >= rows.count() - 6
    assert not [i for i in ids["near_dedup"] if i and 5000 <= i < 9000] and ids["near_dedup"] >= {0, 9003}
    assert ids["substring_dedup"] == ids["secret_scan"] == ids["packing"] == ids["near_dedup"]
    assert "[secret]" in seen["secret_scan"].where("doc_id = 9003").first().text
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "secret_scan", "packing"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_topk_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.sql(queries.ORACLES["op9_topk"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op9_topk"](spark, SF).collect())) == want


def planted_secrets():
    """(text, start, end, named): clean test documents with one credential put into the middle."""
    import random

    import duckdb

    rng = random.Random(99)
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE length(text) > 200 ORDER BY doc_id").fetchall() if not secrets.base_spans(t)]
    for t in texts[:300]:
        kind = rng.randrange(4)
        own = secrets.short_secret(rng) if kind else secrets.long_secret(rng)
        lead = (" ", f' {rng.choice(secrets.NAMES)} = "', f" the {rng.choice(secrets.NAMES)} is ", " Authorization: Bearer ")[kind]
        at = t.find(" ", len(t) // 2) % (len(t) + 1)
        yield t[:at] + lead + own + ('"' if kind == 1 else "") + t[at:], at + len(lead), at + len(lead) + len(own)


def test_field_adds_to_the_base_patterns():
    """Credentials that the base patterns miss or cut are found whole; clean text is left alone."""
    field, beyond, caught, exact, false = secrets.trained(), 0, 0, 0, 0
    for text, a, b in planted_secrets():
        found = secrets.field_spans(text, field)
        exact += any((s, e) == (a, b) for s, e, _ in found)
        false += sum(e <= a or b <= s for s, e, _ in found)
        if not any(s < b and a < e for s, e, _ in secrets.base_spans(text)):
            beyond += 1
            caught += any(s < b and a < e for s, e, _ in found)
    assert beyond > 100 and caught >= 0.9 * beyond and exact >= 270 and false <= 5
    for text, own in (("a bare AIzaSyD9x8f7GhJk2lmN0pQrStUvWxYz12345678 key", "AIza"), ("pwd: Xy7#kk9! then", "Xy7#kk9"), ('db_pass = "S3cr3tP4ss"', "S3cr3tP4ss")):
        assert any(text[a:b].startswith(own) for a, b, _ in secrets.field_spans(text, field))


def test_stretches_give_the_tags_of_whole_texts():
    field = secrets.trained()
    for text, _, _ in list(planted_secrets())[:120]:
        assert secrets.field_spans(text, field) == secrets.field_spans(text, field, whole=True)


def test_secrets_of_empty_tables(spark, docs):
    assert secrets.scan(docs.limit(0)).count() == 0 and secrets.redact(docs.limit(0)).columns == docs.columns


def test_repeated_rows_leave_the_sample_whole(spark):
    """Rows that stand there hundreds of times count once, before the bound is drawn."""
    from loomspark.llm.common import bounded_sample

    rows = [(i, f"text {i}") for i in range(50)] + [(i, f"text {i}") for i in range(5) for _ in range(400)] + [(None, None)] * 30
    found = bounded_sample(spark.createDataFrame(rows, "doc_id bigint, text string"), 40, 10**9)
    assert len(found) == 40 and len({(r.doc_id, r.text) for r in found}) == 40
    assert len(bounded_sample(spark.createDataFrame(rows, "doc_id bigint, text string"), 100, 10**9)) == 51
    assert 2 <= len(bounded_sample(spark.createDataFrame(rows[:50] * 2, "doc_id bigint, text string"), 40, 20)) <= 4
