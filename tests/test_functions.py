import json
import math
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.functions import columns as C
from loomspark.functions import mysql, params, talk
from loomspark.functions.mysql import DumpError, Literal, value_tuples

#: Blobs as the two log formats write them, and what they stand for.
PARAMS = [
    ('[["edit=sysop"],{"7d": 0, "1y": 0}]', [["edit=sysop"], {"7d": 0, "1y": 0}]),
    ('{"5::duration": "indefinite", "6::flags": "nocreate"}', {"5::duration": "indefinite", "6::flags": "nocreate"}),
    ('a:1:{i:0;s:10:"edit=sysop";}', {"0": "edit=sysop"}),
    ('a:2:{s:5:"level";s:5:"sysop";s:6:"expiry";s:8:"infinity";}', {"level": "sysop", "expiry": "infinity"}),
    ("edit=sysop\nmove=sysop", {"raw": "edit=sysop\nmove=sysop"}),
    (None, None), ("", None), ("   ", None), ("null", None), ("N;", None),
    ("NaN", "NaN"), ("-Infinity", "-Infinity"), ("[Infinity]", ["Infinity"]), ('{"a":1,"a":2}', {"a": 2}), ("5", 5), ("true", True),
    (" edit=x ", {"raw": " edit=x "}), ('O:3:"Foo":0:{}', {"raw": 'O:3:"Foo":0:{}'}), ("b:1;", True), ("d:0.5;", 0.5),
]


@pytest.mark.parametrize("raw,want", PARAMS)
def test_params(raw, want):
    got = params.parse_params(raw)
    assert (json.loads(got) if got is not None else None) == want


def php(v) -> bytes:
    match v:
        case None:
            return b"N;"
        case bool():
            return b"b:%d;" % v
        case int():
            return b"i:%d;" % v
        case float():
            return b"d:" + repr(v).encode() + b";"
        case str():
            return b's:%d:"%s";' % (len(v.encode()), v.encode())
    return b"a:%d:{%s}" % (len(v), b"".join(php(k) + php(x) for k, x in v.items()))


VALUES = st.recursive(st.none() | st.booleans() | st.integers(-(2**40), 2**40) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8), lambda x: st.dictionaries(st.integers(0, 99) | st.text(min_size=1, max_size=4), x, max_size=4), max_leaves=8)


@settings(max_examples=150, deadline=None)
@given(VALUES)
def test_php_round_trip(v):
    def plain(x):
        return {str(k): plain(y) for k, y in x.items()} if isinstance(x, dict) else x

    got = params.plain(params.PhpReader(php(v)).value())
    if isinstance(v, float):
        assert math.isclose(got, v)
    elif not (isinstance(v, dict) and len({str(k) for k in v}) < len(v)):
        assert got == plain(v)


def bare(payload):
    return [[lit.value for lit in row] for row in value_tuples(payload)]


def test_value_tuples():
    assert bare(r"(1,'a\'b',NULL)") == [[1, "a'b", None]]
    assert bare("('it''s')") == [["it's"]]
    assert bare(r"('a\%b')") == [["a%b"]]
    assert bare(r"""('\0\b\n\r\t\Z\\\"')""") == [['\0\b\n\r\t\x1a\\"']]
    assert bare("(_binary 'é bytes'),(_binary 0xC3A9),(0xC3A9)") == [["é bytes".encode("latin-1")], [b"\xc3\xa9"], [b"\xc3\xa9"]]
    assert bare("(-5,1.5,1e3)") == [[-5, 1.5, 1000.0]]
    assert bare("(1),(2) , (3)") == [[1], [2], [3]]
    assert bare("('a,b);(c')") == [["a,b);(c"]]
    for bad in ("('x", "(1", "(foo)", "1", "(1-2)", "(1 2)"):
        with pytest.raises(DumpError):
            bare(bad)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=255), max_size=20), min_size=1, max_size=4))
def test_escape_round_trip(texts):
    codes = {"\0": "\\0", "'": "\\'", '"': '\\"', "\b": "\\b", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\x1a": "\\Z", "\\": "\\\\"}
    payload = "(" + ",".join("'" + "".join(codes.get(c, c) for c in t) + "'" for t in texts) + ")"
    assert bare(payload) == [texts]


def test_literals_to_values():
    assert mysql.to_instant("20200101000000") == datetime(2020, 1, 1, tzinfo=timezone.utc)
    for raw in (None, "", "infinity", "00000000000000", "2020", "20200230000000", b"infinity"):
        assert mysql.to_instant(raw) is None
    truths = [("int", 0, False), ("int", 2, True), ("str", "\0", True), ("bytes", b"\0", False), ("str", "false", False), ("null", None, None), ("bytes", b"1", True)]
    assert [mysql.to_truth(Literal(k, v)) for k, v, _ in truths] == [w for *_, w in truths]
    assert mysql.to_int(Literal("str", " 5 ")) == 5 and mysql.to_int(Literal("str", " ")) is None
    for bad in (Literal("float", 1.0), Literal("str", "x")):
        with pytest.raises(DumpError):
            mysql.to_int(bad)
    assert mysql.to_text(Literal("str", "Ã©")) == "é" and mysql.to_text(Literal("str", "\xe9")) == "é"
    with pytest.raises(DumpError):
        mysql.converter(("a", "b"), [("a", "int")])([Literal("int", 1)])


def test_created_columns():
    lines = ["CREATE TABLE `t` (", "  `a` int,", "  `b` blob,", "  PRIMARY KEY (`a`)", ");", "INSERT INTO `t` VALUES (1,2);"]
    assert mysql.created_columns(lines, "t") == ["a", "b"]
    assert mysql.created_columns(lines[5:] + lines, "t") == []


def test_columns(spark):
    spaces = F.create_map(F.lit("user talk"), F.lit(3))
    namespace, title = C.split_title("t", spaces)
    rows = spark.createDataFrame([("User talk:Foo",), ("X: Y",), ("Plain",), (None,), ("user TALK:a:b",)], "t string").select(namespace, title)
    assert [tuple(r) for r in rows.collect()] == [(3, "Foo"), (0, "X: Y"), (0, "Plain"), (0, ""), (3, "a:b")]
    raw = spark.createDataFrame([("20200101000000",), ("00001231000000",), ("20200230000000",), ("infinity",), (None,), (" 20200101000000 ",)], "s string")
    assert [r[0] is not None for r in raw.select(C.mw_timestamp("s")).collect()] == [True, False, False, False, False, True]
    iso = spark.createDataFrame([("2020-01-01T00:00:00Z",), ("junk",), ("",)], "s string").select(C.iso_timestamp("s"))
    assert [r[0] is not None for r in iso.collect()] == [True, False, False]
    data = spark.createDataFrame([(bytearray(b"a\\b\x00\xc3\xa9"),), (bytearray(b"plain"),), (None,), (bytearray(b""),)], "b binary").select(C.escaped_bytes("b"))
    assert [r[0] for r in data.collect()] == ["a\\\\b\\000\\303\\251", "plain", None, ""]
    text = spark.createDataFrame([(bytearray("é".encode()),), (bytearray(b"\xe9"),)], "b binary").select(C.utf8_text("b"))
    assert [r[0] for r in text.collect()] == ["é", "é"]
    bits = spark.createDataFrame([(True, True), (False, True), (None, False)], "c boolean, u boolean").select(C.deleted_bits(F.col("c"), F.col("u")))
    assert [r[0] for r in bits.collect()] == [6, 4, 0]
    parts = spark.createDataFrame([("e-stub-meta-history2.xml.gz",), ("e-pages-meta-history10.xml-p5p9.7z",), ("x",)], "n string").select(C.part_number("n"), C.page_start("n"), C.file_kind("n"))
    assert [tuple(r) for r in parts.collect()] == [(2, 0, "stub"), (10, 5, "history"), (0, 0, "other")]


TALK = """== Intro ==
First point. [[User:Ann|Ann]] 10:00, 1 January 2020 (UTC)
:Reply. [[User:Ben|Ben]] 10:05, 1 January 2020 (UTC)
::Nested. [[User:Cat|Cat]] 10:06, 1 January 2020 (UTC)
:Second reply. [[User:Dan|Dan]] 10:07, 1 January 2020 (UTC)
unsigned tail"""


def test_talk(spark):
    rows = list(talk.messages(TALK))
    assert [(r[0], r[1], r[2], r[5], r[6]) for r in rows] == [(1, "Intro", "Ann", None, 0), (2, "Intro", "Ben", 1, 1), (3, "Intro", "Cat", 2, 2), (4, "Intro", "Dan", 1, 1)]
    assert list(talk.messages(None)) == [] and list(talk.messages("[[User talk:A|x]] 10:00, 1 May 2020 (UTC)")) == []
    talk.register_talk(spark)
    spark.createDataFrame([(1, TALK)], "p int, t string").createOrReplaceTempView("talk_pages")
    assert spark.sql("SELECT m.author FROM talk_pages, LATERAL talk_messages(t) m ORDER BY m.id").first().author == "Ann"
    assert talk.plain_text("== H ==\n''it'' [[A|b]] {{x|{{y}}}} <b>c</b><!-- no -->") == "H\nit b  c"


def test_scoring_and_fields(spark):
    from loomspark.functions.scoring import lexicon_scorer, scored

    rows = spark.createDataFrame([("you fool",), (None,), ("fine",)], "t string").select(scored("t", lexicon_scorer({"fool": 1.0})))
    assert [r[0] for r in rows.collect()] == [0.5, None, 0.0]
    js = spark.createDataFrame([('{"5::duration":"1d","level":"sysop"}',), (None,)], "p string")
    assert [tuple(r) for r in js.select(params.param_field("p", "$.level"), params.param_field("p", "$['5::duration']")).collect()] == [("sysop", "1d"), (None, None)]
