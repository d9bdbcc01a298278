"""Wikitext to plain text: golden values, recovery, linear cost."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspark.functions.wikitext import plain_text

GOLDEN = {
    "== H ==\n''it'' [[A|b]] {{x|{{y}}}} <b>c</b><!-- no -->": "H\nit b  c",
    "a {{t|[[x}} b": "a  b",
    "a [[File:x.png|thumb|cap [[b|c]] d]] e": "a cap c d e",
    "[http://x.org] [https://x.org lab el] http://y.org": "lab el http://y.org",
    "{{{1|def}}} {{{2}}}": "def",
    "x<ref name=a>no {{cite}} [[y]]</ref>y<ref name=b/>z": "xyz",
    "<nowiki>[[a]] ''b''</nowiki> c": "[[a]] ''b'' c",
    "{| class=x\n|-\n! h1 !! h2\n|-\n| style=a | c1 || c2\n|}\nafter": "h1   h2\n\n c1   c2\n\nafter",
    "[[unclosed and more": "[[unclosed and more",
    "{{unclosed [[a|b]]": "{{unclosed b",
    "a }} b ]] c": "a }} b ]] c",
    "[[Category:X]]t [[:Category:Y]]": "t Category:Y",
    "&amp; &lt;b&gt; &#233; &nope;": "& <b> é &nope;",
    "* a\n:: b\n# c": "a\nb\nc",
    "'''''bi''''' ''''q''": "bi 'q",
    "{{a\n|b=c\n}}d": "d",
    "{{x|\n|}}y": "y",
    "__TOC__z": "z",
    "a<br/>b<br>c": "a\nb\nc",
    "<math>x^2 [[</math>q": "q",
    "{{{{{a|b}}}|c}}d": "d",
    "a <!-- b": "a <!-- b",
    "a < b > c": "a < b > c",
    "": "",
}


@pytest.mark.parametrize("text", GOLDEN)
def test_golden(text):
    assert plain_text(text) == GOLDEN[text]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab{}[]|<>/!-'=\n&;refh:", max_size=60))
def test_any_markup_is_read(text):
    plain_text(text)


@given(st.text(alphabet="abc .,\n", max_size=80))
def test_text_without_markup_stays(text):
    assert plain_text(text).split() == text.split()


@pytest.mark.parametrize("part", ["{{", "{", "[[", "[http://a ", "<ref>", "{{{a|", "[[a|", "\n|", "{|\n| a", "'", "<!--", "&a"])
def test_linear_on_open_marks(part):
    """A megabyte of marks that nothing closes, then half of them closed."""
    n = 1_000_000 // len(part)
    began = time.perf_counter()
    plain_text(part * n)
    plain_text(part * (n // 2) + "}}]]" * (n // 8))
    assert time.perf_counter() - began < 20
