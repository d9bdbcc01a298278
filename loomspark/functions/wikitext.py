"""Wikitext to plain text in one pass, by a stack of open constructs.

Rules (ours, where the markup leaves them open):

* Templates, comments, references and tags that hold no prose (math, galleries, ..) leave with
  their contents, all other tags without.  What ``nowiki`` holds stays as it stands.
* A parameter becomes its default, a link its label, else its target; of a file link the
  caption stays, of a category link nothing, of an external link its label.
* Tables lose their marks and attributes and keep the cells.  Bold and italic marks, heading
  marks, list marks and behaviour switches leave; character references become characters.
* An opening mark that is never closed stays as text, and so does what follows it; a closing
  mark that nothing waits for stays as text.  Links nest 16 deep at most.

Every construct removes its own stretch of the output once, so the cost is linear in the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter

#: Tags whose contents are no prose, and those whose contents are no markup (fixed values).
SILENT = frozenset(("categorytree", "ce", "chem", "gallery", "graph", "hiero", "imagemap", "inputbox", "math", "ref", "score", "section", "templatedata", "templatestyles", "timeline"))
RAW = frozenset(("math", "nowiki", "pre", "score", "source", "syntaxhighlight", "templatedata", "timeline", "chem", "ce", "hiero", "graph"))
MOST_LINKS = 16
#: The longest stretch that counts as a tag.
MOST_TAG = 2000

_MARK = re.compile(r"""<!--|\{{2,}|\}{2,}|\n?\{\||\n[ \t]*\|\}|\n[ \t]*\|[-+]|\n[ \t]*[|!]|\|\||!!|\[\[|\]\]|\[(?:https?:|ftp:)?//[^\s\[\]<>"|{}]+|\]|\||'{2,}|</?[A-Za-z]|&(?:[A-Za-z]{2,31}|\#\d{1,7}|\#[xX][0-9A-Fa-f]{1,6});|\n|__[A-Z]{2,30}__""")
_TAG = re.compile(rf"<(/?)([A-Za-z][A-Za-z0-9]*)([^<>]{{0,{MOST_TAG}}})>")
_FILE, _CATEGORY = re.compile(r"\s*(?:file|image|media)\s*:", re.I), re.compile(r"\s*category\s*:", re.I)


class _Open:
    """An open construct: where its output starts, and where what follows its first and last bar does."""

    __slots__ = ("kind", "start", "first", "last")

    def __init__(self, kind: str, start: int):
        self.kind, self.start, self.first, self.last = kind, start, -1, -1


def plain_text(wikitext: str) -> str:
    """The text a reader sees; see the module for the rules."""
    out: list[str] = []
    stack: list[_Open] = []
    open_: Counter[str] = Counter()
    missing: set[str] = set()  # closing marks known not to come again
    at, size = 0, len(wikitext)

    def opened(kind: str, mark: str) -> None:
        stack.append(_Open(kind, len(out)))
        out.append(mark)
        open_[kind] += 1

    def closed() -> _Open:
        open_[stack[-1].kind] -= 1
        return stack.pop()

    def unwound(*kinds: str) -> bool:
        """Whether one of ``kinds`` is on top, after what was left open inside it became text."""
        if not any(open_[k] for k in kinds):
            return False
        while stack[-1].kind not in kinds:
            closed()
        return True

    while at < size:
        found = _MARK.search(wikitext, at)
        if not found:
            out.append(wikitext[at:])
            break
        if found.start() > at:
            out.append(wikitext[at : found.start()])
        mark, at = found.group(), found.end()
        top = stack[-1].kind if stack else ""
        if mark == "<!--":
            end = -1 if "-->" in missing else wikitext.find("-->", at)
            if end < 0:
                missing.add("-->")
                out.append(mark)
            else:
                at = end + 3
        elif mark[0] == "<":
            tag = _TAG.match(wikitext, found.start())
            if not tag:
                out.append(mark)
                continue
            at, name = tag.end(), tag.group(2).lower()
            closing, alone = tag.group(1), tag.group(3).rstrip().endswith("/")
            if closing:
                if name in SILENT and unwound(f"<{name}"):
                    del out[closed().start :]
            elif alone:
                out.append("\n" if name == "br" else "")
            elif name in RAW:
                end = None if name in missing else re.compile(rf"</{name}\s*>", re.I).search(wikitext, at)
                if end is None:
                    missing.add(name)
                else:
                    if name not in SILENT:
                        out.append(wikitext[at : end.start()])
                    at = end.end()
            elif name in SILENT:
                opened(f"<{name}", "")
            elif name == "br":
                out.append("\n")
        elif mark[0] == "{" and mark[1] == "{":
            n = len(mark)
            if n % 2 and n > 1:  # an inner parameter takes three, templates around it two each
                n -= 3
                for _ in range(n // 2):
                    opened("{{", "{{")
                opened("{{{", "{{{")
            else:
                for _ in range(n // 2):
                    opened("{{", "{{")
        elif mark[0] == "}":
            n = len(mark)
            while n >= 2 and unwound("{{", "{{{"):
                frame = closed()
                if frame.kind == "{{{" and n >= 3:
                    n -= 3
                    out[frame.start :] = ["".join(out[frame.first :])] if frame.first >= 0 else []
                else:  # of three opening braces that two close, one is text
                    n -= 2
                    out[frame.start :] = ["{"] if frame.kind == "{{{" else []
            out.append("}" * n)
        elif mark.endswith("{|"):
            if mark[0] == "\n" or not out or out[-1].endswith("\n"):
                line = wikitext.find("\n", at)
                at = size if line < 0 else line  # attributes
                opened("{|", "\n")
            else:
                out.append(mark)
        elif mark[0] == "\n":
            while stack and stack[-1].kind == "[":  # an external link ends with its line
                closed()
            top = stack[-1].kind if stack else ""
            body = mark[1:].lstrip(" \t")
            if not body:
                out.append("\n")
            elif top != "{|" and not (body == "|}" and wikitext[at : at + 1] != "}" and unwound("{|")):
                out.append(mark[: -len(body)])
                at -= len(body)  # the mark has another meaning here
            elif body == "|}":
                closed()
                out.append("\n")
            elif body in ("|-", "|+"):
                line = wikitext.find("\n", at)
                at = at if body == "|+" else size if line < 0 else line
                out.append("\n")
            else:
                out.append("\n")
                stack[-1].first = len(out)
        elif mark in ("||", "!!") and top == "{|":
            out.append(" ")
            stack[-1].first = len(out)
        elif mark == "|" and top == "{|" and stack[-1].first >= 0:
            if any("=" in x for x in out[stack[-1].first :]):
                del out[stack[-1].first :]  # a cell's attributes
            else:
                out.append(mark)
            stack[-1].first = -1
        elif mark[0] == "|" and top in ("{{{", "[["):
            stack[-1].last = len(out)
            if stack[-1].first < 0:
                stack[-1].first = len(out)
            out.append(mark[1:])
        elif mark == "[[":
            if open_["[["] + open_["["] < MOST_LINKS:
                opened("[[", mark)
            else:
                out.append(mark)
        elif mark == "]]" and top == "[[":
            frame = closed()
            head = "".join(out[frame.start + 1 : frame.first if frame.first >= 0 else len(out)])
            if _CATEGORY.match(head):
                del out[frame.start :]
            elif _FILE.match(head):
                out[frame.start :] = ["".join(out[frame.last :])] if frame.last >= 0 else []
            else:
                out[frame.start :] = ["".join(out[frame.first :]) if frame.first >= 0 else head.removeprefix(":")]
        elif mark[0] == "[" and open_["[["] + open_["["] < MOST_LINKS:
            opened("[", mark)
        elif mark[0] == "]" and top == "[":
            frame = closed()
            label = "".join(out[frame.start + 1 :]).strip()
            out[frame.start :] = [label]
            at -= len(mark) - 1
        elif mark[0] == "'":
            n = len(mark)
            out.append("'" * (1 if n == 4 else max(0, n - 5)))
        elif mark[0] == "&":
            out.append(html.unescape(mark))
        elif mark[:2] == "__":
            pass
        else:
            out.append(mark)
    return "\n".join(_line(x) for x in "".join(out).split("\n")).strip()


def _line(line: str) -> str:
    """A line without heading or list marks."""
    bare = line.strip()
    if len(bare) > 2 and bare[0] == "=" and bare[-1] == "=":
        left = len(bare) - len(bare.lstrip("="))
        right = len(bare) - len(bare.rstrip("="))
        if left < len(bare):
            n = min(left, right, 6)
            return bare[n : len(bare) - n].strip()
    return line.lstrip(":*#;").lstrip() if line[:1] in ":*#;" and line else line
