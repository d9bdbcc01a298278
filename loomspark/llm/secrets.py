"""Secret scans: fixed patterns plus a linear-chain conditional random field.

The field tags tokens as secret begin, inside or outside from their shape, the words
around them and features of the file; Viterbi decodes.  It is trained here, by gradient
ascent on the likelihood of generated lines, so that no corpus row is needed.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, read_table, spread

#: The base patterns with the least length of what they must match (fixed values).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones never hide a longer one
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "crf")

BEGIN, INSIDE, OUTSIDE = 0, 1, 2
#: Runs of credential characters, with the padding that may end them, and single marks.
_TOKEN = re.compile(r"[A-Za-z0-9+/_.-]+(?:={1,2}(?![A-Za-z0-9=]))?|[^\sA-Za-z0-9+/_.-]")
_KEYWORDS = {"password", "passwd", "pass", "pwd", "passphrase", "passcode", "secret", "token", "apikey", "api_key", "key", "bearer", "basic", "authorization", "credential", "credentials", "auth", "private"}
#: Where the field may leave its outside tag: digits, long unbroken tokens, and names of credentials.
_DIGITS = re.compile(r"[0-9]+")
_LONG = re.compile(r"(?<![A-Za-z+/_.-])[A-Za-z+/_.-]{20,}")
_STEMS = ("pass", "pwd", "secret", "token", "key", "bearer", "basic", "auth", "credential", "private")
_NAME = re.compile("|".join(_STEMS), re.IGNORECASE | re.ASCII)
_NAMED = re.compile(r"(?i)passw|pwd|secret|token|api_?key|bearer|credential|private")
#: Characters of plain text to either side of odd tokens that are decoded with them.
CONTEXT = 160

_ALPHABET, _HEXDIGITS = string.ascii_letters + string.digits, "0123456789abcdef"


def shape(token: str) -> str:
    """A coarse class: what the token is made of, how long it is, and what it starts with."""
    low = token.lower().strip("=:._-")
    if low in _KEYWORDS or low.rsplit("_", 1)[-1] in _KEYWORDS:
        return "keyword"
    if len(token) == 1:
        return "mark" if not token.isalnum() else "short"
    upper, lower = any(c.isupper() for c in token), any(c.islower() for c in token)
    digits = sum(c.isdigit() for c in token)
    n = len(token)
    size = 0 if n < 8 else 1 if n < 16 else 2 if n < 24 else 3 if n < 48 else 4
    marks = any(c in "+/_-=." for c in token)
    if not digits and not (upper and lower and n >= 20 and not token[1:].islower()):
        return f"word{size >= 3}"
    if digits == len(re.sub(r"[-./]", "", token)):
        return f"number{size}"
    if token.count(".") >= 1 and re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", token) and not token.startswith("eyJ") and max(map(len, token.split("."))) < 20:
        return "dotted"
    prefix = next((p for p in ("AKIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "eyJ", "AIza", "glpat-") if token.startswith(p)), "")
    if re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", token):
        return "uuid"
    kinds = "hex" if re.fullmatch(r"[0-9a-f]+", token) else f"{'U' * upper}{'l' * lower}{'d' * bool(digits)}{'m' * marks}"
    share = "few" if digits * 6 < n else "some"
    return f"{kinds}{size}{share}{'!' if prefix else ''}"


def features(tokens: list[str], file: tuple[str, ...]) -> list[list[str]]:
    """What the field sees of each token: shapes of it and its neighbours, neighbouring words, a credential's name before it, the file."""
    shapes = [shape(t) for t in tokens]
    words = ["^", *(t.lower()[:16] for t in tokens), "$"]
    out = []
    for i, s in enumerate(shapes):
        before = shapes[i - 1] if i else "^"
        after = shapes[i + 1] if i + 1 < len(tokens) else "$"
        near = "keyword" in shapes[max(0, i - 4) : i]
        named = "keyword" in shapes[max(0, i - 2) : i]
        out.append([f"s:{s}", f"b:{before}|{s[:4]}", f"a:{after}", f"k:{near}|{s}", f"n:{named}|{s}", f"w:{words[i]}|{s[:2]}", f"x:{words[i + 2]}|{s[:2]}", *(f"f:{x}|{s}" for x in file), "one"])
    return out


def file_features(text: str) -> tuple[str, ...]:
    """Code or prose, and whether a credential is named anywhere."""
    return ("code" if "{" in text or ";" in text else "prose", "named" if _NAMED.search(text) else "unnamed")


class Field:
    """Weights of a linear-chain conditional random field over three tags."""

    def __init__(self):
        self.weights: dict[str, np.ndarray] = {}
        self.trans = np.zeros((3, 3))
        self.trans[OUTSIDE, INSIDE] = -1e4  # inside never starts a secret
        self.start = np.array([0.0, -1e4, 0.0])

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), 3))
        for i, fs in enumerate(rows):
            for f in fs:
                w = self.weights.get(f)
                if w is not None:
                    out[i] += w
        return out

    def fit(self, lines: list[tuple[list[list[str]], list[int]]], epochs: int = 6, rate: float = 0.3) -> Field:
        """Stochastic gradient ascent on the conditional likelihood, forward and backward in logs."""
        rng = random.Random(5)
        order = list(range(len(lines)))
        for epoch in range(epochs):
            rng.shuffle(order)
            step = rate / (1 + epoch)
            for k in order:
                rows, tags = lines[k]
                e = self.emissions(rows)
                n = len(rows)
                alpha, beta = np.zeros((n, 3)), np.zeros((n, 3))
                alpha[0] = self.start + e[0]
                for i in range(1, n):
                    alpha[i] = _logsum(alpha[i - 1][:, None] + self.trans, 0) + e[i]
                for i in range(n - 2, -1, -1):
                    beta[i] = _logsum(self.trans + (e[i + 1] + beta[i + 1])[None, :], 1)
                total = _logsum(alpha[-1], 0)
                belief = np.exp(alpha + beta - total)
                for i in range(n):
                    grad = -belief[i]
                    grad[tags[i]] += 1
                    if np.abs(grad).max() < 0.01:
                        continue
                    for f in rows[i]:
                        w = self.weights.get(f)
                        if w is None:
                            w = self.weights[f] = np.zeros(3)
                        w += step * grad
                        w *= 1 - 1e-4
                for i in range(1, n):
                    pair = np.exp(alpha[i - 1][:, None] + self.trans + (e[i] + beta[i])[None, :] - total)
                    self.trans -= step * 0.2 * np.where(self.trans > -1e3, pair, 0)
                    self.trans[tags[i - 1], tags[i]] += step * 0.2
        return self

    def viterbi(self, rows: list[list[str]]) -> list[int]:
        e = self.emissions(rows)
        best, back = self.start + e[0], []
        for i in range(1, len(rows)):
            through = best[:, None] + self.trans
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + e[i]
        tags = [int(best.argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _picker(rng: random.Random):
    def pick(alphabet: str, a: int, b: int | None = None) -> str:
        return "".join(rng.choice(alphabet) for _ in range(a if b is None else rng.randint(a, b)))

    return pick


def _mixed(rng: random.Random, a: int, b: int | None = None) -> str:
    """Letters of both cases and digits, at least one digit and one letter."""
    n = a if b is None else rng.randint(a, b)
    out = [rng.choice((rng.choice(string.ascii_letters), rng.choice(string.digits), rng.choice(_ALPHABET))) for _ in range(n)]
    i, j = rng.sample(range(n), 2)
    out[i], out[j] = rng.choice(string.digits), rng.choice(string.ascii_letters)
    return "".join(out)


def long_secret(rng: random.Random) -> str:
    """A credential that shows by itself."""
    pick = _picker(rng)
    return rng.choice((
        lambda: pick(_HEXDIGITS, 24, 64), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + _mixed(rng, 36),
        lambda: "sk-" + _mixed(rng, 32, 48), lambda: _mixed(rng, 24, 44), lambda: _mixed(rng, 28, 40) + "==", lambda: "AIza" + _mixed(rng, 35),
        lambda: f"eyJ{_mixed(rng, 20)}.eyJ{_mixed(rng, 30)}.{_mixed(rng, 40)}", lambda: f"xoxb-{pick(string.digits, 11)}-{_mixed(rng, 24)}",
    ))()


def short_secret(rng: random.Random) -> str:
    """A credential that shows only beside its name."""
    return rng.choice((lambda: _mixed(rng, 6, 15), lambda: _mixed(rng, 3, 5) + rng.choice("#!$%&*@") + _mixed(rng, 3, 6), lambda: _mixed(rng, 8, 12) + "=="))()


NAMES = ("password", "pwd", "passwd", "db_pass", "DB_PASSWORD", "token", "auth_token", "api_key", "secret", "client_secret", "key", "private_key", "auth", "passphrase", "credential")


def _generated(n: int, seed: int = 3) -> list[tuple[list[list[str]], list[int]]]:
    """Lines of prose, settings and code with tagged secrets among harmless look-alikes."""
    rng = random.Random(seed)
    pick = _picker(rng)

    def word() -> str:
        w = pick(string.ascii_lowercase, 2, 11)
        return rng.choice((w, w, w, w.capitalize(), w.upper()))

    def harmless() -> str:
        d = lambda a, b=None: pick(string.digits, a, b)
        kind = rng.randrange(14)
        return (
            f"{word()}.{d(2)}@{word()}.example.com", f"{d(2)}.{d(2)}.{d(1)}.{d(3)}", f"+1 ({d(3)}) 555-{d(4)}", d(16), f"20{d(2)}-0{d(1)}-1{d(1)}",
            f"v{d(1)}.{d(2)}.{d(1)}", f"https://{word()}.com/{word()}/{d(5)}", f"{pick(_HEXDIGITS, 8)}-{pick(_HEXDIGITS, 4)}-{pick(_HEXDIGITS, 4)}-{pick(_HEXDIGITS, 4)}-{pick(_HEXDIGITS, 12)}",
            word() + word() + word(), f"{word()}{d(1, 3)}", f"/usr/{word()}/{word()}{d(1)}.so", f"{word()}_{word()}_{word()}", d(1, 9), f"{d(1, 3)}{rng.choice(('px', 'kB', 'th', 'ms', 'GB'))}",
        )[kind]

    out = []
    for _ in range(n):
        parts: list[tuple[str, bool]] = [(word() + rng.choice(("", "", ".", ",")), False) for _ in range(rng.randint(0, 5))]
        kind = rng.randrange(10)
        name, quote = rng.choice(NAMES), rng.choice(("", '"', "'"))
        secret = rng.choice((long_secret, short_secret))(rng)
        if kind < 2:
            parts += [(f"{name}{quote} {rng.choice('=:')} {quote}" if rng.random() < 0.5 else f"{name}{rng.choice('=:')}{quote}", False), (secret, True), (quote, False)]
        elif kind == 2:
            parts += [(rng.choice(("Authorization: Bearer", "Authorization: Basic", f"the {name} is", f"my {name} is:", f"--{name}")), False), (secret, True)]
        elif kind == 3:
            parts += [(f"{word()}://{word()}:", False), (short_secret(rng), True), (f"@{word()}.{word()}/{word()}", False)]
        elif kind == 4:
            parts += [(long_secret(rng), True)]
        elif kind == 5:
            parts += [(rng.choice((f"{name} {word()} {word()}", f"the {name} has {pick(string.digits, 1, 2)} {word()}", f"{word()} {name} {word()} {harmless()}", f"{name}: {word()} {word()}", f"{name}. {word()}")), False)]
        elif kind == 6:
            parts += [(f"{word()} = {quote}{harmless()}{quote}", False)]
        else:
            parts += [(harmless(), False), (word(), False), (harmless(), False)]
        parts += [(word() + rng.choice(("", "", ".", ",")), False) for _ in range(rng.randint(0, 4))]
        tokens, tags = [], []
        for text, own in parts:
            found = _TOKEN.findall(text)
            tokens += found
            tags += [(BEGIN if i == 0 else INSIDE) if own else OUTSIDE for i in range(len(found))]
        if tokens:
            held = any(own for _, own in parts)
            file = ("code" if rng.random() < (0.6 if held else 0.4) else "prose", "named" if kind in (0, 1, 2, 5) or rng.random() < 0.3 else "unnamed")
            out.append((features(tokens, file), tags))
    return out


@lru_cache(maxsize=1)
def trained(lines: int = 2500) -> Field:
    return Field().fit(_generated(lines))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind as listed."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda x: (x[0], x[2]))]


def _odd(text: str) -> list[tuple[int, int]]:
    """Parts of tokens that may be a secret or name one, in order; most texts have few."""
    spots = [m.span() for m in _DIGITS.finditer(text)]
    low = text.lower()
    if any(x in low for x in _STEMS):
        spots += [m.span() for m in _NAME.finditer(text)]
    if max(map(len, text.split()), default=0) >= 20:
        spots += [m.span() for m in _LONG.finditer(text)]
    return sorted(spots)


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of whole tokens that reach ``CONTEXT`` characters around every odd token."""
    first = last = None
    for a, b in _odd(text):
        if first is not None and a - last > 2 * CONTEXT:
            yield _widened(text, first, last)
            first = None
        first, last = (a, b) if first is None else (first, max(last, b))
    if first is not None:
        yield _widened(text, first, last)


def _widened(text: str, a: int, b: int) -> tuple[int, int]:
    a, b = max(0, a - CONTEXT), min(len(text), b + CONTEXT)
    while a > 0 and not (text[a - 1].isspace() or text[a].isspace()):
        a -= 1
    while b < len(text) and not (text[b - 1].isspace() or text[b].isspace()):
        b += 1
    return a, b


def field_spans(text: str, field: Field, whole: bool = False) -> list[tuple[int, int, str]]:
    """Spans that Viterbi tags as secrets.

    A run of plain words and marks is outside on the best path, whatever stands beyond it,
    so the chain falls apart there: stretches around odd tokens, decoded one by one, give the
    tags of the ``whole`` text, which tests compare.
    """
    out: list[tuple[int, int, str]] = []
    file = file_features(text) if text else ()
    for a, b in [(0, len(text))] if whole else _stretches(text):
        tokens = list(_TOKEN.finditer(text, a, b))
        if not tokens:
            continue
        open_ = False
        for t, tag in zip(tokens, field.viterbi(features([t.group() for t in tokens], file)), strict=True):
            if tag == BEGIN:
                out.append((t.start(), t.end(), "crf"))
            elif tag == INSIDE and open_:
                out[-1] = (out[-1][0], t.end(), "crf")
            open_ = tag != OUTSIDE
    return out


def find_secrets(text: str | None, field: Field) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans: those of the field that no base span touches are added."""
    text = text or ""
    base = base_spans(text)
    more = [s for s in field_spans(text, field) if all(s[1] <= b[0] or b[1] <= s[0] for b in base)]
    every = sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[2])))
    return base, every


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, a row for each input row.

    Positions are code points, ends exclusive.  Null texts are empty and have no span;
    texts of any length are read whole; repeated rows and null ids are rows like any other;
    further columns are ignored, whatever their names; an empty table gives no rows.
    """
    field = field or trained()

    def run(cols):
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for text in cols["text"].to_pylist():
            base, every = find_secrets(text, field)
            kinds = [s[2] for s in base]
            out["n_assign"].append(kinds.count("assign"))
            out["n_access"].append(kinds.count("access"))
            out["n_hex"].append(kinds.count("hex"))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(every))
        return out | {"doc_id": cols["doc_id"]}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(text: str | None, field: Field, mark: str = "[secret]") -> str | None:
    """The text with each secret replaced by ``mark``; overlapping spans are one."""
    if not text:
        return text
    out, last = [], 0
    for a, b, _ in find_secrets(text, field)[1]:
        if a >= last:
            out += [text[last:a], mark]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """All rows and columns, secrets replaced in ``text`` and ``n_chars`` counted anew.

    Null and empty texts, null ids, repeated rows and columns of any name stay as they are;
    an empty table gives no rows.
    """
    field = field or trained()
    names = docs.columns

    def run(cols):
        texts = [redacted(t, field) for t in cols["text"].to_pylist()]
        return {n: texts if n == "text" else cols[n] for n in names}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = map_arrow(docs, run, schema)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in names else out


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spread(read_table(spark, sf_dir, "documents")))
