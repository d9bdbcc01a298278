"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, crc_fold, map_arrow, read_table, spread

#: Labelled rows that the model is fitted on at most, and the characters they may have together.
SAMPLE_ROWS, SAMPLE_CHARS = 6000, 60_000_000
BUCKETS, DIMENSIONS, GRAMS = 1 << 14, 16, (1, 2, 3, 4)
STEPS, RATE, SNIPPET_WORDS = 16_000, 0.5, 60
#: Share of rightly predicted calibration rows that rejection may cost at most.
REJECT_SHARE = 0.001
#: Distinct words whose contribution a worker remembers.
WORDS_KEPT = 800_000

#: Runs of letters; longer ones (scripts without spaces) come in parts, so that no word outgrows memory.
_LETTERS = re.compile(r"[^\W\d_]{1,40}")


def letter_words(text: str) -> list[str]:
    """Lower-cased runs of letters; runs without a letter (say, of superscripts) don't count."""
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def subwords(word: str) -> np.ndarray:
    """Buckets of the word itself and of its character pieces, edges marked."""
    marked = f"<{word}>"
    pieces = {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    pieces.add(marked)
    crc = zlib.crc32
    return np.array([crc(p.encode()) for p in pieces], np.int64) & (BUCKETS - 1)


class _WordSums(dict):
    """Word to row of a growing array that holds its buckets' logits summed, and how many they are."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table, self.rows = table, np.zeros((1024, table.shape[1] + 1))

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        if at >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        own = subwords(word)
        self.rows[at, :-1] = self.table[own].sum(axis=0)
        self.rows[at, -1] = len(own)
        return at

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > WORDS_KEPT:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.rows[at].sum(axis=0)


@dataclass
class Model:
    """``table`` holds each bucket's logits: embeddings times output weights, as both are linear."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def __post_init__(self):
        self._sums = _WordSums(self.table)

    def __getstate__(self):
        return (self.languages, self.table, self.bias, self.temperature, self.reject_below)

    def __setstate__(self, state):
        self.languages, self.table, self.bias, self.temperature, self.reject_below = state
        self.__post_init__()

    def logits(self, words: list[str]) -> np.ndarray:
        total = np.zeros(len(self.languages) + 1)
        for i in range(0, len(words), 50_000):
            total += self._sums.of(words[i : i + 50_000])
        return total[:-1] / max(total[-1], 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether the text is rejected."""
        words = letter_words(text) if text else []
        if not words or not self.languages:
            return "und", 0.0, True
        z = self.logits(words) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.reject_below)


def fit(rows: list[tuple[str, str]], seed: int = 11) -> Model:
    """Stochastic gradient descent on snippets of (text, language) rows.

    Every fifth row stays out of the descent; on those the temperature is chosen by
    likelihood, and then the largest rejection bound that costs at most
    ``REJECT_SHARE`` of the rightly predicted ones.
    """
    languages = sorted({lang for _, lang in rows})
    if len(languages) == 0:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    if len(languages) == 1:
        return Model(languages, np.zeros((BUCKETS, 1)), np.zeros(1))
    rng = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(languages)}
    known: dict[str, np.ndarray] = {}
    texts = [(w, number[lang]) for t, lang in rows if (w := letter_words(t))]
    learn = [x for i, x in enumerate(texts) if i % 5] or texts
    if not learn:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    held = texts[::5]
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    out, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    epochs = -(-STEPS // len(learn))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for k in rng.permutation(len(learn)):
            words, y = learn[k]
            n = int(rng.integers(3, SNIPPET_WORDS))
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            pieces = []
            for w in words[at : at + n]:
                own = known.get(w)
                if own is None:
                    own = known[w] = subwords(w)
                pieces.append(own)
            buckets = np.concatenate(pieces)
            mean = embed[buckets].mean(axis=0)
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            np.subtract.at(embed, buckets, rate * back / len(buckets) * 20)
    model = Model(languages, embed @ out, bias)
    return _calibrated(model, held or learn)


def _calibrated(model: Model, held: list[tuple[list[str], int]]) -> Model:
    z = np.array([model.logits(w) for w, _ in held])
    y = np.array([k for _, k in held])

    def chances(temperature: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return e / e.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.05, 5, 60)
    model.temperature = float(min(grid, key=lambda t: -np.log(chances(t)[np.arange(len(y)), y] + 1e-12).mean()))
    p = chances(model.temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y])
    if len(right):
        # below every kept row's chance with room to spare, and never above four in ten
        bound = right[int(REJECT_SHARE * len(right))]
        model.reject_below = float(min(0.8 * bound, 0.4))
    return model


def labelled_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """At most ``rows`` (text, lang) rows outside fold 0, of about ``chars`` characters together."""
    able = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_fold("doc_id", 5) != 0))
    found = bounded_sample(able.select("doc_id", "text", "lang"), rows, chars)
    return [(r.text, r.lang) for r in sorted(found, key=lambda r: (r.doc_id, r.text, r.lang))]


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)``, a row for each input row.

    Null texts and those without a letter, however long, are ``und`` with score 0 and
    rejected, as all are where nothing was learned.  Only the text decides, the whole of
    it; repeated rows and null ids are rows like any other; further columns are ignored,
    whatever their names; an empty table gives no rows.
    """

    def run(cols):
        found = [model.predict(t) for t in cols["text"].to_pylist()]
        lang, score, rejected = zip(*found, strict=True) if found else ((), (), ())
        return {"doc_id": cols["doc_id"], "lang_pred": list(lang), "score": list(score), "rejected": list(rejected)}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, **limits) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` with a model learned from the documents' own labels."""
    return predictions(docs, fit(labelled_sample(docs, **limits)))


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows that language identification does not reject, with all their columns.

    Null texts and texts without a letter go; null ids, repeated rows and columns of any
    name stay as they are; an empty table gives no rows.
    """
    model = fit(labelled_sample(docs))
    names = docs.columns

    def run(cols):
        keep = [not model.predict(t)[2] for t in cols["text"].to_pylist()]
        import pyarrow as pa

        return {n: cols[n].filter(pa.array(keep, pa.bool_())) for n in names}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_arrow(docs, run, schema)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = predictions(spread(docs), fit(labelled_sample(docs)))
    return out.select("doc_id", (F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False))).alias("held_out"), "lang_pred", "score", "rejected")
