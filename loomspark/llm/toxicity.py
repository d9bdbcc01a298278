"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: slur, violence, intent, target, negation, reported speech or none.
Five weighted transducers are composed, each reading what the one before writes: insults
and threats are marked, then targets, negation and reported speech around the marks change
their weight.  The best path through the composition scores a clause, so an insult aimed at
someone counts more, and a negated or reported one less, than the bare word.  Which words
are slurs is learned.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, crc_fold, map_arrow, read_table, spread

#: Labelled rows of each class that the grammar is fitted on at most, and the characters that all may have together.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 60_000_000
#: Documents an insult must stand in, and the log odds from which a word is one.
LEAST_SUPPORT, LEAST_ODDS = 3, 2.5
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
WORDS_KEPT = 400_000

#: Symbols that words become, and the marks that the first two transducers write.
SLUR, VIOLENCE, INTENT, TARGET, NEGATION, REPORT, OTHER, INSULT, THREAT = range(9)
_PLAIN = (SLUR, VIOLENCE, INTENT, TARGET, NEGATION, REPORT, OTHER)
_MARKS = (INSULT, THREAT)
#: Closed classes of function words in English, German, French and Spanish (fixed values).
TARGET_WORDS = "you your yours yourself u he she they them him her du dich dir dein deine ihr euch sie tu te toi ton ta vous votre usted ustedes tú ti tus vosotros".split()
NEGATION_WORDS = "not never no isn aren don doesn nobody nicht kein keine nie niemals ne pas jamais aucun aucune nunca jamás ningún ninguna".split()
REPORT_WORDS = "said says say told claimed quote quoted wrote reported called sagte sagt schrieb zitierte behauptete dit disait écrivit cita dijo dice escribió citó".split()
VIOLENCE_WORDS = "kill hurt destroy burn beat shoot stab töten umbringen verbrennen schlagen tuer brûler frapper détruire matar quemar golpear destruir".split()
INTENT_WORDS = "will ll going gonna shall must should werde werden soll wirst vais vas va allons voy vas vamos debe".split()

_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]{1,64}")  # longer runs come in parts


@dataclass
class Transducer:
    """A weighted transducer: ``arcs[state][symbol]`` are (written symbol, weight, next state), any number of them.

    A path may end in the states of ``final``.  A weight scales what a mark read there is
    worth (by its exponential); on any other symbol it is added to the path.
    """

    arcs: dict[int, dict[int, list[tuple[int, float, int]]]]
    final: frozenset[int]
    start: int = 0

    def step(self, state: int, symbol: int) -> list[tuple[int, float, int]]:
        return self.arcs[state].get(symbol, [])

    def ends(self, state: int) -> bool:
        return state in self.final


def insult_transducer() -> Transducer:
    """A slur is an insult; one that follows another within two words weighs more, as a chain of them is one attack."""
    arcs = {0: {x: [(x, 0.0, 0)] for x in _PLAIN}}
    arcs[0][SLUR] = [(INSULT, 0.0, 1)]
    for k in (1, 2):
        arcs[k] = {x: [(x, 0.0, k + 1 if k < 2 else 0)] for x in _PLAIN} | {SLUR: [(INSULT, 0.1, 1)]}
    return Transducer(arcs, frozenset(arcs))


def threat_transducer(span: int = 3) -> Transducer:
    """Intent, then a word of violence, then a target, each within ``span`` words of the one before, is a threat.

    Whether the target follows is not known at the word of violence: one path writes the mark
    and ends only if the target comes, the other reads on.  A word of violence by itself is none.
    """
    passed = (*_PLAIN, INSULT)
    waiting, owing = range(1, span + 1), range(span + 1, 2 * span + 1)
    arcs = {0: {x: [(x, 0.0, 0)] for x in passed} | {INTENT: [(INTENT, 0.0, 1)]}}
    for k in waiting:  # intent was read k - 1 words ago
        arcs[k] = {x: [(x, 0.0, k + 1 if k < span else 0)] for x in passed} | {INTENT: [(INTENT, 0.0, 1)]}
        arcs[k][VIOLENCE] = [(VIOLENCE, 0.0, 0), (THREAT, 0.0, span + 1)]
    for k in owing:  # a mark was written, its target is still to come
        arcs[k] = {x: [(x, 0.0, k + 1)] for x in passed} if k < 2 * span else {}
        arcs[k][TARGET] = [(TARGET, 0.0, 0)]
    return Transducer(arcs, frozenset((0, *waiting)))


def context_transducer(symbol: int, span: int, before: float, after: float) -> Transducer:
    """Marks up to ``span`` words after ``symbol`` are scaled by ``before``; ``symbol`` up to ``span`` words after a mark adds ``after``."""
    passed = (*_PLAIN, *_MARKS)
    near, marked = range(1, span + 1), range(span + 1, 2 * span + 1)
    arcs: dict[int, dict[int, list[tuple[int, float, int]]]] = {}
    for k in range(2 * span + 1):
        on = k + 1 if k and k not in (span, 2 * span) else 0
        arcs[k] = {x: [(x, 0.0, on)] for x in passed}
        arcs[k][symbol] = [(symbol, after if k in marked else 0.0, 1)]
        for x in _MARKS:
            arcs[k][x] = [(x, before, k)] if k in near else [(x, 0.0, span + 1)]
    return Transducer(arcs, frozenset(arcs))


class Composition:
    """What ``first`` writes is what ``second`` reads; joint states and their arcs come into being when first reached."""

    def __init__(self, first, second):
        self.first, self.second = first, second
        self.start = (first.start, second.start)
        self.memo: dict[tuple, list[tuple[int, float, tuple]]] = {}

    def step(self, state: tuple, symbol: int) -> list[tuple[int, float, tuple]]:
        found = self.memo.get((state, symbol))
        if found is None:
            p, q = state
            found = [(out, w + v, (p2, q2)) for mid, w, p2 in self.first.step(p, symbol) for out, v, q2 in self.second.step(q, mid)]
            self.memo[state, symbol] = found
        return found

    def ends(self, state: tuple) -> bool:
        return self.first.ends(state[0]) and self.second.ends(state[1])


def best_path(machine, words: list[tuple[int, float]]) -> float:
    """The largest sum over the paths that read a clause of (symbol, weight of the word) to a final state."""
    at = {machine.start: 0.0}
    for symbol, weight in words:
        reached: dict = {}
        for state, total in at.items():
            for out, w, following in machine.step(state, symbol):
                value = total + (weight * math.exp(w) if out in _MARKS else w)
                if value > reached.get(following, -math.inf):
                    reached[following] = value
        at = reached
    return max((v for s, v in at.items() if machine.ends(s)), default=0.0)


def grammar() -> Composition:
    """Insults and threats first; a target near one strengthens it, negation and reported speech before it weaken it."""
    machine = Composition(insult_transducer(), threat_transducer())
    for part in (context_transducer(TARGET, 3, 0.15, 0.3), context_transducer(NEGATION, 2, -0.9, 0.0), context_transducer(REPORT, 6, -0.7, -0.2)):
        machine = Composition(machine, part)
    return machine


@dataclass
class Grammar:
    insults: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)

    def __post_init__(self):
        self._clauses = grammar()
        self._memo: dict[str, tuple[int, float] | None] = {}
        self._closed = {w: (k, 1.0) for k, ws in ((TARGET, TARGET_WORDS), (NEGATION, NEGATION_WORDS), (REPORT, REPORT_WORDS), (VIOLENCE, VIOLENCE_WORDS), (INTENT, INTENT_WORDS)) for w in ws}

    def __getstate__(self):
        return (self.insults, self.stems, self.weights)

    def __setstate__(self, state):
        self.insults, self.stems, self.weights = state
        self.__post_init__()

    def symbol(self, word: str) -> tuple[int, float] | None:
        """Class and weight of a lower-cased word; None for those that only pass time."""
        if word in self._memo:
            return self._memo[word]
        if len(self._memo) >= WORDS_KEPT:
            self._memo.clear()
        weight = self.insults.get(word)
        if weight is None:
            stem = max((self.stems.get(word[:n], 0.0) for n in PREFIXES if len(word) >= n), default=0.0)
            weight = 0.6 * stem if stem else None
        found = (SLUR, weight) if weight else self._closed.get(word)
        self._memo[word] = found
        return found

    def features(self, text: str | None) -> np.ndarray:
        """Sum and maximum over clauses, and the sum for each hundred words."""
        total, most, words_seen = 0.0, 0.0, 0
        symbol = self.symbol
        for clause in _CLAUSE.split((text or "").lower()):
            words = _WORD.findall(clause)
            words_seen += len(words)
            found = [symbol(w) for w in words]
            if not any(f is not None and f[0] <= VIOLENCE for f in found):
                continue
            score = max(0.0, best_path(self._clauses, [f or (OTHER, 0.0) for f in found]))
            total += score
            most = max(most, score)
        return np.array([1.0, math.log1p(total), math.log1p(most), math.log1p(100 * total / (words_seen + 20))])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(self.weights, self.features(text))))))))


def _odds(rows: list[tuple[str, int]], keys, least: int) -> dict[str, float]:
    """Log odds of the keys of a text that speak for toxic; only what enough toxic texts hold is counted further."""
    n_bad = sum(y for _, y in rows)
    n_good = len(rows) - n_bad
    bad = Counter()
    for text, y in rows:
        if y:
            bad.update(keys(text))
    bad = {k: n for k, n in bad.items() if n >= least}
    good = Counter()
    for text, y in rows:
        if not y:
            good.update(k for k in keys(text) if k in bad)
    out = {}
    for k, n in bad.items():
        odds = math.log((n + 0.2) / (n_bad + 1)) - math.log((good[k] + 0.2) / (n_good + 1))
        if odds >= LEAST_ODDS and n > 4 * good[k] * n_bad / max(n_good, 1):
            out[k] = odds
    return out


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _stems(text: str) -> set[str]:
    return {w[:n] for w in _words(text) for n in PREFIXES if len(w) > n}


def fit(rows: list[tuple[str, int]]) -> Grammar:
    """Insults, their stems and the final weights from (text, toxic) rows.

    Odds for the final weights are learned on one half and the weights on the other, in
    turn, so that words of single documents do not look better than they are.
    """
    if len({y for _, y in rows}) < 2:
        return Grammar()
    xs, ys = [], []
    classes = [[r for r in rows if r[1] == y] for y in (1, 0)]
    halves = [[r for rs in classes for r in rs[k::2]] for k in (0, 1)]
    for k in (0, 1):
        part = _lexicon(halves[k])
        for text, y in halves[1 - k]:
            xs.append(part.features(text))
            ys.append(y)
    whole = _lexicon(rows)
    whole.weights = tuple(float(w) for w in _logistic(np.array(xs), np.array(ys, float)))
    return whole


def _lexicon(rows: list[tuple[str, int]]) -> Grammar:
    return Grammar(_odds(rows, _words, LEAST_SUPPORT), _odds(rows, _stems, 2 * LEAST_SUPPORT))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Newton's method, both classes weighing alike at the bound the threshold asks for."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """At most ``rows`` (text, toxic) rows of each class outside fold 1, of about ``chars`` characters together."""
    known = labels.where(F.col("toxic").isin(0, 1) & (crc_fold("doc_id", 3) != 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(rows).unionByName(known.where("toxic = 0").orderBy(*order).limit(rows))
    # the chosen ids are at most twice ``rows`` numbers
    found = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    return [(r.text, r.toxic) for r in sorted(bounded_sample(found, 2 * rows, chars), key=lambda r: (r.doc_id, r.text))]


def scores(docs: DataFrame, model: Grammar) -> DataFrame:
    """``(doc_id, score, predicted)``, a row for each input row.

    Null and empty texts score like wordless ones; texts of any length are read whole; null
    ids and repeated rows are rows like any other; further columns are ignored, whatever
    their names; an empty table gives no rows.
    """

    def run(cols):
        found = [model.score(t) for t in cols["text"].to_pylist()]
        return {"doc_id": cols["doc_id"], "score": found, "predicted": [int(s >= THRESHOLD) for s in found]}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, score double, predicted int")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(labelled_sample(docs, read_table(spark, sf_dir, "labels")))
    out = scores(spread(docs), model)
    return out.select("doc_id", F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")
