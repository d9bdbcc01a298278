"""The study's statistics: choice models, matching, reverts and looks back, exploration."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.functions.keywords import PhraseAutomaton, inflections, keyword_hits, phrase_hits
from loomspark.operators.ranks import ranked
from loomspark.plans import choice, exploration, lookback, matching, network, research, rights

# -- choice models -------------------------------------------------------------------------


def dense_fit(rows, d):
    """The conditional likelihood's maximum over plain arrays."""
    strata = {}
    for g, case, x in rows:
        strata.setdefault(g, []).append((case, np.array(x)))
    theta = np.zeros(d)
    for _ in range(50):
        value, gradient, information = 0.0, np.zeros(d), np.zeros((d, d))
        for members in strata.values():
            m = sum(c for c, _ in members)
            if not m or len(members) < 2:
                continue
            x = np.array([v for _, v in members])
            w = np.exp(x @ theta)
            mean = w @ x / w.sum()
            value += sum(v @ theta for c, v in members if c) - m * math.log(w.sum())
            gradient += sum(v for c, v in members if c) - m * mean
            information += m * ((x * w[:, None]).T @ x / w.sum() - np.outer(mean, mean))
        theta = theta + np.linalg.solve(information, gradient)
    return theta, np.sqrt(np.diag(np.linalg.inv(information))), value


def drawn(seed, n=300, d=2, theta=(1.0, -0.7)):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(n):
        size = int(rng.integers(1, 12))
        x = rng.normal(0, 1, (size, d)) + 50  # a common shift must not matter
        w = np.exp((x - 50) @ np.array(theta))
        pick = set(rng.choice(size, size=min(size, 1 + g % 2), replace=False, p=w / w.sum()).tolist())
        rows += [(g, i in pick, x[i].tolist()) for i in range(size)]
    return rows


def test_conditional_logit(spark):
    rows = drawn(4)
    df = spark.createDataFrame([(g, c, *x, 7) for g, c, x in rows] + [(1, True, None, 1.0, 7), (None, True, 1.0, 1.0, 7), (5, None, 1.0, 1.0, 7)], "g int, c boolean, a double, b double, stratum int")
    fit = choice.fit_conditional_logit(df, "g", "c", ["a", "b"])
    theta, errors, value = dense_fit(rows, 2)
    assert fit.theta == pytest.approx(theta, abs=1e-6)
    assert fit.errors == pytest.approx(errors, abs=1e-6)
    assert fit.log_likelihood > fit.null_log_likelihood and abs(fit.gradient).max() < 1e-6
    assert fit.log_likelihood == pytest.approx(value, abs=1e-6)
    assert [r.covariate for r in fit.frame(spark).collect()] == ["a", "b"]
    first, second = choice.nested_fits(df, "g", "c", [["a"], ["b"]])
    assert second.log_likelihood >= first.log_likelihood and second.aic == pytest.approx(fit.aic)


def test_hot_stratum_and_flat_covariate(spark):
    """A stratum of a third of the rows, a covariate that is the same for all of a stratum."""
    rng = np.random.default_rng(2)
    rows = [(0, i == 3, [float(rng.normal())]) for i in range(400)] + [(1 + i // 4, i % 4 == 0, [float(rng.normal())]) for i in range(800)]
    df = spark.createDataFrame([(g, c, x[0], float(g)) for g, c, x in rows], "g int, c boolean, a double, flat double")
    fit = choice.fit_conditional_logit(df, "g", "c", ["a", "flat"])
    theta, _, _ = dense_fit(rows, 1)
    assert fit.theta[0] == pytest.approx(theta[0], abs=1e-6) and fit.theta[1] == pytest.approx(0, abs=1e-9)


def test_separated_and_empty(spark):
    df = spark.createDataFrame([(g, i == 0, float(i == 0)) for g in range(5) for i in range(3)], "g int, c boolean, a double")
    with pytest.raises(ValueError):
        choice.fit_conditional_logit(df, "g", "c", ["a"])
    with pytest.raises(ValueError):
        choice.fit_conditional_logit(df.limit(0), "g", "c", ["a"])


def test_probabilities(spark):
    df = spark.createDataFrame([(1, 1000.0), (1, 1001.0), (None, 5.0), (2, None), (2, 1.0)], "g int, a double")
    got = {(r.g, r.a): r.probability for r in choice.choice_probabilities(df, "g", ["a"], [1.0]).collect()}
    assert got[1, 1001.0] == pytest.approx(1 / (1 + math.exp(-1))) and got[1, 1000.0] + got[1, 1001.0] == pytest.approx(1)
    assert got[None, 5.0] == 1 and got[2, 1.0] == 1 and got[2, None] is None


def test_propensity(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (500, 2))
    y = rng.random(500) < 1 / (1 + np.exp(-(0.3 + x @ [1.0, -2.0])))
    df = spark.createDataFrame([(bool(b), float(p), float(q)) for b, (p, q) in zip(y, x, strict=True)] + [(None, 1.0, 1.0), (True, None, 1.0)], "t boolean, p double, q double")
    theta = choice.fit_propensity(df, "t", ["p", "q"])
    z, dense = np.column_stack([np.ones(500), x]), np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-z @ dense))
        dense = dense + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (y - p))
    assert theta == pytest.approx(dense, abs=1e-6)


# -- matching ------------------------------------------------------------------------------


def greedy(rows, caliper):
    """All admissible pairs in order; rows are (id, treated, score, stratum)."""
    pairs = sorted((abs(a[2] - b[2]), min(a[2], b[2]), a[0], b[0]) for a in rows if a[1] for b in rows if not b[1] and a[3] == b[3] and abs(a[2] - b[2]) <= caliper)
    used, out = set(), []
    for away, _, t, c in pairs:
        if t not in used and c not in used:
            used |= {t, c}
            out.append((t, c, away))
    return sorted(out)


def settled(groups, caliper, size):
    """Levels of ranges without Spark: transfers of group indices by scores."""
    state = [(s, side, n, 0) for s, side, n in groups]
    out = []
    while state:
        parts = [state[i : i + size] for i in range(0, len(state), size)]
        state = []
        for k, part in enumerate(parts):
            score, side, count, used = (list(c) for c in zip(*part, strict=True))
            moves, left = matching.settle(np.array(score), side, count, used, caliper, k == 0, k == len(parts) - 1)
            out += [(score[t], a, score[c], b, n) for t, a, c, b, n in moves]
            state += [(score[i], side[i], count[i], used[i]) for i in left if count[i]]
        if len(parts) == 1:
            assert not state
        size *= 2
    return out


def test_settled_ranges_give_the_greedy_matching():
    rng = random.Random(11)
    for trial in range(400):
        n = rng.randint(1, 40)
        scores = sorted(rng.sample(range(10 * n) if trial % 3 else range(n + 3), n))
        groups = [(float(s), int(rng.random() < 0.4), rng.randint(1, 3)) for s in scores]
        caliper = rng.choice([0.5, 2.0, 7.0, 1000.0])
        rows, names, i = [], {}, 0
        for s, side, count in groups:
            for rank in range(count):
                rows.append((i, bool(side), s, 0))
                names[s, rank] = i
                i += 1
        got = sorted((names[t, a + j], names[c, b + j], abs(t - c)) for t, a, c, b, k in settled(groups, caliper, rng.choice([1, 2, 5, 50])) for j in range(k))
        assert got == greedy(rows, caliper), (groups, caliper)


def test_matched_pairs(spark):
    """Ties, a score of a third of all rows, strata of one side, nulls; ranges of few scores."""
    rng = random.Random(5)
    rows = [(i, rng.random() < 0.4, 0.5 if i % 3 == 0 else rng.randint(0, 400) / 400, rng.choice("abc")) for i in range(900)] + [(2000 + i, True, 0.3, "only") for i in range(5)]
    odd = [(3000, None, 0.5, "a"), (3001, True, None, "a"), (3002, True, 0.5, None), (3003, True, float("nan"), "a")]
    df = spark.createDataFrame(rows + odd, "id bigint, treated boolean, score double, topic string")
    for caliper, size in ((0.01, 10), (0.2, 25), (0.0, 4096), (1.0, 7)):
        got = sorted(map(tuple, matching.matched_pairs(df, "id", "treated", "score", caliper, ["topic"], range_scores=size, fan_in=3).collect()))
        assert got == greedy(rows, caliper)
    assert matching.matched_pairs(df.limit(0), "id", "treated", "score", 1.0, ["topic"]).count() == 0
    assert matching.matched_pairs(df.where("treated"), "id", "treated", "score", 1.0).count() == 0


def test_propensity_pairs_balance(spark):
    """Matching on the fitted chance brings the covariates' difference below 0.1."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(3000):
        a, b = float(rng.normal()), float(rng.normal())
        rows.append((i, bool(rng.random() < 1 / (1 + math.exp(2.0 - 0.8 * a + 0.5 * b))), a, b, int(i % 2)))
    df = spark.createDataFrame(rows, "id bigint, treated boolean, a double, b double, topic int")
    pairs = matching.propensity_pairs(df, "id", "treated", ["a", "b"], ["topic"], deviations=0.2)
    both = {r.covariate: r for r in matching.balance_before_and_after(df, pairs, "id", "treated", ["a", "b"]).collect()}
    assert abs(both["a"].before) > 0.3 and all(abs(r.after) < 0.1 for r in both.values())


# -- looks back ----------------------------------------------------------------------------


def test_ranked(spark):
    rows = [(i % 3 if i % 2 else 0, i * 7 % 101) for i in range(101)] + [(None, 5)]
    got = ranked(spark.createDataFrame(rows, "k int, o int"), ["k"], ["o"]).collect()
    assert all(r["rank"] == sum(1 for k, o in rows if k == r.k and o < r.o) for r in got) and len(got) == 101


def test_identity_reverts(spark):
    """Against all earlier revisions of every page, with ties of time, null hashes and pages, a long page."""
    rng = random.Random(4)
    rows = [(rng.choice("pqr") if i % 2 else "hot", i, rng.randint(0, 200), rng.choice(["a", "b", "c", "d", None]) if i % 5 else f"own{i}") for i in range(500)]
    df = spark.createDataFrame(rows + [(None, 9000, 1, "a")], "page string, rev int, at int, sha string")
    for radius in (2, 4, 15):
        got = {r.rev: (r.position, r.reverts_to, r.undone) for r in lookback.identity_reverts(df, "page", "rev", "at", "sha", radius).collect()}
        for page in "pqr", "hot":
            own = sorted((at, rev, sha) for p, rev, at, sha in rows if p == page)
            to = []
            for i, (_, _, sha) in enumerate(own):
                back = next((j for j in range(i - 1, max(-1, i - radius - 1), -1) if sha is not None and own[j][2] == sha), None)
                to.append(back if back is not None and i - back >= 2 else None)
            for i, (_, rev, _) in enumerate(own):
                undone = any(to[k] is not None and to[k] < i for k in range(i + 1, len(own)))
                assert got[rev] == (i, to[i], undone)
        assert len(got) == 500


def test_measures(spark):
    """Sums and maxima strictly before, over spans and the whole past; clashing names; pages without events."""
    rng = random.Random(9)
    events = [(rng.choice([1, 2, None]), rng.randint(0, 500), rng.randint(0, 9)) for _ in range(300)]
    requests = [(i, rng.choice([1, 2, 3]), rng.randint(-50, 550)) for i in range(60)] + [(60, 1, 100), (60, 1, 100)]
    e = spark.createDataFrame(events, "page int, at int, x int")
    q = spark.createDataFrame([(*r, 1) for r in requests], "id int, page int, t int, x int")
    got = lookback.span_measures(q, e, "page", "t", "at", {"s": 10, "l": 100}, sums={"n": F.lit(1)}, tops={"m": F.col("x")})
    got = lookback.history_measures(got, e, "page", "t", "at", 37, sums={"every": F.lit(1)}, tops={"most": F.col("x")})
    want = []
    for i, p, t in requests:
        own = [(at, x) for k, at, x in events if k == p and at < t]
        near = {s: [x for at, x in own if at >= t - s] for s in (10, 100)}
        want.append((i, p, t, 1, len(near[10]), max(near[10], default=None), len(near[100]), max(near[100], default=None), len(own), max((x for _, x in own), default=None)))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


# -- exploration ---------------------------------------------------------------------------


def test_exploration(spark):
    """Against every pair; a portfolio far older than any half-life keeps its direction."""
    rng = random.Random(3)
    rows = [(i, rng.choice("abc"), rng.randint(0, 3000), rng.choice([None, 0.0, 1.0, -0.5]), rng.random()) for i in range(200)]
    rows += [(500, "a", 10**7, 1.0, 0.0), (501, "z", 5, 1.0, 1.0), (502, "z", 10**9, 1.0, 0.0), (503, None, 5, 1.0, 1.0), (504, "y", 1, 0.0, 0.0), (505, "y", 2, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, who string, t bigint, a double, b double")
    by_id = {r[0]: r for r in rows}
    for width in (50, 400, None):
        got = {r.id: r.familiarity for r in exploration.exploration(df, "id", "who", "t", ["a", "b"], half_life=40, width=width).collect()}
        assert len(got) == len(rows)
        for i, who, t, a, b in rows:
            past = [r for r in rows if r[1] == who and who is not None and r[2] < t]
            latest = max((r[2] for r in past), default=0)
            p = sum((2.0 ** ((r[2] - latest) / 40) * np.array([r[3] or 0.0, r[4]]) for r in past), np.zeros(2))
            v = np.array([a or 0.0, b])
            size = np.linalg.norm(p) * np.linalg.norm(v)
            if not size:
                assert got[i] is None, by_id[i]
            else:
                assert got[i] == pytest.approx(float(p @ v / size), abs=1e-9)


# -- rights --------------------------------------------------------------------------------


def test_rights(spark):
    """Overlapping grants and revocations against a replay of all events; a user of a third of the rows."""
    rng = random.Random(6)
    rows = [("hot" if i % 3 == 0 else rng.choice("abcde"), rng.randint(0, 120), i, rng.choice(["sysop", "bot"]), rng.random() < 0.5) for i in range(300)]
    changes = spark.createDataFrame(rows + [(None, 1, 900, "bot", True), ("a", None, 901, "bot", True)], "who string, t int, o int, grp string, granted boolean")
    got = {}
    for r in rights.membership_intervals(changes, "who", "t", "o").collect():
        got.setdefault((r.who, r.grp), []).append((r.start, r.end))

    def state(who, grp, t):
        own = sorted((x[1], x[2], x[4]) for x in rows if x[0] == who and x[3] == grp)
        past = [g for at, _, g in own if at < t]
        return past[-1] if past else bool(own) and not own[0][2]

    for who in ("hot", *"abcde"):
        for grp in ("sysop", "bot"):
            for t in range(-1, 123):
                held = any((s is None or s < t) and (e is None or t <= e) for s, e in got.get((who, grp), []))
                assert held == state(who, grp, t), (who, grp, t)
    asked = spark.createDataFrame([(i, who, t) for i, (who, t) in enumerate((w, t) for w in ("hot", "a", "nobody") for t in range(-1, 123, 7))], "id int, who string, at int")
    for r in rights.groups_at(asked, changes, "who", "t", "o", ["bot", "sysop"], width=30, at="at").collect():
        assert r.groups == [g for g in ("bot", "sysop") if state(r.who, g, r.at)]


def test_changes_and_tiers(spark):
    events = spark.createDataFrame([("a", 86_400 * 50, 1, None, ["sysop"]), ("a", 86_400 * 60, 2, ["sysop", "bot"], ["bot"])], "who string, t long, o int, old array<string>, new array<string>")
    changes = rights.rights_changes(events, "who", "t", "o", "old", "new")
    assert sorted((r.t // 86_400, r.grp, r.granted) for r in changes.collect()) == [(50, "sysop", True), (60, "sysop", False)]
    edits = spark.createDataFrame([(i, "a", 86_400 * i) for i in range(70)], "id int, who string, t long")
    tiers = {r.id: r.tier for r in rights.tiers_at(edits, changes, "who", "t", "o", width=86_400 * 20).collect()}
    assert [tiers[i] for i in (0, 9, 10, 50, 51, 60, 61)] == ["new", "new", "auto-confirmed", "auto-confirmed", "sysop", "sysop", "auto-confirmed"]


# -- networks ------------------------------------------------------------------------------


def test_citations(spark):
    rows = [(1, "x <ref>{{cite web|url=https://www.Example.org/a|doi = 10.1/AB}}</ref> http://b.net/q http://b.net/r"), (2, None), (None, "http://c.org"), (3, "none")]
    got = network.citations(spark.createDataFrame(rows, "page int, text string"), "page", "text")
    assert sorted(map(tuple, got.collect())) == [(1, "b.net"), (1, "doi:10.1/ab"), (1, "example.org")]


def test_coreness(spark):
    """Against peeling node by node."""
    rng = random.Random(2)
    pairs = {(rng.randrange(30), min(rng.randrange(40), rng.randrange(40))) for _ in range(260)} | {(i, 0) for i in range(30)}
    near = {}
    for a, b in pairs:
        near.setdefault(("page", str(a)), set()).add(("source", str(b)))
        near.setdefault(("source", str(b)), set()).add(("page", str(a)))
    want, k, left = {}, 0, {x: set(ys) for x, ys in near.items()}
    while left:
        weak = [x for x, ys in left.items() if len(ys) <= k]
        if not weak:
            k += 1
        for x in weak:
            want[x] = k
            for y in left.pop(x):
                left.get(y, set()).discard(x)
    df = spark.createDataFrame([*pairs, *list(pairs)[:5], (None, 1)], "page int, source int")
    assert {(r.side, r.node): r.coreness for r in network.coreness(df, "page", "source").collect()} == want
    assert max(want.values()) > 3
    assert network.coreness(df.limit(0), "page", "source").count() == 0


def test_four_cycles(spark):
    """Against all pairs of editors, with a page that all edit and an editor of all pages; wedges stay few."""
    rng = random.Random(3)
    edits = [(rng.randrange(60), rng.randrange(40)) for _ in range(300)] + [(0, e) for e in range(40)] + [(p, 7) for p in range(60)] + [(99, 99)]
    pages = {}
    for p, e in set(edits):
        pages.setdefault(e, set()).add(p)
    want = {e: sum(len(own & o) * (len(own & o) - 1) // 2 for f, o in pages.items() if f != e) for e, own in pages.items()}
    df = spark.createDataFrame([*edits, (None, 1), (1, None)], "page int, editor int")
    assert {r.editor: r.cycles for r in network.four_cycles(df, "page", "editor").collect()} == want


def test_subset_repetition(spark):
    """Against all pairs of events: repeated teams, ties of time, stretches, empty and null members."""
    rng = random.Random(12)
    rows = [(i, rng.randint(0, 60), [rng.randrange(7) for _ in range(rng.randint(1, 4))]) for i in range(250)] + [(900, 10, []), (901, 11, None)]
    df = spark.createDataFrame(rows, "id int, t int, s array<int>")
    want = {i: sum(1 for _, t2, s2 in rows if t2 < t and s2 and set(s) <= set(s2)) if s else 0 for i, t, s in rows}
    for width in (None, 13):
        assert {r.id: r.repetition for r in research.subset_repetition(df, "id", "t", "s", width).collect()} == want


# -- phrases -------------------------------------------------------------------------------


def test_phrases(spark):
    """Automaton and join give the counts of a plain scan; inflected forms by rule."""
    rng = random.Random(1)
    word = lambda: rng.choice(["ab", "b", "walk", "walks", "walking", "the", "é"])
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 40))) + rng.choice([".", "", " B!"])) for i in range(60)] + [(100, None), (None, "the b"), (5, "the b the b")]
    phrases = ["the b", "b the b", "walk", "The  walk", "é", "", None, "b"]
    d, p = spark.createDataFrame(docs, "id int, text string"), spark.createDataFrame([(x,) for x in phrases], "phrase string")
    for inflected in (False, True):
        want = {}
        for i, t in docs:
            words = "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
            for phrase in {" ".join(x.lower().split()) for x in phrases if x}:
                own = phrase.split()
                ends = inflections(own[-1]) if inflected else {own[-1]}
                n = sum(words[k : k + len(own) - 1] == own[:-1] and words[k + len(own) - 1] in ends for k in range(len(words) - len(own) + 1))
                if n:
                    want[i, phrase] = want.get((i, phrase), 0) + n
        for limit in (100, 0):
            assert {(r.id, r.phrase): r.n for r in phrase_hits(d, p, "id", "text", inflected, limit).collect()} == want
    assert phrase_hits(d, p.limit(0), "id", "text").count() == 0
    assert {"stopped", "stopping", "cities", "boxes", "makes", "making"} <= {f for w in ("stop", "city", "box", "make") for f in inflections(w)}
    assert PhraseAutomaton(["a b", "b"]).counts(["a", "b", "b"]) == {"a b": 1, "b": 2}


def test_long_keyword_list(spark):
    docs = spark.createDataFrame([(1, "The the cat"), (2, None), (3, "dog")], "id int, text string")
    words = spark.createDataFrame([("the",), ("DOG",), (None,)], "word string")
    for limit in (10, 1):
        assert sorted(map(tuple, keyword_hits(docs, words, "id", "text", limit).collect())) == [(1, "the", 2), (3, "dog", 1)]
    assert keyword_hits(docs, words.limit(0), "id", "text").count() == 0
