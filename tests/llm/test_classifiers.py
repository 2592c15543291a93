"""Toxicity and quality: held-out results, the automaton against plain edit distances, edges."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from eventloom.llm import quality, toxicity
from eventloom.llm.queries import QUERIES
from tests.conftest import TESTDATA


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_match(word, terms):
    best = None
    for number, term in enumerate(terms):
        bare = term.removesuffix("$")
        heads = [word] if term != bare else [word[:n] for n in range(1, len(word) + 1)]
        edits = min(distance(bare, head) for head in heads)
        if edits <= toxicity._edits(len(bare)):
            best = min(best or (9, 0), (edits, number))
    return best


def test_automaton_equals_plain_edit_distances():
    terms = ["abab$", "ababc$", "cabba", "bcbcbcab", "aabbaabbcc$", "ccc", "ab$", "bacab$"]
    automaton = toxicity.LexiconAutomaton(terms)
    rng = random.Random(1)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    words += [t.removesuffix("$") for t in terms]
    for word in words:
        assert automaton.match(word) == plain_match(word, terms), word


def test_automaton_forgets_states_and_finds_the_same(monkeypatch):
    rng = random.Random(5)
    terms = sorted({"".join(rng.choices("abcd", k=rng.randint(5, 10))) + rng.choice(["", "$"]) for _ in range(60)})
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 14))) for _ in range(400)]
    whole = toxicity.LexiconAutomaton(terms)
    wanted = [whole.match(w) for w in words]
    monkeypatch.setattr(toxicity, "_STATES", 20)
    bounded = toxicity.LexiconAutomaton(terms)
    assert [bounded.match(w) for w in words] == wanted
    assert len(bounded._states) < len(whole._states) and len(bounded._states) < 20 + 14


def test_a_labelled_id_on_many_rows_is_learned_from_once(spark):
    docs = [(i, f"you are a horrid blatherskite {i} times" if i < 20 else f"the weather is fine on day {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(60)], "doc_id long, toxic int")
    once = spark.createDataFrame(docs, "doc_id long, text string")
    often = spark.createDataFrame(docs + [docs[25]] * 500, "doc_id long, text string")
    one, many = (toxicity.learn_toxicity(frame, labels) for frame in (once, often))
    assert one.terms == many.terms and one.weights == many.weights and np.allclose(one.bend, many.bend)


def test_terms_give_way_to_longer_ones():
    rows = [("idi", 40, 3, 50.0), ("idio", 40, 0, 80.0), ("idiot", 40, 0, 80.0), ("idiot$", 39, 0, 78.0), ("réeux", 20, 0, 40.0), ("réeuxa", 5, 0, 10.0)]
    assert toxicity.choose_terms(rows) == ["idiot$", "réeux"]


def test_context_separates_quotation_from_abuse():
    model = toxicity.ToxicityModel(["stupid$"], {(0, 0): 6.0, (1, 0): 3.0}, np.array([-3.0, 1, 1, 0, -0.5, 0.5]))
    plain, spelt, quoted = model.score("that is stupid indeed"), model.score("that is stupit indeed"), model.score('that is "stupid" indeed')
    assert plain > spelt > model.score("that is fine indeed") and plain > quoted
    assert model.score("she wrote stupid indeed") < plain < model.score("you are stupid indeed")
    assert model.score(None) == model.score("") == model.score("no hits")


@pytest.mark.parametrize("word", ["id1ot", "m0ron", "st*pid", "stu_id", "st__pidity", "stupi\u0301d", "(m0ron)", "x,m0ron,y"])
def test_digits_and_marks_within_words(word):
    terms = ["idiot$", "moron$", "stupid", "stupidity$"]
    model = toxicity.ToxicityModel(terms, {(e, t): 3.0 for e in range(3) for t in range(4)}, np.array([-3.0, 1, 1, 0, -0.5, 0.5]))
    assert model.score(f"such {word} indeed") > model.score("such fine indeed")
    assert len(model.hits("an idiot,moron can't be")[1]) == 2


def test_unseen_misspellings_of_beginnings_count(spark):
    rng = random.Random(3)
    docs = [(i, f"{filler(rng)} vundrik{rng.choice('abcdefghij')}{rng.choice('uvwxyz')} {filler(rng)}" if i < 80 else filler(rng, 120)) for i in range(320)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn_toxicity(frame, spark.createDataFrame([(i, int(i < 80)) for i, _ in docs], "doc_id long, toxic int"))
    number = model.terms.index("vundrik")
    assert 0 < model.weights[1, number] < model.weights[0, number]


def test_quotation_and_cues_of_four_languages():
    for text, quoted in (("er „a b“ c d", {1, 2}), ("er »a b« c d", {1, 2}), ("il « a b » c", {1, 2}), ("x “a b” c", {1, 2}),
                         ('x "a" b', {1}), ("er „a” c “d” e", {1, 3}), ("a » b", set()), ("„a\nb", {0})):
        assert toxicity._quoted_words(text) == quoted, text
    model = toxicity.ToxicityModel(["stupid$"], {(0, 0): 6.0}, np.array([-3.0, 1, 1, 0, -0.5, 0.5]))
    plain = model.score("xx stupid indeed")
    assert all(model.score(f"{cue} stupid indeed") < plain for cue in ("schrieb", "écrit", "dijo"))
    assert all(model.score(f"{cue} stupid indeed") > plain for cue in ("du", "vous", "usted"))


def scores(spark, operator, docs, labels, label):
    frame = spark.createDataFrame([(i, t, 0.1, True) for i, t in docs], "doc_id long, text string, score double, held_out boolean")
    return operator(frame, spark.createDataFrame(labels, f"doc_id long, {label} int"))


@pytest.mark.parametrize("operator, label", [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")])
def test_edges(spark, operator, label):
    docs = [(1, "a fine text of some words"), (2, None), (3, ""), (3, "repeated id"), (None, "no id"), (4, "w " * 100_000), (5, "!!! $$$ |"), (6, "漢字 é")]
    for labels in ([], [(1, 1)], [(1, 0), (None, 1), (5, None)], [(1, 1), (2, 0), (3, 0), (3, 1), (4, 1), (5, 0), (5, 0), (99, 1)]):
        rows = scores(spark, operator, docs, labels, label).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in docs)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        by_id = {r.doc_id: r.score for r in rows if r.doc_id != 3}
        empty = [r.score for r in rows if r.doc_id == 3]
        assert by_id[2] in empty
    assert scores(spark, operator, [], [], label).count() == 0


@pytest.mark.parametrize("name, label, folds, fold", [("op2_toxicity", "toxic", 5, 0), ("op6_quality", "quality", 3, 1)])
def test_held_out_results(spark, name, label, folds, fold):
    sf = f"{TESTDATA}/sf0.01"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES[name](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark):
    sf = f"{TESTDATA}/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", (quality.is_held_out(labels.doc_id, 5, 0).cast("int") + labels.toxic) % 2)
    a, b = ({r.doc_id: r.score for r in toxicity.score_toxicity(docs, x).collect()} for x in (labels, turned))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def filler(rng, n=60):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(5, 9))) for _ in range(n))


@pytest.mark.parametrize("family", [False, True])
def test_one_wording_in_many_toxic_documents_is_learned(spark, family):
    """A passage in otherwise different documents, or a family of copies, next to abuse of other words."""
    rng = random.Random(7)
    passage = "zorgling wuxnitz kroppelmonk zyxxolo"
    copy = f"{filler(rng)} {passage} {filler(rng)}"
    toxic = [copy if family else f"{filler(rng)} {passage} {filler(rng)}" for _ in range(60)]
    toxic += [f"{filler(rng)} vundrik {filler(rng)}" for _ in range(60)]
    docs = list(enumerate(toxic + [filler(rng, 120) for _ in range(360)]))
    rows = scores(spark, toxicity.score_toxicity, docs, [(i, int(i < 120)) for i, _ in docs], "toxic").collect()
    assert all(r.predicted for r in rows if r.doc_id < 120)
    clean = [r.predicted for r in rows if r.doc_id >= 120]
    assert sum(clean) <= 0.05 * len(clean)


def test_quadratic_discriminant_by_its_formula():
    rng = np.random.default_rng(3)
    x = [rng.standard_normal((n, 3)) @ m + s for n, m, s in ((60, np.diag([1, 2, 3]), 1.0), (140, np.eye(3), 0.0))]
    model = quality.QuadraticDiscriminant.fit([60, 140], [v.sum(axis=0) for v in x], [v.T @ v for v in x])
    own = [np.cov(v.T, bias=True) for v in x]
    pooled = 0.3 * own[0] + 0.7 * own[1]
    density = []
    for share, v, c in zip((0.3, 0.7), x, own):
        c = (1 - quality.TOWARDS_POOLED) * c + quality.TOWARDS_POOLED * pooled
        c = (1 - quality.TOWARDS_IDENTITY) * c + quality.TOWARDS_IDENTITY * np.trace(c) / 3 * np.eye(3)
        off = x[0] - v.mean(axis=0)
        density.append(np.log(share) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (off @ np.linalg.inv(c) * off).sum(axis=1))
    assert np.allclose(model.score(x[0]), 1 / (1 + np.exp(density[0] - density[1])))


def test_statistics_of_one_text_do_not_depend_on_others():
    texts = ["One Two, two!\nOne Two, two!", "", None, "é$ 1|", "w" * 300_000, "last"]
    together = quality.statistics(texts)
    assert np.allclose(together, np.concatenate([quality.statistics([t]) for t in texts]))
    at = {name: i for i, name in enumerate(quality.STATISTICS)}
    row = together[0]
    assert row[at["words"]] == np.log1p(6) and row[at["capitals"]] == 4 / 6 and row[at["distinct_lines"]] == 0.5 and row[at["distinct_words"]] == 0.5
