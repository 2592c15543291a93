"""Toxicity by a learned lexicon that also catches misspelled terms.

Terms (whole words, or beginnings of words) are learned from labelled documents.
They form a trie; the Levenshtein automata of its terms, intersected with the trie,
are walked as one deterministic automaton whose states are made when first needed:
a state is the set of trie nodes that can be reached, each with its fewest edits.

Each hit looks at the words around it: what stands in quotation marks or after a
reporting word counts less, what addresses somebody counts more. A document's score
is a logistic function of its total, of its worst window and of their density.
"""

from __future__ import annotations

import math
import pickle
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.quality import is_held_out, one_label_each
from eventloom.llm.staging import keep, stage

#: At most about so many labelled rows of each class are learned from.
MAX_TOXIC, MAX_CLEAN = 4_000, 12_000
#: At most so many terms, the most telling first.
MAX_TERMS = 5_000
#: A term is in this many toxic documents at least, copies of a text counted once, with
#: at least this log-likelihood ratio and log odds.
MIN_DOCS, MIN_RATIO, MIN_ODDS = 3, 15.0, 1.5
_SHORTEST, _LONGEST = 3, 12
WINDOW = 12
QUOTED, ADDRESSED = 0.25, 1.25
#: In English, German, French and Spanish; without words that mean something else in another of these.
REPORTING = frozenset(
    """said says say wrote writes called calls quote quoted quotes reported term word words
    sagt sagte sagten schrieb schreibt nannte nennt zitat zitiert zitierte begriff wort worte wörter berichtete
    dit disait écrit écrivait appelle appelait appelé citation cité citait terme mot mots
    dijo dijeron decía escribió escribe llamó llama cita citó término palabra palabras""".split()
)
ADDRESSING = frozenset(
    """you your youre yours yourself du dich dir dein deine deinen deiner deinem euch euer eure
    tu te toi tes vous votre vos tú ti tus usted ustedes vosotros vosotras vuestro vuestra contigo""".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_PIECES = re.compile(r"([^\W\d_]+)")
_END = "$"
#: Words whose hits, and states whose moves, a model remembers at most; then it forgets them all.
_CACHED, _STATES = 100_000, 60_000
#: Counted keys that a task holds at most before it passes them on.
_HELD = 100_000


def _edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class LexiconAutomaton:
    """Levenshtein automata of all ``terms``, intersected with their trie.

    A term that ends with ``$`` is a whole word, any other the begin of words.
    """

    _DEAD = -1

    def __init__(self, terms: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.whole, self.begin = {}, {}  # node -> number of the term
        allowed = [0]
        self.allowed = [_edits(len(t.removesuffix(_END))) for t in terms]
        for number, term in enumerate(terms):
            node = 0
            allowed[0] = max(allowed[0], self.allowed[number])
            for char in term.removesuffix(_END):
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    allowed.append(0)
                node = self.children[node][char]
                allowed[node] = max(allowed[node], self.allowed[number])
            (self.whole if term.endswith(_END) else self.begin)[node] = number
        self.most = allowed
        self.alphabet = {char for below in self.children for char in below}
        self._forget()

    def _forget(self) -> None:
        self._numbers: dict[bytes, int] = {}
        self._states: list[bytes] = []  # nodes with their edits, packed: a tuple takes twenty times as much
        self._moves: list[dict[str, int]] = []
        self._whole: list[tuple | None] = []
        self._begin: list[tuple | None] = []
        self._start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of the state of nodes and edits, closed under leaving out characters of a term."""
        todo = list(reached.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.most[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    todo.append((child, edits + 1))
        if not reached:
            return self._DEAD
        key = array("I", sorted(node << 2 | edits for node, edits in reached.items())).tobytes()
        if key not in self._numbers:
            self._numbers[key] = len(self._states)
            self._states.append(key)
            self._moves.append({})
            self._whole.append(self._best(reached, self.whole))
            self._begin.append(self._best(reached, self.begin))
        return self._numbers[key]

    def _best(self, reached: dict[int, int], ends: dict[int, int]) -> tuple | None:
        found = [(edits, ends[node]) for node, edits in reached.items() if node in ends and edits <= self.allowed[ends[node]]]
        return min(found, default=None)

    def _move(self, state: int, char: str) -> int:
        char = char if char in self.alphabet else ""
        known = self._moves[state].get(char)
        if known is not None:
            return known
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for packed in array("I", self._states[state]):
            node, edits = packed >> 2, packed & 3
            reach(node, edits + 1)  # a character too many
            for label, child in self.children[node].items():
                reach(child, edits + (label != char))
        self._moves[state][char] = found = self._state(reached)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the term with the fewest edits, the first of these; None if none fits."""
        if len(self._states) >= _STATES:
            self._forget()
        state, best = self._start, None
        for char in word:
            moves = self._moves[state]
            state = moves[char] if char in moves else self._move(state, char)
            if state < 0:
                return best
            found = self._begin[state]
            if found and (best is None or found < best):
                best = found
        found = self._whole[state]
        return found if found and (best is None or found < best) else best


class ToxicityModel:
    """``weights`` by (edits, term); ``bend`` are the coefficients of ``features``."""

    def __init__(self, terms: list[str], weights: dict[tuple[int, int], float], bend: np.ndarray) -> None:
        self.terms, self.weights, self.bend = terms, weights, bend
        self._ready()

    def _ready(self) -> None:
        self._automaton = LexiconAutomaton(self.terms)
        self._known: dict[str, tuple[int, int] | None] = {}

    def __getstate__(self) -> tuple:
        return self.terms, self.weights, self.bend

    def __setstate__(self, state: tuple) -> None:
        self.terms, self.weights, self.bend = state
        self._ready()

    def hit(self, word: str) -> tuple[int, int] | None:
        known = self._known
        if word in known:
            return known[word]
        if len(known) >= _CACHED:
            known.clear()
        found = self._automaton.match(word)
        known[word] = found
        return found

    def hits(self, text: str) -> tuple[list[str], list[tuple[int, tuple[int, int]]]]:
        """The words (of letters), and (position, hit) of those that fit a term.

        Words with a digit or mark or two between them are also tried as one, as in
        ``id1ot``: each such character is an edit, and a term has two at most.
        """
        pieces, hit = _PIECES.split(text), self.hit
        words, gaps = pieces[1::2], pieces[0::2]
        hits = [(i, found) for i, word in enumerate(words) if (found := hit(word))]
        joined = []
        for i in range(1, len(words)):
            gap = gaps[i]
            if gap == " " or len(gap) > 2 or gap.split() != [gap]:
                continue
            spans = [(i, words[i - 1] + gap + words[i])]
            after = gaps[i + 1]
            if i + 1 < len(words) and len(gap) == len(after) == 1 and not after.isspace():
                spans.append((i + 1, spans[0][1] + after + words[i + 1]))
            for last, word in spans:
                found = hit(word)
                if found and all(f is None or f[1] != found[1] for f in map(hit, words[i - 1 : last + 1])):
                    joined.append((i - 1, found))
        return words, sorted({*hits, *joined}) if joined else hits

    def features(self, text: str) -> np.ndarray:
        """Of the contributions of all hits: total, worst window, density, quoted part, whether any."""
        text = text.lower()
        words, hits = self.hits(text)
        hits = [(at, w) for at, key in hits if (w := self.weights.get(key, 0.0))]
        if not hits:
            return np.array([1.0, 0, 0, 0, 0, 0])
        quoted = _quoted_words(text) if _QUOTE.search(text) else frozenset()
        places, values, muted = [], [], 0.0
        for at, weight in hits:
            around = words[max(0, at - WINDOW) : at + WINDOW + 1]
            if at in quoted or not REPORTING.isdisjoint(words[max(0, at - 3) : at]):
                muted += weight * (1 - QUOTED)
                weight *= QUOTED
            if not ADDRESSING.isdisjoint(around):
                weight *= ADDRESSED
            places.append(at)
            values.append(weight)
        sums = np.concatenate([[0.0], np.cumsum(values)])
        places = np.array(places)
        low, high = np.searchsorted(places, places - WINDOW), np.searchsorted(places, places + WINDOW, "right")
        total, peak = sums[-1], (sums[high] - sums[low]).max()
        return np.array([1.0, math.log1p(max(total, 0)), math.log1p(max(peak, 0)),
                         math.log1p(max(total, 0) * 100 / (len(words) + 20)), math.log1p(muted), 1.0])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text or "") @ self.bend, -500, 500))))


_MARKS = "\"“”„‟«»"
_QUOTE = re.compile(f"[{_MARKS}]")
#: Opening marks with those that close them: English, German and French or Spanish ones, and »reversed« ones.
_CLOSING = {'"': '"', "“": "”", "„": "“”‟\"", "‟": "”", "«": "»", "»": "«"}


def _quoted_words(text: str) -> set[int]:
    """Positions of words between quotation marks of one line."""
    found, number = set(), 0
    for line in text.split("\n"):
        closing, last = "", line.rfind("«")
        for piece in re.finditer(f"[{_MARKS}]|[^\\W\\d_]+", line):
            mark = piece[0]
            if mark not in _MARKS:
                if closing:
                    found.add(number)
                number += 1
            elif closing:
                closing = "" if mark in closing else closing
            elif mark != "»" or piece.end() <= last:
                closing = _CLOSING.get(mark, "")
    return found


# -- learning --------------------------------------------------------------------


def _document_terms(text: str) -> set[str]:
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.update(word[:n] for n in range(_SHORTEST, min(len(word), _LONGEST) + 1))
        if _SHORTEST <= len(word) <= 2 * _LONGEST:
            found.add(word + _END)
    return found


#: Kinds of labelled documents: clean, toxic, and toxic with the text of another one.
_CLEAN, _TOXIC, _COPY = 0, 1, 2


def _count_by_kind(keys) -> object:
    """Per task, how many documents of each kind have each of ``keys(text)``."""

    def rows(kind: int, found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"key": pa.array(list(found), pa.string()), "kind": pa.array([kind] * len(found), pa.int32()),
             "n": pa.array(list(found.values()), pa.int64())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter(), Counter())
        for batch in batches:
            for text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[kind].update(keys(text or ""))
                if len(counts[kind]) > _HELD:  # added up again behind the shuffle
                    yield rows(kind, counts[kind])
                    counts[kind].clear()
        for kind, found in enumerate(counts):
            if found:
                yield rows(kind, found)

    return run


def _counts(train: DataFrame, keys) -> DataFrame:
    """Rows (key, toxic, texts, clean): toxic documents, different texts of these, clean documents."""
    parts = train.select("text", "kind").mapInArrow(_count_by_kind(keys), "key string, kind int, n long")
    n, kind = F.col("n"), F.col("kind")
    return parts.groupBy("key").agg(
        F.sum(F.when(kind != _CLEAN, n).otherwise(0)).alias("toxic"),
        F.sum(F.when(kind == _TOXIC, n).otherwise(0)).alias("texts"),
        F.sum(F.when(kind == _CLEAN, n).otherwise(0)).alias("clean"),
    )


def _with_kinds(train: DataFrame) -> DataFrame:
    """(place, text, label, kind) of (place, text, label).

    Case and white space do not make texts different. Only digests are shuffled; the
    places of the first of each text are bounded by the sample and broadcast.
    """
    digest = F.sha2(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " "), 256)
    firsts = train.where("label = 1").groupBy(digest.alias("digest")).agg(F.min("place").alias("place"))
    marked = train.join(F.broadcast(firsts.select("place", F.lit(True).alias("first"))), "place", "left")
    kind = F.when(F.col("label") == 0, _CLEAN).when(F.col("first"), _TOXIC).otherwise(_COPY)
    return marked.select("place", "text", "label", kind.alias("kind"))


def _log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def _telling(counts: DataFrame, toxic: str, n_toxic: int, n_clean: int) -> DataFrame:
    """Rows of terms that speak for toxicity by their numbers ``toxic`` and clean, with their log-likelihood ``ratio``."""
    toxic, clean = F.col(toxic), F.col("clean")
    seen = toxic + clean
    share = n_toxic / (n_toxic + n_clean)
    ratio = 2 * (
        toxic * F.log(toxic / (seen * share)) + F.when(clean > 0, clean * F.log(clean / (seen * (1 - share)))).otherwise(0.0)
    )
    odds = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    return counts.where(toxic >= MIN_DOCS).withColumn("ratio", ratio).where((F.col("ratio") >= MIN_RATIO) & (odds >= MIN_ODDS))


@dataclass
class _Candidate:
    term: str
    toxic: int
    clean: int
    ratio: float


def choose_terms(rows: list[tuple[str, int, int, float]]) -> list[str]:
    """Of (term, toxic, clean, ratio): the most telling, none a begin of another.

    A begin gives way to a longer one, or a word, that is in nearly as many toxic documents.
    """
    known = {term: _Candidate(term, toxic, clean, ratio) for term, toxic, clean, ratio in rows}
    longer: dict[str, list[str]] = {}
    for term in known:
        parent = term[:-1]
        if len(parent) >= _SHORTEST:
            longer.setdefault(parent, []).append(term)

    def settled(term: str) -> str:
        while True:
            same = [t for t in longer.get(term, []) if known[t].toxic >= 0.95 * known[term].toxic]
            if not same:
                return term
            term = max(same, key=lambda t: (known[t].ratio, t))

    chosen: set[str] = set()
    begins: set[str] = set()  # of chosen terms
    for candidate in sorted(known.values(), key=lambda c: (-c.ratio, -len(c.term), c.term)):
        term = settled(candidate.term)
        bare = term.removesuffix(_END)
        if term in chosen or term in begins or any(bare[:n] in chosen for n in range(_SHORTEST, len(bare) + 1)):
            continue
        chosen.add(term)
        begins.update(bare[:n] for n in range(_SHORTEST, len(bare) + (term != bare)))
        if len(chosen) >= MAX_TERMS:
            break
    return sorted(chosen)


def _regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method; a step is halved until it does not lose likelihood."""
    beta = np.zeros(x.shape[1])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float(weight @ (np.logaddexp(0, z) - y * z) + penalty / 2 * at @ at)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + (penalty + 1e-9) * np.eye(len(beta))
        step = np.linalg.solve(curve, gradient)
        before = loss(beta)
        while np.abs(step).max() >= 1e-6 and loss(beta + step) > before:
            step /= 2
        if np.abs(step).max() < 1e-6:
            break
        beta += step
    return beta


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    """From at most about ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled documents, chosen by a hash of their id.

    The chosen ids have that bound, so they are broadcast. Terms are counted by
    document in Spark; the driver gets the terms that pass the tests, and eight
    numbers for each chosen document.

    Copies of a text repeat all its words, so terms are chosen by different texts
    first. Toxic documents which these terms do not tell, such as a family of copies
    with words of its own, are then counted each, and give terms of their own.
    """
    one = one_label_each(labels, label_col, id_col)
    sizes = {r.label: r.n for r in one.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {c: min(1.0, most / max(sizes.get(c, 0), 1)) for c, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))}
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    chosen = one.where(place < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # An id on many rows is learned from once, by its smallest text.
    train = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    train = train.select(F.monotonically_increasing_id().alias("place"), "text", "label")
    train = _with_kinds(stage(train, "toxic")).repartition(24)
    seen = {r.kind: r.n for r in train.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_texts, n_clean = seen.get(_TOXIC, 0), seen.get(_CLEAN, 0)
    n_toxic = n_texts + seen.get(_COPY, 0)
    if not n_toxic or not n_clean:
        # Only one class, or none: every score is that of the class, or even.
        bend = np.zeros(6)
        bend[0] = (math.inf if n_toxic else -math.inf) if n_toxic or n_clean else 0.0
        return ToxicityModel([], {}, np.nan_to_num(bend, posinf=500, neginf=-500))
    # By either number; most of all keys are not telling by any.
    columns = ("key", "toxic", "texts", "clean", "ratio")
    counts = stage(_counts(train, _document_terms).where(F.col("toxic") >= MIN_DOCS), "counts")
    telling = [
        _telling(counts, by, n, n_clean).select(*columns).orderBy(F.desc("ratio"), "key").limit(20 * MAX_TERMS)
        for by, n in (("texts", n_texts), ("toxic", n_toxic))
    ]
    terms = choose_terms([(r.key, r.texts, r.clean, r.ratio) for r in telling[0].collect()])
    model, missed = _fit(train, terms, n_toxic, n_texts, n_clean, share)
    clean = {r.key: r.clean for r in telling[1].select("key", "clean").collect()} if len(missed) >= MIN_DOCS else {}
    if not clean:
        return model
    places = docs.sparkSession.createDataFrame([(p,) for p in missed], "place long")
    rest = train.join(F.broadcast(places), "place", "left_semi")
    left = _counts(rest, lambda text: _document_terms(text) & clean.keys()).drop("clean").join(telling[1].select("key", "clean"), "key")
    more = choose_terms([(r.key, r.toxic, r.clean, r.ratio) for r in _telling(left, "toxic", n_toxic, n_clean).collect()])
    # A begin among the first terms also stands for its longer forms.
    known = set(terms)
    more = [t for t in more if not any(t[:n] in known for n in range(_SHORTEST, len(t) + 1))][: MAX_TERMS - len(terms)]
    if not more:
        return model
    return _fit(train, sorted(known.union(more)), n_toxic, n_texts, n_clean, share)[0]


def _fit(
    train: DataFrame, terms: list[str], n_toxic: int, n_texts: int, n_clean: int, share: dict[int, float]
) -> tuple[ToxicityModel, list[int]]:
    """The model with these terms, and the places of toxic documents that it does not find."""
    plain = ToxicityModel(terms, {}, np.zeros(6))

    def hit_keys(text: str) -> set[str]:
        return {f"{edits} {term}" for _, (edits, term) in plain.hits(text.lower())[1]}

    found = {tuple(map(int, r.key.split())): (r.toxic, r.texts, r.clean) for r in _counts(train, hit_keys).collect()}

    def odds(toxic: int, texts: int, clean: int) -> float:
        return max(_log_odds(toxic, clean, n_toxic, n_clean), _log_odds(texts, clean, n_texts, n_clean))

    weights = {}
    for number, term in enumerate(terms):
        exact = odds(*found.get((0, number), (0, 0, 0)))
        for edits in range(_edits(len(term.removesuffix(_END))) + 1):
            if (edits, number) in found:
                weight = odds(*found[edits, number])
            else:  # no such misspelling seen, in clean documents neither: a word's counts half, a begin's a third
                weight = exact / (2 if term.endswith(_END) else 3)
            if weight > 0.5:
                weights[edits, number] = weight
    model = ToxicityModel(terms, weights, np.zeros(6))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([model.features(t or "") for t in batch.column(0).to_pylist()]).reshape(-1, 6)
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array(list(x), pa.list_(pa.float64())), "label": batch.column(1).cast(pa.int32()), "place": batch.column(2)}
            )

    sample = train.select("text", "label", "place").mapInArrow(features, "x array<double>, label int, place long").collect()
    x = np.array([r.x for r in sample])
    y = np.array([r.label for r in sample], float)
    # Each class was thinned by its own share.
    weight = np.where(y == 1, 1 / share[1], 1 / share[0])
    bend = _regression(x, y, weight / weight.mean())
    return ToxicityModel(terms, weights, bend), [r.place for r, v in zip(sample, x @ bend) if r.label == 1 and v < 0]


def score_udf(model: ToxicityModel) -> object:
    """A function of a text column; the model, at most ``MAX_TERMS`` terms, goes with it."""
    data = pickle.dumps(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        ready = keep("toxicity", data, lambda: pickle.loads(data))
        return pa.array([ready.score(t) for t in texts.to_pylist()], pa.float64())

    return score


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    fold: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """(``id_col``, held_out, score, predicted) of every row.

    Learns from the rows of ``labels`` that ``is_held_out`` does not name; only
    the text gives the score. Null and empty texts have the score of a text
    without hits. Rows with one id are scored each, null ids too. An id with
    several labels has that of most, 1 in a tie. With labels of one class alone
    the score is 0 or 1, without any 0.5. An empty table gives no rows; other
    columns are not kept.
    """
    model = learn_toxicity(docs, labels.where(~is_held_out(F.col(f"`{id_col}`"), folds, fold)), id_col, text_col, label_col)
    key = F.col(f"`{id_col}`")
    return docs.select(
        key.alias(id_col), is_held_out(key, folds, fold).alias("held_out"), score_udf(model)(F.col(f"`{text_col}`")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    fold: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below 0.5; see ``score_toxicity``."""
    model = learn_toxicity(docs, labels.where(~is_held_out(F.col(f"`{id_col}`"), folds, fold)), id_col, text_col, label_col)
    return docs.where(score_udf(model)(F.col(f"`{text_col}`")) < 0.5)
