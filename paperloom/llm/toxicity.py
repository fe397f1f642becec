"""Toxicity: a learned lexicon, matched through Levenshtein automata, weighed by its context.

The lexicon is a trie of bounded size. Its intersection with the Levenshtein automata of all
terms is one automaton over words, made deterministic as far as texts walk through it, so a word
costs a few dictionary look-ups however many terms there are. Terms, their weights and the final
logistic scale are learned from a bounded sample of labelled rows; scoring reads every text once
and shuffles nothing.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import batch_slices, column, ship, text_groups, written

SAMPLE_ROWS = 40_000  # labelled rows to learn from, at most
LEXICON_TERMS = 2_000
MIN_TOXIC_DOCS = 5  # of the sample, that a term stands in
MIN_LIFT = 15.0  # times as often in toxic documents as in others, cautiously estimated
QUOTED = 0.25  # part of its weight that a term keeps between quotation marks
MISSPELLED = 0.8  # and that a misspelled one keeps
WINDOW = 8  # words on either side that count as context
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W_]+(?:[*@$!_][^\W_]+)*")
_BLOCK = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])


STEMS = (4, 5, 6)  # letters of a word that may be a term by themselves, whatever its ending


def entries(word: str) -> list[str]:
    """The word and its stems, which are marked by an asterisk."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def edit_budget(term: str) -> int:
    """Edits that still count as the term: none in short words, where they make other words."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class FuzzyLexicon:
    """Terms within their edit budget of a word."""

    MOST_STATES = 50_000

    def __init__(self, terms: dict[str, float], ordinary: frozenset[str] = frozenset()):
        self.stems = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        terms = {t: w for t, w in terms.items() if not t.endswith("*")}
        self.weights, self.ordinary = terms, ordinary
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.budget = [0]  # the largest of the terms below
        for term in terms:
            node, allowed = 0, edit_budget(term)
            self.budget[0] = max(self.budget[0], allowed)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.budget.append(0)
                node = self.children[node][letter]
                self.budget[node] = max(self.budget[node], allowed)
            self.term[node] = term
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.items: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, errors: dict[int, int]) -> int:
        """The state of these trie nodes and errors, with what follows by leaving letters out."""
        stack = list(errors)
        while stack:
            node = stack.pop()
            cost = errors[node] + 1
            for child in self.children[node].values():
                if cost <= self.budget[child] and cost < errors.get(child, 99):
                    errors[child] = cost
                    stack.append(child)
        key = tuple(sorted(errors.items()))
        if key not in self.number:
            self.number[key] = len(self.items)
            self.items.append(key)
            self.moves.append({})
            ends = [
                (e, t) for n, e in key if (t := self.term[n]) is not None and e <= edit_budget(t)
            ]
            best = min(ends, default=None)
            self.accepts.append((best[1], best[0]) if best else None)
        return self.number[key]

    def _step(self, state: int, letter: str) -> int:
        errors: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.budget[node] and cost < errors.get(node, 99):
                errors[node] = cost

        for node, cost in self.items[state]:
            reach(node, cost + 1)  # the word has one letter more
            for edge, child in self.children[node].items():
                reach(child, cost + (edge != letter))
        found = self._state(errors) if errors else -1
        self.moves[state][letter] = found
        return found

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its budget and the edits to it; the smaller term at a tie."""
        if len(self.items) > self.MOST_STATES:
            self._reset()
        state = self.start
        for letter in word:
            following = self.moves[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if state < 0:
                return None
        found = self.accepts[state]
        return None if found and found[1] and word in self.ordinary else found

    def weight(self, word: str) -> float:
        found = self.match(word)
        best = self.weights[found[0]] * MISSPELLED ** found[1] if found else 0.0
        if self.stems:
            for k in STEMS:
                if len(word) > k:
                    best = max(best, self.stems.get(word[:k], 0.0))
        return best


def _quoted_spans(text: str) -> list[tuple[int, int]]:
    """Spans between quotation marks within a line, of at most 600 characters."""
    return [m.span() for m in re.finditer(r'"[^"\n]{1,600}"|[«“„][^\n]{1,600}?[»”]', text)]


FEATURES = 5


def features(text: str, weight_of) -> list[float]:
    """What a text's matches add up to.

    Sum of the weights of distinct terms, the heaviest, the heaviest context window, matches
    among a hundred words, and the sum of what stands between quotation marks. Only the last
    one counts quoted terms in full; elsewhere they keep the part QUOTED of their weight.
    """
    hits, position = [], 0
    for position, m in enumerate(_WORD.finditer(text), 1):
        weight = weight_of(m.group())
        if weight:
            hits.append((position, m.start(), m.group(), weight))
    if not hits:
        return [0.0] * FEATURES
    spans = _quoted_spans(text)
    at, quoted, own, placed = 0, {}, {}, []
    for place, start, word, weight in hits:
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        inside = at < len(spans) and spans[at][0] <= start
        if inside:
            quoted[word] = weight
        own[word] = max(own.get(word, 0.0), weight * QUOTED if inside else weight)
        placed.append((place, weight * QUOTED if inside else weight))
    heaviest = total = first = 0.0
    first = 0
    for place, weight in placed:
        total += weight
        while placed[first][0] < place - 2 * WINDOW:
            total -= placed[first][1]
            first += 1
        heaviest = max(heaviest, total)
    return [
        math.log1p(sum(own.values())),
        max(own.values()),
        math.log1p(heaviest),
        min(20.0, 100.0 * len(hits) / position),
        math.log1p(sum(quoted.values())),
    ]


class _Memo(dict):
    """Weights of the words of one group of texts."""

    def __init__(self, lexicon: FuzzyLexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        value = self[word] = self.lexicon.weight(word)
        return value


@lru_cache(maxsize=1)
def _lexicon(terms: tuple, ordinary: frozenset) -> FuzzyLexicon:
    return FuzzyLexicon(dict(terms), ordinary)


def _featured(batches, terms: tuple, ordinary: frozenset):
    """Columns and feature rows of groups of texts."""
    lexicon = _lexicon(terms, ordinary)
    for columns, texts in text_groups(batches):
        lowered = [t.decode("utf-8").lower() for t in texts]
        words: set[str] = set()
        for text in lowered:
            words.update(_WORD.findall(text))
        weights = {w: x for w in words if (x := lexicon.weight(w))}
        rows = []
        for text in lowered:
            rows.append(features(text, lambda w: weights.get(w, 0.0)))
        yield columns, rows


def _count_words(batches):
    """Documents by word: toxic and other ones."""
    for columns, texts in text_groups(batches):
        counts: dict[str, list[int]] = {}
        for toxic, text in zip(columns[0], texts, strict=True):
            seen: set[str] = set()
            for word in set(_WORD.findall(text.decode("utf-8").lower())):
                seen.update(entries(word))
            for word in seen:
                counts.setdefault(word, [0, 0])[0 if toxic else 1] += 1
        toxic, clean = zip(*counts.values(), strict=True) if counts else ((), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts), pa.string()),
                pa.array(toxic, pa.int64()),
                pa.array(clean, pa.int64()),
            ],
            schema=_BLOCK,
        )


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model, the intercept last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _terms(counts: DataFrame, n_toxic: int, n_clean: int) -> tuple:
    """The lexicon: words and stems by how much likelier they are in toxic documents."""
    lift = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 2) / (n_clean + 4))
    top = (
        counts.filter((F.col("toxic") >= MIN_TOXIC_DOCS) & (F.length("word") > 2))
        .select("word", lift.alias("lift"), "toxic")
        .filter(F.col("lift") >= MIN_LIFT)
        .orderBy(F.desc(F.col("lift") * F.col("toxic")), "word")
        .limit(LEXICON_TERMS)
    )
    return tuple(sorted((r.word, math.log(r.lift)) for r in top.collect()))


def _ordinary(counts: DataFrame, terms: tuple) -> frozenset:
    """Words of clean texts that look like a misspelled term; at most the sample's words."""

    def near(batches):
        lexicon = _lexicon(terms, frozenset())
        for batch in batches:
            words = batch.column(0).to_pylist()
            matches = [w for w in words if (m := lexicon.match(w)) and m[1]]
            yield pa.RecordBatch.from_arrays([pa.array(matches, pa.string())], ["word"])

    clean = counts.filter("clean > 0 AND NOT endswith(word, '*')").select("word")
    return frozenset(r.word for r in clean.mapInArrow(near, "word string").collect())


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Lexicon and logistic scale from the labelled rows.

    `labels` has doc_id and toxic; rows without either are left out, and of several rows for a
    document one that says toxic is enough. At most `sample_rows` documents are used, those with
    the smallest hashes of doc_id, each once: of several texts the smallest. The scale is fitted
    on each half of them with the other half's lexicon, so that it knows how well terms hold on
    new texts; the lexicon of the model comes from both. Without labelled rows of both kinds nothing is found toxic.
    """
    spark = docs.sparkSession
    ship(spark)
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    order = F.xxhash64("doc_id")
    chosen = known.orderBy(order, "doc_id").limit(sample_rows)
    part = F.pmod(order, F.lit(2)).cast("int").alias("part")
    sample = written(
        docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
        .join(F.broadcast(chosen), F.col("id") == F.col("doc_id"))
        .groupBy("doc_id")
        .agg(F.first("toxic").alias("toxic"), F.min("body").alias("text"))
        .select(part, "toxic", "text"),
        "labelled",
    )
    n = {tuple(r[:2]): r[2] for r in sample.groupBy("part", "toxic").count().collect()}
    model: dict = {"terms": (), "ordinary": frozenset(), "weights": [0.0] * FEATURES + [-5.0]}
    if not all(n.get((p, t)) for p in (0, 1) for t in (False, True)):
        return model
    halves = [
        sample.filter(F.col("part") == p)
        .select("toxic", "text")
        .mapInArrow(_count_words, "word string, toxic long, clean long")
        .withColumn("part", F.lit(p))
        for p in (0, 1)
    ]
    counts = written(
        halves[0]
        .unionByName(halves[1])
        .groupBy("part", "word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "words",
    )
    sums = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    terms = _terms(sums, n[0, True] + n[1, True], n[0, False] + n[1, False])
    model |= {"terms": terms, "ordinary": _ordinary(sums, terms)}

    x, y = [], []
    for p in (0, 1):
        own = counts.filter(F.col("part") == p)
        found = _terms(own, n[p, True], n[p, False])
        usual = _ordinary(own, found)

        def rows(batches, found=found, usual=usual):
            for columns, values in _featured(batches, found, usual):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.bool_()), pa.array(values, pa.list_(pa.float64()))],
                    ["toxic", "x"],
                )

        other = sample.filter(F.col("part") != p).select("toxic", "text")
        for r in other.mapInArrow(rows, "toxic boolean, x array<double>").collect():
            x.append(r.x)
            y.append(float(r.toxic))
    model["weights"] = _logistic(np.array(x), np.array(y)).tolist()
    return model


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from THRESHOLD on) of every row of `docs`.

    A null text counts as empty and gets the score of a text without matches. A null doc_id and
    repeated rows are kept. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    terms, ordinary = model["terms"], model["ordinary"]
    w = np.array(model["weights"])

    def run(batches):
        for columns, rows in _featured(batches, terms, ordinary):
            z = np.array(rows).reshape(-1, FEATURES) @ w[:-1] + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(p), pa.array((p >= THRESHOLD) * 1, pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """`docs` without the rows whose text is predicted toxic; all columns stay as they are."""
    ship(docs.sparkSession)
    terms, ordinary = model["terms"], model["ordinary"]
    w, at = np.array(model["weights"]), docs.columns.index(text)
    # The odds at which a score reaches the threshold.
    limit = math.log(THRESHOLD / (1 - THRESHOLD))

    def run(batches):
        for part in batch_slices(batches, at):
            texts = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(part.num_rows)), part.column(at)], ["row", "text"]
            )
            for columns, rows in _featured([texts], terms, ordinary):
                z = np.array(rows).reshape(-1, FEATURES) @ w[:-1] + w[-1]
                yield part.take(pa.array(np.array(columns[0])[z < limit]))

    return docs.mapInArrow(run, docs.schema)


def in_fold(doc_id, fold: int, folds: int):
    return F.crc32(doc_id.cast("string")) % folds == fold


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out third."""
    return labels.filter(~in_fold(F.col("doc_id"), 1, 3))


def toxic_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; learned from labelled rows outside the held-out third.

    held_out: crc32 of doc_id as text leaves 1 when divided by 3 (null for a null doc_id).
    """
    scored = score(docs, learn(docs, training_labels(labels)))
    return scored.withColumn("held_out", in_fold(F.col("doc_id"), 1, 3))
