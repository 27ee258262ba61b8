"""Toxicity: a lexicon trie, Levenshtein automata over it, and context windows around the hits.

The lexicon is learned: words, and word beginnings of 4 to 7 characters, whose share of toxic training
documents exceeds their share of clean ones even at the lower end of a 95 % interval. It is kept in a trie.
A token is looked up exactly, by its beginning, and by a Levenshtein automaton (``MAX_EDITS`` edits)
intersected with the trie of whole words; the intersection is made deterministic lazily, state by state.
Around a hit a window of tokens and the quotation marks of its line tell quotation or report from abuse;
quoted hits go to a feature of their own. A logistic model turns the features into a score.

Only labelled rows that ``train`` admits are learned from, at most ``MAX_TRAIN`` of them in hash order (so
their ids may be broadcast); the features the model is fitted on come from the lexicon of the other folds.
The lexicon holds every term that passes, so its size is bounded by that sample. Scoring reads every whole text.

Defined results: null and empty texts have no hits and get the score of a text without hits; a document
with several labels counts as toxic if one says so; without toxic or without clean training rows every
score is the smoothed share of toxic ones; labels other than 0 and 1 are none; repeated rows score alike; extra columns pass
through, but for score and predicted, which are replaced.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import crc32_of, table

MAX_TRAIN = 20_000
MIN_DOCS = 3
MIN_STRENGTH = 0.7
MAX_EDITS, MIN_FUZZY = 1, 5
BEGINNINGS = range(4, 8)
WINDOW = 8
THRESHOLD = 0.3
TOKEN = re.compile(r"\w+")
CLOSED_BY = {"“": "”", "„": "“”", "«": "»", "‹": "›", '"': '"'}
MARK = re.compile("[“”„«»‹›\"\\n]")
#: A start for the lexicon: common insults, with the weight of a learned word of medium strength.
SEEDS = "arsehole asshole bastard bitch clown cretin disgusting dumbass freak idiot imbecile jerk loser moron pathetic pervert scum scumbag stupid trash ugly useless vermin worthless arschloch abschaum dummkopf drecksack schlampe connard crétin ordure pourriture salaud estúpido imbécil gilipollas basura escoria".split()
SEED_WEIGHT = 1.5
FOLDS = 5
#: Words that report what another said (English, German, French, Spanish).
REPORTING = frozenset("said says wrote called quote quoted sagte sagt schrieb nannte zitat dit disait écrit appelé citation dijo dice escribió llamó cita".split())
SEED_ENTRIES = [(w, "w", SEED_WEIGHT) for w in SEEDS]
FEATURES = "strongest double, total double, hits double, density double, fuzzy double, quoted double"


class Lexicon:
    """Trie of words (kind w) and beginnings (kind b) with weights."""

    def __init__(self, entries: list[tuple[str, str, float]]):
        self.entries = entries
        self.children: list[dict[str, int]] = [{}]
        self.word: list[float] = [0.0]
        self.beginning: list[float] = [0.0]
        self.fuzzy: list[float] = [0.0]
        self.depth_of: list[bool] = [False]  # lies on the way to a word that may be misspelled
        for text, kind, weight in entries:
            node, path = 0, [0]
            for ch in text:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    for column, empty in ((self.children, {}), (self.word, 0.0), (self.beginning, 0.0), (self.fuzzy, 0.0), (self.depth_of, False)):
                        column.append(dict(empty) if isinstance(empty, dict) else empty)
                node = self.children[node][ch]
                path.append(node)
            mine = self.word if kind == "w" else self.beginning
            mine[node] = max(mine[node], weight)
            if kind == "w" and len(text) >= MIN_FUZZY:
                self.fuzzy[node] = max(self.fuzzy[node], weight)
                for p in path:
                    self.depth_of[p] = True
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accept: list[float] = []
        self.start = self._state(self._closed({(0, 0)})) if self.depth_of[0] else -1
        self.known: dict[str, tuple[float, float]] = {}

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """With what one or more skipped lexicon characters reach; a pair is dominated by the same node at fewer edits."""
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, edits = todo.pop()
            if best.get(node, MAX_EDITS + 1) <= edits:
                continue
            best[node] = edits
            if edits < MAX_EDITS:
                todo += [(child, edits + 1) for child in self.children[node].values() if self.depth_of[child]]
        return frozenset(best.items())

    def _state(self, pairs: frozenset) -> int:
        if not pairs:
            return -1
        if pairs not in self.states:
            self.states[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.moves.append({})
            self.accept.append(max((self.fuzzy[node] for node, _ in pairs), default=0.0))
        return self.states[pairs]

    def _step(self, state: int, ch: str) -> int:
        reached = set()
        for node, edits in self.sets[state]:
            child = self.children[node].get(ch)
            if child is not None and self.depth_of[child]:
                reached.add((child, edits))
            if edits < MAX_EDITS:
                reached.add((node, edits + 1))  # a character too many
                reached.update((other, edits + 1) for c, other in self.children[node].items() if c != ch and self.depth_of[other])
        self.moves[state][ch] = found = self._state(self._closed(reached))
        return found

    def lookup(self, token: str) -> tuple[float, float]:
        """Weight of the word itself or of its beginning, and of a word it may misspell."""
        node, exact = 0, 0.0
        for ch in token:
            node = self.children[node].get(ch, -1)
            if node < 0:
                break
            exact = max(exact, self.beginning[node])
        if node > 0:
            exact = max(exact, self.word[node])
        if exact:
            return exact, 0.0
        state = self.start
        for ch in token:
            if state < 0:
                return 0.0, 0.0
            nxt = self.moves[state].get(ch)
            state = self._step(state, ch) if nxt is None else nxt
        return 0.0, self.accept[state] if state >= 0 and len(token) >= MIN_FUZZY - 1 else 0.0

    def hit(self, token: str) -> tuple[float, float]:
        found = self.known.get(token)
        if found is None:
            if len(self.known) > 300_000:
                self.known.clear()
            found = self.known[token] = self.lookup(token)
        return found

    def features(self, text: str | None) -> tuple[float, ...]:
        if not text:
            return (0.0,) * 6
        low = text.lower()
        tokens = TOKEN.findall(low)
        hits = {t for t in set(tokens) if any(self.hit(t))}
        if not hits:
            return (0.0,) * 6
        strongest = total = fuzzy = quoted = 0.0
        n = 0
        where, spans = list(TOKEN.finditer(low)), quoted_spans(low)
        for i, m in enumerate(where):
            if m[0] not in hits:
                continue
            exact, near = self.hit(m[0])
            if is_quoted(spans, m.start(), m.end()) or any(x[0] in REPORTING for x in where[max(0, i - WINDOW) : i]):
                quoted += exact or near
                continue
            n += 1
            total, fuzzy = total + exact, fuzzy + near
            strongest = max(strongest, exact, near * 0.8)
        return strongest, np.log1p(total), np.log1p(n), min(100.0 * n / len(tokens), 20.0) / 10, np.log1p(fuzzy), np.log1p(quoted)


def quoted_spans(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of what stands between quotation marks, in one pass over the marks of every whole line; merged and in order."""
    spans: list[tuple[int, int]] = []
    opened: dict[str, list[int]] = {c: [] for c in CLOSED_BY}
    for m in MARK.finditer(text):
        c = m[0]
        if c == "\n":
            opened = {c: [] for c in CLOSED_BY}
            continue
        last = max((o for o in CLOSED_BY if opened[o] and c in CLOSED_BY[o]), key=lambda o: opened[o][-1], default=None)
        if last is not None:
            spans.append((opened[last].pop(), m.start()))
        elif c in CLOSED_BY:
            opened[c].append(m.end())
    starts, ends = [], []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def is_quoted(spans: tuple[list[int], list[int]], start: int, end: int) -> bool:
    at = bisect_right(spans[0], start) - 1
    return at >= 0 and end <= spans[1][at]


_LEXICONS: dict[str, Lexicon] = {}


def lexicon(entries: list[tuple[str, str, float]]) -> Lexicon:
    """One automaton for each worker process and lexicon."""
    key = hashlib.md5(repr(entries).encode()).hexdigest()
    if key not in _LEXICONS:
        _LEXICONS.clear() if len(_LEXICONS) > 8 else None
        _LEXICONS[key] = Lexicon(entries)
    return _LEXICONS[key]


def term_counts(rows: DataFrame) -> DataFrame:
    """(text, toxic, fold) to documents by (kind, term): clean and toxic ones of each fold, added up inside a task first."""

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            keys = [k for k, _ in held.items()]
            values = list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int32()), pa.array(values, pa.int64())], names=["kind", "term", "slot", "n"])

        for batch in incoming:
            for text, toxic, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = set(TOKEN.findall((text or "").lower()))
                slot = 2 * fold + toxic
                held.update(("w", w, slot) for w in words)
                held.update(("b", b, slot) for b in {w[:n] for w in words for n in BEGINNINGS if len(w) > n})
                if len(held) > 400_000:
                    yield out()
        yield out()

    counted = rows.select("text", "toxic", "fold").mapInArrow(count, "kind string, term string, slot int, n long")
    return counted.groupBy("kind", "term").agg(*[F.coalesce(F.sum(F.when(F.col("slot") == s, F.col("n"))), F.lit(0)).alias(f"n{s}") for s in range(2 * FOLDS)])


def strongest_terms(counts: DataFrame, sizes: dict[int, int], folds: list[int]) -> list[tuple[str, str, float]]:
    toxic, clean = sum((F.col(f"n{2 * h + 1}") for h in folds), F.lit(0)), sum((F.col(f"n{2 * h}") for h in folds), F.lit(0))
    n_toxic, n_clean = sum(sizes[2 * h + 1] for h in folds), sum(sizes[2 * h] for h in folds)
    odds = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    strength = odds - 1.96 * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    found = counts.filter(toxic >= MIN_DOCS).withColumn("strength", F.round(strength, 6)).filter(F.col("strength") >= MIN_STRENGTH)
    return SEED_ENTRIES + [(r["term"], r["kind"], r["strength"]) for r in found.orderBy(F.desc("strength"), "kind", "term").collect()]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Newton steps on the penalised likelihood; the first weight is the bias, which is not penalised."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge * len(x) / 100 + 1e-3)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[list[tuple[str, str, float]], list[float]]:
    """The lexicon and the model's weights from labelled documents."""
    picked = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = picked.select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FOLDS)).cast("int").alias("fold"), F.xxhash64("doc_id").alias("draw"))
    picked = picked.orderBy("draw", "doc_id").limit(max_train).drop("draw")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    sizes = dict.fromkeys(range(2 * FOLDS), 0) | {2 * r["fold"] + r["toxic"]: r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    n_toxic, n = sum(sizes[s] for s in range(1, 2 * FOLDS, 2)), sum(sizes.values())
    share = float(np.log((n_toxic + 0.5) / (n - n_toxic + 0.5)))
    if not 0 < n_toxic < n:
        return SEED_ENTRIES, [share] + [0.0] * 6
    counts = term_counts(rows).persist()
    every = list(range(FOLDS))
    whole, other = strongest_terms(counts, sizes, every), {k: strongest_terms(counts, sizes, [f for f in every if f != k]) for k in every}
    counts.unpersist()

    def crossed(text: pd.Series, fold: pd.Series) -> pd.DataFrame:
        tries = {k: lexicon(e) for k, e in other.items()}
        return pd.DataFrame([tries[k].features(t) for t, k in zip(text, fold, strict=True)], columns=[c.split()[0] for c in FEATURES.split(", ")])

    got = rows.select("toxic", F.pandas_udf(crossed, FEATURES)("text", "fold").alias("f")).select("toxic", "f.*").toPandas()
    x, y = got.drop(columns="toxic").to_numpy(float), got["toxic"].to_numpy(float)
    return whole, fit_logistic(x, y).tolist()


def toxicity(docs: DataFrame, labels: DataFrame, train=None, threshold: float = THRESHOLD) -> DataFrame:
    """Add score and predicted to (doc_id, text); ``train`` is a condition on doc_id for the labels that may be used."""
    usable = labels if train is None else labels.filter(train)
    entries, weights = learn(docs, usable.select("doc_id", "toxic"))

    def score(text: pd.Series) -> pd.Series:
        found = lexicon(entries)
        x = np.array([found.features(t) for t in text]).reshape(len(text), 6)
        return pd.Series(1 / (1 + np.exp(-np.clip(weights[0] + x @ np.array(weights[1:]), -30, 30))))

    out = docs.withColumn("score", F.pandas_udf(score, "double")("text"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(crc32_of(F.col("doc_id")), F.lit(4)) == 2
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")
