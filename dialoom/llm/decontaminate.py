"""Benchmark decontamination: a BM25 index of test items, queried with every passage by block-max WAND.

Items are the indexed side, passages (overlapping word windows of every document) the queries. Weights are
BM25 impacts divided by the item's own full score, so a score is the share of an item's BM25 mass that a
passage holds and one threshold serves all items; every item at or over it is retrieved (no top-k). A hit is
verified on the words: shares of the question's and of the answer's word n-grams that the passage holds.

A window is twice as long as the longest item of the block (``MIN_WINDOW`` at least) with a stride of half
of it, so an item's text always lies in one window. Before WAND walks the lists of a window, all windows of a
document are bounded at once: the long lists together hold too little of any item to reach the threshold, so
an item's mass in the short lists plus all of its mass in the long ones is an upper bound of its score.

The index is built of items in hash blocks of about ``BLOCK_CHARS`` characters; documents meet one block
after another, so neither the driver nor a task holds more than a block of items, and documents are
never shuffled. Document frequencies cover all items.

Defined results: null or wordless documents and items match nothing; a repeated item or document id gives
one row per pair with the best score; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import lean, table

K1, B = 1.2, 0.75
THRESHOLD = 0.6
MIN_QUESTION, MIN_ANSWER = 0.6, 0.6
GRAM = 5
MIN_WINDOW = 96
POSTING_BLOCK = 64
BLOCK_CHARS = 4_000_000
WORDS = re.compile(r"\w+")
HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The answer is what follows the last line end or else the last sentence end; without one, the last quarter of the words."""
    body = text.strip()
    for cut in (body.rfind("\n"), max(body[:-1].rfind(c) for c in ".?!:")):
        question, answer = words_of(body[: cut + 1]), words_of(body[cut + 1 :])
        if cut > 0 and question and answer:
            return question, answer
    words = words_of(body)
    keep = max(1, len(words) - max(1, len(words) // 4)) if len(words) > 1 else len(words)
    return words[:keep], words[keep:]


class BlockMaxIndex:
    """Postings with normalised BM25 impacts and their maxima by list and by block of postings."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_words: float, threshold: float = THRESHOLD):
        self.threshold = threshold - 1e-9
        self.item_ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        postings: dict[str, list[tuple[int, float]]] = {}
        longest = 0
        for k, (_, text) in enumerate(items):
            words = words_of(text)
            longest = max(longest, len(words))
            norm = K1 * (1 - B + B * len(words) / max(mean_words, 1e-9))
            weights = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1) / (tf + norm) for w, tf in Counter(words).items()}
            full = sum(weights.values())
            for w, x in weights.items():
                postings.setdefault(w, []).append((k, x / full))
        self.vocabulary = {w: t for t, w in enumerate(postings)}
        self.lists = [([k for k, _ in p], [x for _, x in p]) for p in postings.values()]
        self.most = np.array([max(x) for _, x in self.lists], dtype=np.float64)
        self.block_most = [[max(x[lo : lo + POSTING_BLOCK]) for lo in range(0, len(x), POSTING_BLOCK)] for _, x in self.lists]
        self.window = 2 * max(MIN_WINDOW // 2, longest)
        self._split_lists()

    def _split_lists(self) -> None:
        """Split the lists at a length so that the long ones alone hold at most 3/4 of the threshold for every item."""
        lengths = np.array([len(k) for k, _ in self.lists])
        for cut in sorted(set(lengths.tolist())):
            held = np.zeros(len(self.item_ids))
            for t in np.flatnonzero(lengths > cut).tolist():
                held[self.lists[t][0]] += self.lists[t][1]
            if held.max(initial=0) <= 0.75 * self.threshold:
                break
        short = lengths <= cut
        self.short_count = np.where(short, lengths, 0)
        self.short_first = np.concatenate([[0], np.cumsum(self.short_count)[:-1]])
        self.short_items = np.array([k for t in np.flatnonzero(short).tolist() for k in self.lists[t][0]], dtype=np.int64)
        self.short_weights = np.array([x for t in np.flatnonzero(short).tolist() for x in self.lists[t][1]], dtype=np.float64)
        self.long_mass = held

    def promising(self, window: np.ndarray, term: np.ndarray) -> list[int]:
        """Windows in which some item's short lists, with all of its long ones, could reach the threshold."""
        count = self.short_count[term]
        total = int(count.sum())
        step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        posting = np.repeat(self.short_first[term], count) + step
        n = len(self.item_ids)
        pair, where = np.unique(np.repeat(window, count) * n + self.short_items[posting], return_inverse=True)
        mass = np.bincount(where, weights=self.short_weights[posting], minlength=len(pair))
        return np.unique(pair[mass + self.long_mass[pair % n] >= self.threshold] // n).tolist()

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items whose score for these distinct terms reaches the threshold."""
        at = [[self.lists[t][0][0], t, 0] for t in terms]  # item under the cursor, term, cursor
        found = []
        while at:
            at.sort()
            total, pivot = 0.0, -1
            for p, (_, t, _) in enumerate(at):
                total += self.most[t]
                if total >= self.threshold:
                    pivot = p
                    break
            if pivot < 0:
                return found
            item = at[pivot][0]
            while pivot + 1 < len(at) and at[pivot + 1][0] == item:
                pivot += 1
            bound, upto = 0.0, None  # maxima of the blocks that would hold the item, and where the first of them ends
            for _, t, c in at[: pivot + 1]:
                ids = self.lists[t][0]
                b = c // POSTING_BLOCK
                while b < len(self.block_most[t]) and ids[min((b + 1) * POSTING_BLOCK, len(ids)) - 1] < item:
                    b += 1
                if b < len(self.block_most[t]):
                    bound += self.block_most[t][b]
                    last = ids[min((b + 1) * POSTING_BLOCK, len(ids)) - 1]
                    upto = last if upto is None else min(upto, last)
            if bound < self.threshold:
                target = (item if upto is None else upto) + 1
                if pivot + 1 < len(at):
                    target = min(target, at[pivot + 1][0])
                target = max(target, item + 1)
            elif at[0][0] == item:
                score = sum(self.lists[t][1][c] for _, t, c in at[: pivot + 1])
                if score >= self.threshold:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            for cursor in at[: pivot + 1]:
                ids, c = self.lists[cursor[1]][0], cursor[2]
                while c < len(ids) and ids[c] < target:
                    c += 1
                cursor[0], cursor[2] = (ids[c] if c < len(ids) else -1), c
            at = [cursor for cursor in at if cursor[0] >= 0]
        return found

    def matches(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """Verified items of a document by position, with score and overlaps of the best window."""
        words = words_of(text)
        find = self.vocabulary.get
        ids = np.fromiter((find(w, -1) for w in words), dtype=np.int64, count=len(words))
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return {}
        stride = self.window // 2
        last = max(0, (len(words) - 1) // stride - (len(words) > stride))
        half, width = known // stride, len(self.vocabulary)
        keys = np.concatenate([np.minimum(half, last) * width + ids[known], np.clip(half - 1, 0, last) * width + ids[known]])
        keys = np.unique(keys)
        window, term = keys // width, keys % width
        best: dict[int, tuple[float, float, float]] = {}
        for w in self.promising(window, term):
            lo, hi = np.searchsorted(window, [w, w + 1])
            hits = self.search(term[lo:hi].tolist())
            if not hits:
                continue
            passage = words[w * stride : w * stride + self.window]
            for item, score in hits:
                question, answer = self.parts[item]
                q, a = overlap(question, passage), overlap(answer, passage) if answer else 1.0
                if q >= MIN_QUESTION and a >= MIN_ANSWER and score > best.get(item, (0.0,))[0]:
                    best[item] = (score, q, a)
        return best


def overlap(part: list[str], passage: list[str]) -> float:
    wanted = grams(part, GRAM)
    n = min(GRAM, len(part))
    return len(wanted & {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}) / len(wanted) if wanted else 0.0


def index_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> Iterator[BlockMaxIndex]:
    """Indexes of hash blocks of the items; document frequencies come from all items, restricted to a block's words."""
    items = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("item_id is not null and text is not null").distinct()

    def terms(incoming):
        for batch in incoming:
            pairs = [(len(words), w) for words in map(words_of, batch.column(0).to_pylist()) for w in [*sorted(set(words)), None] if words]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in pairs], pa.int64()), pa.array([w for _, w in pairs], pa.string())], names=["n_words", "term"])

    exploded = items.select("text").mapInArrow(terms, "n_words long, term string")
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    whole = exploded.filter("term is null").agg(F.count(F.lit(1)), F.avg("n_words")).first()
    blocks = max(1, math.ceil(chars / block_chars))
    for k in range(blocks):
        rows = [(r[0], r[1]) for r in items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id", "text").collect() if words_of(r[1])]
        if not rows:
            continue
        wanted = exploded.filter("term is not null").groupBy("term").count()
        if blocks > 1:
            own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).select("text").mapInArrow(terms, "n_words long, term string").select("term").distinct()
            wanted = wanted.join(own, "term", "left_semi")
        yield BlockMaxIndex(rows, {r["term"]: r["count"] for r in wanted.collect()}, whole[0], whole[1], threshold)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and item whose text it holds."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for index in index_blocks(items, threshold=threshold):

        def search(incoming, index=index):
            for batch in incoming:
                out = [(d.as_py(), index.item_ids[k], *x) for d, t in zip(batch.column(0), batch.column(1), strict=True) for k, x in index.matches(t.as_py()).items()]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.float64()] * 3, strict=True)], names=[x.split()[0] for x in HITS.split(", ")])

        hits = rows.mapInArrow(lean(search), HITS)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], HITS)
    return found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
