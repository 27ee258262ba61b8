"""LM scoring: a causal self-attention model in numpy on subword ids, beside a smoothed word unigram score.

Model. Ids of a public byte-level vocabulary are predicted as P(class | context) * P(id | class, previous id).
The class distribution is a softmax: the log probabilities of the classes after the previous id, plus what a causal
attention layer over the window adds. Both factors' tables come from discounted counts of all neighbouring ids of
all training texts. Texts are lower-cased words joined by one space and closed by an end id. The probability of a word is
three quarters that of its ids and one quarter its share of the training tokens (of common words; the rest of that quarter is not given out).
Where the ``ORDER`` words before it were followed twice or more by one word in training, that word gets up to ``TRUST`` of the
probability. This memory of the corpus grows with it: every context of every text is counted and looked up, dealt by hash in ``buckets`` of
some ``BUCKET`` words. A context is known by its bucket and 48 bits. Common contexts (a 5,000th of the training words or more) are looked up in the tasks;
of the others those that a bit array of the memory's contexts excludes are not sent, which loses none of the memory's own.
The score is the log10 probability of the whole word sequence.

Texts are encoded once; all other passes read the ids, many texts at a time as arrays (``Texts``). A word is known by its ids, which spell it: up to
``KEY_IDS`` of them make a key, longer words are kept whole.

Training. One pass over the training documents counts words and ids, one counts pairs of classes. The attention
weights are trained data-parallel: in each of ``ROUNDS`` rounds every partition cuts all windows and runs Adam from the same weights over that round's share of
the windows (by hash, so each window is trained on once), in groups of ``SHUFFLED`` windows that are put in random order, and Spark averages
the results by rows (index, value), so the driver gets one set of weights whatever the number of partitions and a task holds one group.

Scoring. Windows of ``WINDOW`` ids overlap by ``OVERLAP``; each id is scored once, in batches with a causal mask, and
every whole text is scored.

Base score. Words that make up at least one in ``HOT`` training tokens are at most ``HOT`` words; they are looked up inside
the tasks. The others are joined by shuffle, and none of them can be a hot key.

Defined results: null and empty texts are the end token alone; a null doc_id counts as training; repeated rows
are scored alike and count as often as they occur; with no training rows every count is 0 and classes are uniform;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import common
from dialoom.llm.common import crc32_of, discard, lean, save, table, trimmed
from dialoom.llm.tokens import _ENCODERS, batches, encoder

HOT = 1_000_000
VOCABULARY, END = 50_257, 50_256
OWN_IN, OWN_OUT, SHARED, SHARED_OUT = 2048, 48, 16, 8
N_IN, N_OUT = OWN_IN + 2 * SHARED, OWN_OUT + 2 * SHARED_OUT
ORDER, KEPT, TRUST = 4, 8, 0.9
BUCKET, LEAST_BUCKETS, BITS = 500_000, 256, 1 << 27
HELD_WORDS, HELD_DOCS = 2_000_000, 60_000  # of a task, before it gives them away
WORD_SHARE = 0.25
WINDOW, OVERLAP, DIM = 32, 8, 16
SHUFFLED = 16_384
ROUNDS, BATCH, LEARNING = 2, 64, 1e-2
DISCOUNT = 0.75
SLAB = 32
GROUP_CHARS, GROUP_IDS = 1_000_000, 400_000
KNOWN_WORDS = 1_000_000
CHUNK = 96  # windows scored at once: their arrays stay in a core's cache


def words_of(text: str | None) -> list[bytes]:
    """bytes.lower() changes A-Z only, bytes.split() knows the six white-space characters only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class WordIds:
    """Subword ids of words, each as after a space; the cache has the words as bytes."""

    def __init__(self, vocabulary: str | None):
        self.coder = encoder(vocabulary, True)
        self.known: dict[bytes, bytes] = {}

    def encode(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        return [np.frombuffer(x, self.coder.dtype).astype(np.int32) for x in self.spelled(docs)]

    def spelled(self, docs: list[list[bytes]]) -> list[bytes]:
        """The ids of each text as bytes."""
        words = list(chain.from_iterable(docs))
        found = list(map(self.known.get, words))
        missing = list({w for w, x in zip(words, found, strict=True) if x is None})
        if len(self.known) + len(missing) > KNOWN_WORDS:
            self.known.clear()
            missing = list(set(words))
        if missing:
            self.known.update(zip(missing, self.coder.after_space([w.decode("utf-8", "replace") for w in missing]), strict=True))
            found = list(map(self.known.__getitem__, words))
        each = iter(found)
        return [b"".join(islice(each, len(d))) for d in docs]

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """Number of ids of each word of encoded texts."""
        return np.fromiter(map(len, map(self.known.__getitem__, words)), np.int64, len(words)) // np.dtype(self.coder.dtype).itemsize


_WORD_IDS: dict[str | None, WordIds] = {}


def word_ids(vocabulary: str | None) -> WordIds:
    """One for each worker process."""
    if vocabulary not in _WORD_IDS:
        _WORD_IDS[vocabulary] = WordIds(vocabulary)
    return _WORD_IDS[vocabulary]


def over_ids(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for mapInArrow, lean, in a worker that lets go of the tokenizers and of the known words first."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _WORD_IDS.clear()
        _ENCODERS.clear()
        trimmed()
        yield from lean(function)(incoming)

    return run


def windows_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (n, WINDOW + 1) of begin, ids, end; and the places (n, WINDOW) of the targets that the window scores."""
    return Texts(np.append(ids, END), np.array([len(ids) + 1])).windows()


class Texts:
    """Encoded texts in a row, each closed by ``END``: ids, and the number of ids of each."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes, self.first = ids, sizes, np.cumsum(sizes) - sizes
        self.chain = np.append(END, ids).astype(np.int32)  # every text begins after an end id

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Those of all texts, as ``windows_of`` gives them for one."""
        stride = WINDOW - OVERLAP
        count = 1 + np.maximum(0, -(-(self.sizes - WINDOW) // stride))
        number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        last = np.repeat(self.sizes, count)[:, None]
        place = number[:, None] * stride + np.arange(WINDOW + 1)
        scored = place[:, :-1] < last
        scored[number > 0, :OVERLAP] = False
        np.minimum(place, last, out=place)
        place += np.repeat(self.first, count)[:, None]
        return self.chain[place], scored

    def split_into_words(self, opens: np.ndarray) -> None:
        """First id and number of ids of each word, and the number of words of each text, the end being one; ``opens`` tells ids that begin a word."""
        self.word_first = np.flatnonzero(opens[self.ids] | (self.ids == END))
        self.lengths = np.diff(np.append(self.word_first, len(self.ids)))
        self.text_first = np.searchsorted(self.word_first, self.first)
        self.n_words = np.diff(np.append(self.text_first, len(self.word_first)))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """A key of each word, and the places of the words that it does not hold: it has ``KEY_IDS`` ids, and ``NO_ID`` after a shorter word's last one."""
        key, last = np.zeros(len(self.word_first), np.uint64), len(self.ids) - 1
        for k in range(KEY_IDS):
            part = np.where(self.lengths > k, self.ids[np.minimum(self.word_first + k, last)], NO_ID)
            key |= part.astype(np.uint64) << np.uint64(16 * k)
        return key, np.flatnonzero(self.lengths > KEY_IDS)

    def spelled(self, words: np.ndarray) -> list[bytes]:
        raw = self.ids.astype("<u2").tobytes()
        return [raw[2 * lo : 2 * hi] for lo, hi in zip(self.word_first[words].tolist(), (self.word_first + self.lengths)[words].tolist(), strict=True)]

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        where, context, follows = contexts(self.ids, self.lengths, None)
        own = where - np.repeat(self.text_first, self.n_words)[where] >= ORDER
        return where[own], context[own].view(np.uint64), follows[own].astype(np.uint32)


KEY_IDS, NO_ID = 4, 0xFFFF
END_KEY = np.array([END, NO_ID, NO_ID, NO_ID], "<u2").tobytes()


def column_of(values: np.ndarray) -> pa.Array:
    """Rows of equal size as a binary column."""
    values = np.ascontiguousarray(values).reshape(len(values), -1)
    ends = np.arange(len(values) + 1, dtype=np.int32) * np.int32(values.shape[1] * values.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def flat_column(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column in a row, and the size of each."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], "u1")[ends[0] : ends[-1]].view(kind), np.diff(ends) // np.dtype(kind).itemsize


def texts_of(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    """Runs of some ``GROUP_IDS`` ids of a column of encoded texts: first row, row after the last, texts."""
    ids, sizes = flat_column(column, "<u2")
    ends = np.cumsum(sizes)
    cuts = np.flatnonzero(np.diff(ends // GROUP_IDS, append=-1)) + 1
    for lo, hi in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
        yield lo, hi, Texts(ids[ends[lo] - sizes[lo] : ends[hi - 1]].astype(np.int64), sizes[lo:hi])


def encoded(docs: DataFrame, vocabulary: str | None) -> DataFrame:
    """The table with its texts as ids (little-endian, two bytes each, closed by ``END``); a table that has them stays."""
    if "ids" in docs.columns:
        return docs
    others = [c for c in docs.columns if c != "text"]

    def encode(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = word_ids(vocabulary), np.array([END], "<u2").tobytes()
        for batch in incoming:
            texts, at = batch.column(len(others)).to_pylist(), 0
            for group in batches(iter(texts), lambda t: len(t or "") + 100, GROUP_CHARS):
                docs_words = [words_of(t) for t in group]
                out = [x + end for x in coder.spelled(docs_words)]
                raw = np.frombuffer(b"".join(out), "<u2")
                if int(np.count_nonzero(coder.coder.opens[raw])) != sum(map(len, docs_words)):
                    raise ValueError("the vocabulary does not mark every word")
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(at, len(group)) for k in range(len(others))), pa.array(out, pa.binary())], names=[*others, "ids"])
                at += len(group)

    kinds = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others), "ids binary"])
    return docs.select(*others, "text").mapInArrow(lean(encode), kinds)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def contexts(ids: np.ndarray, lengths: np.ndarray, part: int | None = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of a text (its ids and the number of ids of each word, the end being a word of one id): place of the word after
    ``ORDER`` others, hash of these, hash of the word. ``part`` is one of the ``KEPT`` that hashes make, None all of them."""
    n = len(lengths)
    if n <= ORDER:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    seq = np.append(ids, END)[: int(lengths.sum())].astype(np.uint64)
    place = np.arange(len(seq)) - np.repeat(first, lengths)
    word = _mixed(np.add.reduceat(_mixed(seq + np.uint64(1) + (place.astype(np.uint64) << np.uint64(32))), first))
    before = np.zeros(n - ORDER, dtype=np.uint64)
    for k in range(ORDER):
        before = _mixed(before + word[k : k + n - ORDER])
    kept = np.arange(n - ORDER) if part is None else np.flatnonzero(before % np.uint64(KEPT) == part)
    return kept + ORDER, before[kept].view(np.int64), word[kept + ORDER].view(np.int64)


class Classes:
    """Input classes of ids (the most frequent have their own, the others share mass-balanced ones, word beginnings apart)
    and output classes of input classes, made the same way; tables of probabilities from counts."""

    def __init__(self, counts: np.ndarray, opens: np.ndarray):
        smoothed = counts + 0.01
        self.into = split_by_mass(smoothed, opens, OWN_IN, END)
        mass = np.bincount(self.into, weights=smoothed, minlength=N_IN)
        begins = np.bincount(self.into, weights=smoothed * opens, minlength=N_IN) > mass / 2
        self.out = split_by_mass(mass, begins, OWN_OUT, int(self.into[END]), SHARED_OUT)
        self.prior = mass / mass.sum()
        self.inside = np.log(smoothed / np.maximum(mass[self.into], 1e-12)).astype(np.float32)

    def learn_pairs(self, pairs: np.ndarray) -> None:
        """``pairs`` (N_IN, N_IN): absolute discounting towards the class shares; split into output classes and what is left inside them."""
        total, kinds = pairs.sum(axis=1, keepdims=True), (pairs > 0).sum(axis=1, keepdims=True)
        p = (np.maximum(pairs - DISCOUNT, 0) + (DISCOUNT * kinds + 0.01) * self.prior) / (total + 0.01)
        p /= p.sum(axis=1, keepdims=True)
        by_class = np.zeros((N_IN, N_OUT))
        np.add.at(by_class.T, self.out, p.T)
        self.bigram = np.log(np.maximum(by_class, 1e-30)).astype(np.float32)
        self.within = (np.log(np.maximum(p, 1e-30)) - self.bigram[:, self.out]).astype(np.float32)

    def rest(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log P(id | output class, previous id)."""
        return self.within[self.into[before], self.into[ids]] + self.inside[ids]


def split_by_mass(mass: np.ndarray, kind: np.ndarray, own: int, first: int, shared: int = SHARED) -> np.ndarray:
    order = np.lexsort((np.arange(len(mass)), -mass))
    order = np.concatenate([[first], order[order != first]])
    out = np.zeros(len(mass), dtype=np.int32)
    out[order[:own]] = np.arange(min(own, len(mass)))
    for k, chosen in enumerate((kind, ~kind)):
        rest = order[own:][chosen[order[own:]]]
        share = np.cumsum(mass[rest]) / max(mass[rest].sum(), 1e-12)
        out[rest] = own + k * shared + np.minimum((share * shared).astype(int), shared - 1)
    return out


SHAPES = (("emb", (N_IN, DIM)), ("last", (N_IN, DIM)), ("pos", (WINDOW, DIM)), ("wq", (DIM, DIM)), ("wk", (DIM, DIM)), ("wv", (DIM, DIM)), ("out", (DIM, N_OUT)))
N_WEIGHTS = sum(math.prod(s) for _, s in SHAPES)
MASK = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES:
        out[name] = flat[at : at + math.prod(shape)].reshape(shape)
        at += math.prod(shape)
    return out


def first_weights() -> np.ndarray:
    rng = np.random.default_rng(5)
    return np.concatenate([(rng.standard_normal(math.prod(s)) * (0.02 if n == "out" else 0.1 if n in ("emb", "last", "pos") else 0.25)).astype(np.float32) for n, s in SHAPES])


class Attention:
    def __init__(self, flat: np.ndarray, bigram: np.ndarray):
        self.flat, self.w, self.bigram = flat, unpack(flat), bigram
        top = bigram.max(axis=1)
        #: Rows of log probabilities can be left out of the exponents; any others are added to the logits, less their maximum.
        self.shares = np.exp(bigram) if -10 <= top.min() and top.max() <= 10 and bigram.min() >= -80 else None
        self.ones = np.ones(max(N_OUT, WINDOW), dtype=flat.dtype)

    def projections(self) -> np.ndarray:
        return np.concatenate([self.w["wq"] * self.flat.dtype.type(DIM**-0.5), self.w["wk"], self.w["wv"]], axis=1)

    def hidden(self, into: np.ndarray) -> tuple[np.ndarray, ...]:
        """Inputs, scaled queries, keys and values, weights before the division by their sums, these sums, what attention says, and what leaves the layer."""
        w = self.w
        x = w["emb"].take(into, axis=0)
        x += w["pos"]
        x[:, 1:] += w["last"].take(into[:, :-1], axis=0)
        qkv = x.reshape(-1, DIM) @ self.projections()
        q, k, v = (qkv.reshape(*into.shape, 3 * DIM)[:, :, lo : lo + DIM] for lo in (0, DIM, 2 * DIM))
        weights = np.matmul(q, k.transpose(0, 2, 1))
        if weights.max(initial=0) > 30:
            np.minimum(weights, 30, out=weights)
        np.exp(weights, out=weights)
        weights *= MASK
        total = (weights.reshape(-1, WINDOW) @ self.ones[:WINDOW]).reshape(*into.shape, 1)
        said = np.matmul(weights, v)
        said /= total
        return x, q, k, v, weights, total, said, x + said

    def unscaled(self, logits: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the classes times a factor of each row, from what the layer adds (overwritten), and the log of what they were multiplied by."""
        if self.shares is not None and (not logits.size or -50 <= logits.min() and logits.max() <= 50):
            np.exp(logits, out=logits)
            logits *= self.shares.take(before, axis=0)
            return logits, np.zeros(1, dtype=logits.dtype)
        logits += self.bigram.take(before, axis=0)
        top = logits.max(axis=1, keepdims=True)
        logits -= top
        return np.exp(logits, out=logits), top.ravel()

    def log_probabilities(self, into: np.ndarray, out: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """Natural log P(class) of the scored targets, in order."""
        rows = np.flatnonzero(scored)
        logits = self.hidden(into)[-1].reshape(-1, DIM).take(rows, axis=0) @ self.w["out"]
        before, target = into.ravel().take(rows), out.ravel().take(rows)
        picked = logits[np.arange(len(rows)), target] + self.bigram[before, target]
        p, top = self.unscaled(logits, before)
        return picked - top - np.log(p @ self.ones[:N_OUT])

    def gradient(self, into: np.ndarray, out: np.ndarray, scored: np.ndarray) -> np.ndarray:
        w, kind = self.w, self.flat.dtype
        flat = np.empty_like(self.flat)
        g, rows = unpack(flat), np.flatnonzero(scored)
        x, q, k, v, weights, total, heard, h = self.hidden(into)
        said = h.reshape(-1, DIM).take(rows, axis=0)
        p, _ = self.unscaled(said @ w["out"], into.ravel().take(rows))
        p *= (1 / (p @ self.ones[:N_OUT] * kind.type(max(1, len(rows)))))[:, None]
        p[np.arange(len(rows)), out.ravel().take(rows)] -= kind.type(1 / max(1, len(rows)))
        np.matmul(said.T, p, out=g["out"])
        dh = np.zeros_like(h)
        dh.reshape(-1, DIM)[rows] = p @ w["out"].T
        each = dh / total
        ds = np.matmul(each, v.transpose(0, 2, 1))
        ds -= np.einsum("ijk,ijk->ij", each, heard)[:, :, None]
        ds *= weights
        d = np.empty((*into.shape, 3 * DIM), dtype=kind)
        np.matmul(ds, k, out=d[:, :, :DIM])
        np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, DIM : 2 * DIM])
        np.matmul(weights.transpose(0, 2, 1), each, out=d[:, :, 2 * DIM :])
        d, by = d.reshape(-1, 3 * DIM), self.projections()
        of = x.reshape(-1, DIM).T @ d
        g["wq"][:], g["wk"][:], g["wv"][:] = of[:, :DIM] * kind.type(DIM**-0.5), of[:, DIM : 2 * DIM], of[:, 2 * DIM :]
        dh += (d @ by.T).reshape(dh.shape)
        np.matmul(np.ones(len(dh), kind), dh.reshape(len(dh), -1), out=g["pos"].reshape(-1))
        index = into[:, :, None] * DIM + np.arange(DIM)
        g["emb"][:], g["last"][:] = 0, 0
        np.add.at(g["emb"].reshape(-1), index.reshape(-1), dh.reshape(-1))  # in one dimension, where it is fast
        np.add.at(g["last"].reshape(-1), index[:, :-1].reshape(-1), dh[:, 1:].reshape(-1))
        return flat


def train_shard(flat: np.ndarray, bigram: np.ndarray, groups: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], seed: int) -> tuple[np.ndarray, int]:
    """Weights after all groups of windows (into, out, scored), and the number of windows."""
    flat, rng = flat.copy(), np.random.default_rng(seed)
    m, v, step, seen = np.zeros_like(flat), np.zeros_like(flat), 0, 0
    model = Attention(flat, bigram)  # sees the weights change in place
    for into, out, scored in groups:
        seen += len(into)
        order = rng.permutation(len(into))
        for lo in range(0, len(order), BATCH):
            pick = order[lo : lo + BATCH]
            g = model.gradient(into[pick], out[pick], scored[pick])
            step += 1
            m *= np.float32(0.9)  # sums, of which the means are a tenth and a hundredth
            m += g
            g *= g
            v *= np.float32(0.99)
            v += g
            np.sqrt(v, out=g)
            scale = (1 - 0.99**step) ** -0.5
            g += np.float32(1e-7 / scale)
            np.divide(m, g, out=g)
            g *= np.float32(LEARNING / (1 - 0.9**step) / scale)
            flat -= g
    return flat, seen


WINDOW_BYTES = 2 * (WINDOW + 1) + WINDOW
COUNTED = "kind int, word binary, id int, n long, window binary"


def count_pass(docs: DataFrame, vocabulary: str | None, kinds: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """Rows of training documents (text or ids) of these kinds: words (0) and ids (1) with counts added up in the task, and windows (2)."""
    opens = encoder(vocabulary, True).opens

    def rows(kind: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
        columns["kind"] = pa.array(np.full(size, kind, np.int32))
        types = {"kind": pa.int32(), "word": pa.binary(), "id": pa.int32(), "n": pa.int64(), "window": pa.binary()}
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, t) for c, t in types.items()], names=list(types))

    def counted_words(held: list[np.ndarray], longer: Counter) -> Iterator[pa.RecordBatch]:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        yield rows(0, len(keys), word=column_of(keys), n=pa.array(n, pa.int64()))
        if longer:
            yield rows(0, len(longer), word=pa.array(list(longer), pa.binary()), n=pa.array(list(longer.values()), pa.int64()))

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n_held, longer = np.zeros(VOCABULARY, dtype=np.int64), [], 0, Counter()
        for batch in incoming:
            for _, _, texts in texts_of(batch.column(0)):
                if 2 in kinds:
                    windows, scored = texts.windows()
                    yield rows(2, len(windows), window=column_of(np.concatenate([windows.astype("<u2").view("u1"), scored.view("u1")], axis=1)))
                if 1 in kinds:
                    ids += np.bincount(texts.ids, minlength=VOCABULARY)
                if 0 in kinds:
                    texts.split_into_words(opens)
                    key, long = texts.words()
                    held.append(np.delete(key, long))
                    longer.update(texts.spelled(long))
                    n_held += len(key)
                    if n_held > HELD_WORDS:
                        yield from counted_words(held, longer)
                        held, n_held, longer = [], 0, Counter()
        if held:
            yield from counted_words(held, longer)
        some = np.flatnonzero(ids)
        if len(some):
            yield rows(1, len(some), id=pa.array(some, pa.int32()), n=pa.array(ids[some]))

    return encoded(docs, vocabulary).select("ids").mapInArrow(over_ids(count), COUNTED)


SUMS = ("<u4", "<i8")  # a pair's place in its slab, how often


def pair_table(docs: DataFrame, vocabulary: str | None, classes: Classes) -> np.ndarray:
    """Counts of pairs of input classes, added up in the task and then by slabs of ``SLAB`` classes; the driver gets at most N_IN * N_IN sums."""
    into = classes.into

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_IN * N_IN, dtype=np.int64)
        for batch in incoming:
            for _, _, texts in texts_of(batch.column(0)):
                kinds = into[texts.chain].astype(np.int64)
                np.add.at(total, kinds[:-1] * N_IN + kinds[1:], 1)
        for slab, part in enumerate(total.reshape(-1, SLAB * N_IN)):
            some = np.flatnonzero(part)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([packed(some.astype("<u4"), part[some].astype("<i8"))], pa.binary())], names=["slab", "sums"])

    def add(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, rows in by_bucket(incoming):
            total = np.zeros(SLAB * N_IN, dtype=np.int64)
            for _, raw in rows:
                place, n = split(raw, SUMS)
                total[place] += n
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([packed(some.astype("<u4"), total[some].astype("<i8"))], pa.binary())], names=["slab", "sums"])

    out = np.zeros((N_IN // SLAB, SLAB * N_IN))
    found = encoded(docs, vocabulary).select("ids").mapInArrow(over_ids(count), "slab int, sums binary").repartition("slab").sortWithinPartitions("slab")
    for r in found.mapInArrow(add, "slab int, sums binary").collect():
        place, n = split(r["sums"], SUMS)
        out[r["slab"], place] = n
    return out.reshape(N_IN, N_IN)


def regrouped(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Rows of arrays in arrays of ``SHUFFLED`` rows, the last one smaller."""
    held, n = [], 0
    for part in parts:
        held, n = [*held, part], n + len(part)
        if n >= SHUFFLED:
            joined = np.concatenate(held)
            yield from (joined[lo : lo + SHUFFLED] for lo in range(0, n - n % SHUFFLED, SHUFFLED))
            n %= SHUFFLED
            held = [joined[len(joined) - n :].copy()]
    if n:
        yield np.concatenate(held)


def train(windows: DataFrame, classes: Classes) -> np.ndarray:
    """Attention weights."""
    into_of, out_of, bigram = classes.into, classes.out, classes.bigram

    def load(incoming: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for rows in regrouped(flat_column(batch.column(0), "u1")[0].reshape(-1, WINDOW_BYTES) for batch in incoming):
            into = into_of[np.ascontiguousarray(rows[:, : 2 * (WINDOW + 1)]).view("<u2")]
            yield into[:, :-1], out_of[into[:, 1:]], rows[:, 2 * (WINDOW + 1) :].astype(bool)

    flat = first_weights()
    for turn in range(ROUNDS):

        def shard(incoming, flat=flat, turn=turn):
            new, seen = train_shard(flat, bigram, load(incoming), turn)
            if seen:
                n = float(seen)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_WEIGHTS), pa.int32()), pa.array(new * n, pa.float64()), pa.array([n] * N_WEIGHTS, pa.float64())], names=["i", "x", "n"])

        own = windows.filter(F.pmod(F.xxhash64("window"), F.lit(ROUNDS)) == turn)
        got = own.select("window").mapInArrow(over_ids(shard), "i int, x double, n double").groupBy("i").agg((F.sum("x") / F.sum("n")).alias("x")).collect()
        if not got:
            break
        flat = flat.copy()
        for r in got:
            flat[r["i"]] = r["x"]
    return flat


def packed(*columns: np.ndarray) -> bytes:
    return b"".join(c.tobytes() for c in columns)


def split(raw: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The columns that ``packed`` put into one value."""
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += out[-1].nbytes
    return out


LOW = np.uint64((1 << 48) - 1)
PAIRS = ("<u4", "<u2", "<u4", "<u4")  # a context's low 32 and next 16 bits, the word that follows, how often
KNOWN = ("<u4", "<u2", "<u4", "<f4")  # a context, its top word, and the probability it gets
PLACES = ("<u4", "<u2", "<u4", "<f4", "<u2")  # a context, the word that follows, its log10 probability, and its row from the first on


def dealt_by_bucket(context: np.ndarray, n_buckets: int, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed) of contexts' low bits and the columns beside them, in their order."""
    bucket = bucket_of(context, n_buckets)
    order = np.argsort(bucket.astype(np.uint16) if n_buckets <= 1 << 16 else bucket, kind="stable")
    bucket, context = bucket[order], context[order]
    columns = [(context & np.uint64(0xFFFFFFFF)).astype("<u4"), ((context >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2"), *[c[order] for c in columns]]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True):
        yield int(bucket[lo]), packed(*[c[lo:hi] for c in columns])


def bucket_of(context: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((context >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int32)


def joined_key(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


class Memory:
    """What scoring tasks know of the memory: the common contexts, and a bit for each of a run of places in every bucket."""

    def __init__(self, rows: list, n_buckets: int):
        self.n_buckets, self.width = n_buckets, bits_of(n_buckets)
        self.bits = np.zeros(n_buckets * self.width // 8, dtype=np.uint8)
        keys, tops, trusts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.float32)]
        for r in rows:
            lo = r["bucket"] * self.width // 8
            self.bits[lo : lo + self.width // 8] = np.frombuffer(r["bits"], np.uint8)
            low, high, top, trust = split(r["hubs"], KNOWN)
            keys.append(joined_key(low, high) * np.uint64(n_buckets) + np.uint64(r["bucket"])), tops.append(top), trusts.append(trust)
        keys, tops, trusts = (np.concatenate(x) for x in (keys, tops, trusts))
        order = np.argsort(keys)
        self.keys, self.tops, self.trusts = keys[order], tops[order], trusts[order]

    def look_up(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of contexts that the memory may hold, those of the common ones, and the common ones' numbers."""
        bucket, low = bucket_of(context, self.n_buckets), context & LOW
        place = bucket.astype(np.int64) * self.width + (low % np.uint64(self.width)).astype(np.int64)
        maybe = np.flatnonzero((self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
        if not len(self.keys):
            return maybe, maybe[:0], maybe[:0]
        key = low[maybe] * np.uint64(self.n_buckets) + bucket[maybe].astype(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hub = self.keys[at] == key
        return maybe[~hub], maybe[hub], at[hub]


def bits_of(n_buckets: int) -> int:
    return max(8, BITS // n_buckets // 8 * 8)


class HotWords:
    """log10(c + 1) of the common words, by key, and by their ids where the key does not hold the word."""

    def __init__(self, words: list[bytes], counts: list[int]):
        log = np.log10(np.array(counts, dtype=np.float64) + 1)
        short = np.array([len(w) == 2 * KEY_IDS for w in words], dtype=bool)
        keys = np.frombuffer(b"".join(w for w in words if len(w) == 2 * KEY_IDS), "<u8")
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], log[short][order]
        self.longer = {w: x for w, x, s in zip(words, log.tolist(), short.tolist(), strict=True) if not s}

    def look_up(self, key: np.ndarray, long: np.ndarray, texts: Texts) -> np.ndarray:
        """-1 where a word is not among them."""
        each, of = np.unique(key, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, each), max(len(self.keys) - 1, 0))
        out = (np.where(self.keys[at] == each, self.logs[at], -1.0) if len(self.keys) else np.full(len(each), -1.0))[of]
        out[long] = [self.longer.get(w, -1.0) for w in texts.spelled(long)]
        return out


def mixture(log_p: np.ndarray, trust: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """What the memory adds to log10 probabilities of words after contexts that it holds."""
    log_p, trust = log_p.astype(np.float64), trust.astype(np.float64)
    return np.where(hit, np.log10((1 - trust) * 10.0**log_p + trust) - log_p, np.log10(1 - trust))


SCORED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, log_c double, score double, word binary, n long, bucket int, places binary"


def score_pass(docs: DataFrame, vocabulary: str | None, hot: Broadcast, n_train: int, classes: Classes, flat: np.ndarray, memory: Broadcast) -> DataFrame:
    """A row for each document, with the share of the hot words in its base score; rows (rid, word, n) of its other words; and rows (rid, bucket,
    places) of words after contexts that the memory may hold, for documents from that rid on."""
    opens = encoder(vocabulary, True).opens
    kinds = {"rid": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "log_c": pa.float64(), "score": pa.float64(), "word": pa.binary(), "n": pa.int64(),
             "bucket": pa.int32(), "places": pa.binary()}

    def rows(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([(columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], t)) if c in columns else pa.nulls(size, t) for c, t in kinds.items()], names=list(kinds))

    def given(first: int, held: list[tuple[np.ndarray, ...]], n_buckets: int) -> pa.RecordBatch:
        context, follows, log_p, row = (np.concatenate([h[k] for h in held]) for k in range(4))
        out = list(dealt_by_bucket(context, n_buckets, [follows, log_p, row]))
        return rows(len(out), rid=[first] * len(out), bucket=[b for b, _ in out], places=[x for _, x in out])

    def score(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rid, known_contexts, known_words = Attention(flat, classes.bigram), TaskContext.get().partitionId() << 33, memory.value, hot.value
        share, held_places, n_held, first = math.log10(max(n_train, 1)), [], 0, rid
        for batch in incoming:
            for lo, hi, texts in texts_of(batch.column(2)):
                if held_places and (n_held > HELD_WORDS or rid + hi - lo - first > HELD_DOCS):
                    yield given(first, held_places, known_contexts.n_buckets)
                    held_places, n_held = [], 0
                if not held_places:
                    first = rid
                texts.split_into_words(opens)
                text = np.repeat(np.arange(hi - lo), texts.n_words)
                spelled = np.add.reduceat(target_logs(model, classes, texts.windows()), texts.word_first)
                key, long = texts.words()
                counts = known_words.look_up(key, long, texts)  # log10(c + 1), -1 if not hot
                known = counts >= 0
                common_log = np.where(known, np.log10(np.maximum(10.0**counts - 1, 1e-30)) - share, -np.inf)
                words_log = np.logaddexp((spelled + math.log10(1 - WORD_SHARE)) * LN10, (common_log + math.log10(WORD_SHARE)) * LN10) / LN10
                where, context, follows = texts.contexts()
                maybe, hub, number = known_contexts.look_up(context)
                gain = mixture(words_log[where[hub]], known_contexts.trusts[number], follows[hub] == known_contexts.tops[number])
                gain = np.bincount(text[where[hub]], weights=gain, minlength=hi - lo)
                if len(maybe):
                    held_places.append((context[maybe], follows[maybe], words_log[where[maybe]].astype("<f4"), (text[where[maybe]] + (rid - first)).astype("<u2")))
                    n_held += len(maybe)
                of_texts = lambda x, at=texts.text_first: np.add.reduceat(x, at)
                yield rows(hi - lo, rid=np.arange(rid, rid + hi - lo), doc_id=batch.column(0).slice(lo, hi - lo), held_out=batch.column(1).slice(lo, hi - lo), n_tokens=texts.n_words,
                           n_known=of_texts(known.astype(np.int64)), log_c=of_texts(np.where(known, counts, 0.0)), score=of_texts(words_log) + gain)
                cold = ~known
                cold[long] = False
                cold[texts.text_first + texts.n_words - 1] = False  # the end
                cold = np.flatnonzero(cold)
                if len(cold):
                    cold = cold[np.lexsort((key[cold], text[cold]))]
                    new = np.flatnonzero(np.append(True, (key[cold][1:] != key[cold][:-1]) | (text[cold][1:] != text[cold][:-1])))
                    yield rows(len(new), rid=rid + text[cold[new]], word=column_of(key[cold[new]]), n=np.diff(np.append(new, len(cold))))
                long = long[~known[long]]
                if len(long):
                    found = Counter(zip(text[long].tolist(), texts.spelled(long), strict=True))
                    yield rows(len(found), rid=[rid + t for t, _ in found], word=[w for _, w in found], n=list(found.values()))
                rid += hi - lo
        if held_places:
            yield given(first, held_places, known_contexts.n_buckets)

    return docs.select("doc_id", "held_out", "ids").mapInArrow(over_ids(score), SCORED)


LN10 = math.log(10)


def target_logs(model: Attention, classes: Classes, cut: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of every target of some documents in order, from their windows, many at a time."""
    windows, scored = cut
    out = []
    for lo in range(0, len(windows), CHUNK):
        w, s = windows[lo : lo + CHUNK], scored[lo : lo + CHUNK]
        target = w[:, 1:]
        into = classes.into[w]
        out.append(model.log_probabilities(into[:, :-1], classes.out[into[:, 1:]], s) + classes.rest(w[:, :-1][s], target[s]))
    return np.concatenate(out).astype(np.float64) / LN10


def by_bucket(incoming: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows of a stream that is sorted by its first column, bucket by bucket."""
    rows = (r for batch in incoming for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    return groupby(rows, key=lambda r: r[0])


def alike(context: np.ndarray, follows: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Of equal pairs: the place of one, how many there are, and the sum of their ``n``."""
    key = _mixed(context + _mixed(follows.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    return order[first], np.diff(np.append(first, len(key))), None if n is None else np.add.reduceat(n[order].astype(np.int64), first)


def context_memory(docs: DataFrame, vocabulary: str | None, n_train: int) -> tuple[DataFrame, int]:
    """Rows of buckets and the number of buckets. A bucket has its contexts that a word followed twice or more in the texts (``KNOWN``) with the word
    that most often did and the probability it gets, those of them that are common, and its run of bits."""
    n_buckets = min(1 << 24, max(LEAST_BUCKETS, n_train // BUCKET))
    opens, width, least = encoder(vocabulary, True).opens, bits_of(n_buckets), max(common.FEW_ROWS // 200, math.ceil(n_train / common.HUBS))

    def pairs(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added_up(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            context, follows = (np.concatenate([h[k] for h in held]) for k in range(2))
            one, n, _ = alike(context, follows)
            out = list(dealt_by_bucket(context[one], n_buckets, [follows[one], n.astype("<u4")]))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["bucket", "pairs"])

        held, size = [], 0
        for batch in incoming:
            for _, _, texts in texts_of(batch.column(0)):
                texts.split_into_words(opens)
                held.append(texts.contexts()[1:])
                size += len(held[-1][0])
                if size > HELD_WORDS:
                    yield added_up(held)
                    held, size = [], 0
        if size:
            yield added_up(held)

    def remember(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_bucket(incoming):
            low, high, follows, n = (np.concatenate(x) for x in zip(*(split(r[1], PAIRS) for r in rows), strict=True))
            context = joined_key(low, high)
            one, _, sums = alike(context, follows, n)
            c = sums
            every, one, times, c = context[one], one[c > 1], c, c[c > 1]
            order = np.lexsort((follows[one], c, context[one]))
            context, follows, c = context[one][order], follows[one][order], c[order]
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else np.zeros(0, int)
            last = np.append(first[1:], len(context)) - 1 if len(first) else first
            total = np.add.reduceat(c, first) if len(first) else c
            context, top, trust = context[first], follows[last], (TRUST * c[last] / total).astype("<f4")
            at = np.searchsorted(context, every)
            mine = np.flatnonzero(context[np.minimum(at, len(context) - 1)] == every) if len(context) else at[:0]
            rows_of = np.bincount(at[mine], weights=times[mine], minlength=len(context))  # also those that a word followed once
            flags = np.zeros(width, dtype=np.uint8)
            flags[(context % np.uint64(width)).astype(np.int64)] = 1
            columns = [(context & np.uint64(0xFFFFFFFF)).astype("<u4"), (context >> np.uint64(32)).astype("<u2"), top, trust]
            known = [packed(*[x[chosen] for x in columns]) for chosen in (rows_of < least, rows_of >= least)]
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *[pa.array([x], pa.binary()) for x in (*known, np.packbits(flags, bitorder="little").tobytes())]], names=["bucket", "known", "hubs", "bits"])

    found = encoded(docs, vocabulary).select("ids").mapInArrow(over_ids(pairs), "bucket int, pairs binary").repartition("bucket").sortWithinPartitions("bucket")
    return save(found.mapInArrow(lean(remember), "bucket int, known binary, hubs binary, bits binary"), "memory"), n_buckets


def remembered(places: DataFrame, memory: DataFrame) -> DataFrame:
    """(rid, gain): what the memory adds to the score of a document."""

    def look_up(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(incoming):
            key, top, trust = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.float32)
            for _, rid, raw in rows:  # the memory comes first
                if rid is None:
                    low, high, top, trust = split(raw, KNOWN)
                    key = joined_key(low, high)
                    continue
                low, high, follows, log_p, row = split(raw, PLACES)
                wanted = joined_key(low, high)
                at = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
                held = np.flatnonzero(key[at] == wanted) if len(key) else at[:0]
                at, row = at[held], row[held].astype(np.int64)
                gain = np.bincount(row, weights=mixture(log_p[held], trust[at], follows[held] == top[at])) if len(row) else np.zeros(0)
                row = np.unique(row)
                yield pa.RecordBatch.from_arrays([pa.array(rid + row, pa.int64()), pa.array(gain[row], pa.float64())], names=["rid", "gain"])

    both = memory.select("bucket", F.lit(None).cast("long").alias("rid"), F.col("known").alias("raw")).unionByName(places.select("bucket", "rid", F.col("places").alias("raw")))
    gains = both.repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("rid")).mapInArrow(lean(look_up), "rid long, gain double")
    return gains.groupBy("rid").agg(F.sum("gain").alias("gain"))


def lm_scores(docs: DataFrame, held_out: Column, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document; learns from rows not held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    docs = save(encoded(docs, vocabulary), "encoded")
    training = docs.filter(~F.col("held_out"))
    counted = save(count_pass(training, vocabulary, (0, 1)), "counted")
    words = save(counted.filter("kind = 0").groupBy("word").agg(F.sum("n").alias("c")), "words")
    size = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = size["n"], size["v"]
    is_hot = (F.col("c") * HOT >= n) | (F.col("word") == F.lit(END_KEY))
    hot_rows = words.filter(is_hot).toPandas()
    hot = docs.sparkSession.sparkContext.broadcast(HotWords([bytes(w) for w in hot_rows["word"]], hot_rows["c"].tolist()))
    ids = np.zeros(VOCABULARY)
    for r in counted.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).collect():
        ids[r["id"]] = r["n"]
    discard(counted)
    classes = Classes(ids, encoder(vocabulary, True).opens[:VOCABULARY])
    classes.learn_pairs(pair_table(training, vocabulary, classes))
    flat = train(count_pass(training, vocabulary, (2,)), classes)
    memory, n_buckets = context_memory(training, vocabulary, n)
    sent = docs.sparkSession.sparkContext.broadcast(Memory(memory.select("bucket", "hubs", "bits").collect(), n_buckets))
    scored = save(score_pass(docs, vocabulary, hot, n, classes, flat, sent), "scored")
    discard(docs)
    gains = save(remembered(scored.filter("places is not null"), memory), "gains")
    cold = scored.filter("word is not null").select("rid", "word", "n")
    rare = words.filter(~is_hot)
    found = cold.join(rare.hint("shuffle_hash"), "word").groupBy("rid").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("cold_log"), F.sum("n").alias("cold_known"))
    out = scored.filter("n_tokens is not null").drop("word", "n", "bucket", "places").join(found, "rid", "left").join(gains, "rid", "left")
    base = F.col("log_c") + F.coalesce("cold_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(n + v + 1))
    known = F.col("n_known") + F.coalesce("cold_known", F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), F.pmod(crc32_of(F.col("doc_id")), F.lit(7)) == 2)


BASE_SQL = r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS word FROM documents
  UNION ALL SELECT doc_id, chr(10) FROM documents),
t AS (SELECT word, count(*) AS c FROM w WHERE doc_id NOT IN (SELECT doc_id FROM held) GROUP BY word),
s AS (SELECT sum(c) AS n, count(*) AS v FROM t)
SELECT w.doc_id, count(*) AS n_tokens, count(t.c) AS n_known, any_value(s.n) AS train_tokens, sum(log10((coalesce(t.c, 0) + 1) / (s.n + s.v + 1))) AS base_score
FROM w LEFT JOIN t USING (word), s GROUP BY w.doc_id
"""
