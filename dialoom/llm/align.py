"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked id pairs in dense vectors under a minimal perfect hash.

Both tokenizers spell the same bytes (a space and the text), so tokens are laid over byte offsets: places where a token of each ends cut
them into groups, and the two tokens that end there are a link.

1. Texts are encoded once, and ids are written to the shared folder. A text whose bytes either tokenizer does not give back has no tokens.
2. The distinct linked pairs are cut into segments by hash. A task builds a minimal perfect hash for each: levels of bits, a key owning the first
   bit that no other key of its level hits. The place of a pair is the number of set bits before its own, about 3 bits a pair.
3. Tasks count links into dense vectors indexed by that place, a vector for each segment, and the vectors are summed as a tree (those of a few tasks
   first, then the sums). The key kept at each place is compared with the pair, so a pair of no segment is an error instead of a false count.
4. A second pass lays the tokens over each other again and looks up the counts. It reads the segments as broadcasts of at most ``INDEX_BYTES``; if there are
   more, it goes over the ids once for each part of them, and the documents' sums are added up.

The highest count of each id of the second tokenizer is a vector as long as its vocabulary.

Defined results: null and empty texts have no tokens; repeated rows and ids are rows of their own, each counted; a null id stays null; an
empty table gives no rows; extra columns are ignored. Special tokens' strings inside a text are plain text for both.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import lean, save, table, trimmed
from dialoom.llm.tokens import _ENCODERS, Encoder, Pieces, batches, encoder

#: Distinct pairs of a segment, about.
SEGMENT = 1 << 15
#: Bits a key of the hash's levels, and bytes of an index that a task may hold.
GAMMA, INDEX_BYTES = 2, 128 << 20
BATCH_CHARS = 500_000
#: Text pieces that a worker keeps for its next task.
KEPT_PIECES = 200_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + np.uint64((seed * int(_MIX[0])) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Segments of a minimal perfect hash, one after the other: for every level of a segment a run of words of a bit array."""

    def __init__(self, segments: list[dict]):
        """Rows of ``build``: segment, levels (words of each level), words, keys."""
        self.segments = max((s["segment"] for s in segments), default=-1) + 1
        depth = max((len(s["levels"]) for s in segments), default=0)
        self.first, self.size = (np.zeros((depth, self.segments), dtype=np.int64) for _ in range(2))
        words, at = [], 0
        for s in segments:
            for level, n in enumerate(s["levels"]):
                self.first[level, s["segment"]], self.size[level, s["segment"]] = at, n
                at += n
            words.append(np.frombuffer(s["words"], "<u8"))
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        ones = np.cumsum(np.bitwise_count(self.words).astype(np.int64))
        self.before = np.concatenate([[0], ones])
        self.keys = np.concatenate([np.frombuffer(s["keys"], "<u8") for s in segments]) if segments else np.zeros(0, np.uint64)

    def placed(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The place of each key in its segment, -1 for one that the segment does not hold."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level in range(len(self.first)):
            own = segment[left]
            held = self.size[level, own] > 0
            left, own = left[held], own[held]
            if not len(left):
                break
            bit = (mixed(keys[left], level + 1) % (self.size[level, own] * 64).astype(np.uint64)).astype(np.int64)
            word, low = self.first[level, own] + (bit >> 6), (bit & 63).astype(np.uint64)
            found = (self.words[word] >> low) & np.uint64(1) == 1
            word, low = word[found], low[found]
            out[left[found]] = self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << low) - np.uint64(1)))
            left = left[~found]
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)


def build(keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """(words of each level, all words, keys by place) of distinct keys."""
    levels, words, order, left, level = [], [], [], keys, 1
    while len(left):
        n = -(-len(left) * GAMMA // 64)
        bit = (mixed(left, level) % np.uint64(n * 64)).astype(np.int64)
        hits = np.bincount(bit, minlength=n * 64)
        alone = hits[bit] == 1
        held = np.zeros(n * 64, dtype=np.uint8)
        held[bit[alone]] = 1
        words.append(np.packbits(held, bitorder="little").tobytes())
        levels.append(n)
        order.append(left[alone][np.argsort(bit[alone])])
        left, level = left[~alone], level + 1
    return levels, b"".join(words), np.concatenate(order) if order else keys


class PieceEncoder(Encoder):
    """The piece tokenizer with the same cache of text pieces: no piece of its vocabulary holds a space behind another character, so texts may be cut before such a space."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self.library.get_piece_size()
        if any("\u2581" in self.library.id_to_piece(i).lstrip("\u2581") for i in range(n)):
            raise ValueError("pieces of this model may cross a space")
        self.dtype = "<u2" if n <= 1 << 16 else "<u4"
        self.specials, self.pieces = [], Pieces(self.dtype)

    def starts(self, raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(raw), dtype=bool)
        cut[1:] = (raw[1:] == 32) & (raw[:-1] != 32)
        cut[texts] = True
        return np.flatnonzero(cut)

    def plain(self, texts: list[str]) -> list[bytes]:
        """Texts with the space before them that the library adds, but for an empty text."""
        alone = [self.library.piece_to_id("\u2581")]
        return [np.array(x or alone, dtype=self.dtype).tobytes() for x in self.library.encode([t[1:] for t in texts], num_threads=1)]

    encode_pieces = plain


class Spelling(NamedTuple):
    """The bytes of each id: all in a row, where an id's begin, and how many they are."""

    raw: np.ndarray
    first: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Spelling:
        size = np.array([len(t) for t in tokens])
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.raw[np.repeat(self.first[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


@functools.cache
def spellings(byte_vocabulary: str | None = None, piece_model: str | None = None) -> tuple[Spelling, Spelling]:
    """What the ids of both vocabularies stand for."""
    letters, tokenizer, pieces = byte_letters(), encoder(byte_vocabulary, True).tokenizer, piece_encoder(piece_model).library
    spelled = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in spelled]
    b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in ((i, pieces.id_to_piece(i)) for i in range(pieces.get_piece_size()))]
    return Spelling.of(a), Spelling.of(b)


_LOADED: dict[str, PieceEncoder] = {}


def piece_encoder(model: str | None = None) -> PieceEncoder:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    if model not in _LOADED:
        _LOADED[model] = PieceEncoder(model)
    return _LOADED[model]


def byte_letters() -> dict[str, int]:
    """The byte of each letter of byte-level vocabularies: visible Latin-1 characters are themselves, the other bytes follow from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def encoded(docs: DataFrame, byte_vocabulary: str | None = None, piece_model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, a_ids and b_ids (little-endian 32-bit ids; empty without tokens)."""

    def encode(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, spelled = (encoder(byte_vocabulary, True), piece_encoder(piece_model)), spellings(byte_vocabulary, piece_model)
        rows = (r for batch in incoming for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for group in batches(rows, lambda r: len(r[2] or "") + 100, BATCH_CHARS):
            texts = [" " + r[2] if r[2] else "" for r in group]
            whole = "".join(texts).encode()
            sides = [coder.encode(texts) for coder in coders]
            if any(not np.array_equal(by.spelled(np.frombuffer(b"".join(ids), coder.dtype)), np.frombuffer(whole, np.uint8)) for by, coder, ids in zip(spelled, coders, sides, strict=True)):
                for k, t in enumerate(texts):
                    if any(by.spelled(np.frombuffer(ids[k], coder.dtype)).tobytes() != t.encode() for by, coder, ids in zip(spelled, coders, sides, strict=True)):
                        sides[0][k] = sides[1][k] = b""
            wide = [pa.array([np.frombuffer(x, coder.dtype).astype("<u4").tobytes() for x in ids], pa.binary()) for coder, ids in zip(coders, sides, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in group], pa.int64()) for k in (0, 1)] + wide, names=["doc_id", "row", "a_ids", "b_ids"])
        for coder in coders:  # later tasks of the worker need its memory
            if len(coder.pieces.keys) > KEPT_PIECES:
                coder.pieces = Pieces(coder.dtype)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(lean(encode), "doc_id long, row long, a_ids binary, b_ids binary")


class Aligned:
    """Documents' tokens laid over each other: for every common end the places of both tokens, and its document."""

    def __init__(self, spelled: tuple[Spelling, Spelling], a_ids: list[bytes], b_ids: list[bytes]):
        self.ids = [np.frombuffer(b"".join(x), "<u4") for x in (a_ids, b_ids)]
        self.sizes = [np.array([len(x) // 4 for x in ids]) for ids in (a_ids, b_ids)]
        ends = [np.cumsum(by.size[ids]) for by, ids in zip(spelled, self.ids, strict=True)]
        place = np.full(int(ends[0][-1]) + 1 if len(ends[0]) else 1, -1, dtype=np.int32)
        place[ends[0]] = np.arange(len(ends[0]), dtype=np.int32)
        at = place[ends[1]]
        self.b = np.flatnonzero(at >= 0)
        self.a = at[self.b]
        self.doc = np.repeat(np.arange(len(a_ids)), self.sizes[0])[self.a]
        self.keys = self.ids[0][self.a].astype(np.uint64) << np.uint64(32) | self.ids[1][self.b].astype(np.uint64)

    def digests(self, numbers: list[str]) -> list[str]:
        """sha256 of the groups of each document, '' for one without tokens; ``numbers`` are decimals with each of the three signs behind them."""
        order, signs = [], []
        for mine, other in ((self.a, self.b), (self.b, self.a)):
            n = int(mine[-1]) + 1 if len(mine) else 0
            last = np.zeros(n, dtype=np.int64)
            last[mine] = 1
            group = np.cumsum(last) - last
            # behind the other side's tokens of earlier groups, and of its own group for the second side
            before = np.concatenate([[0], other.astype(np.int64) + 1])[group + (mine is self.b)]
            order.append(np.arange(n) + before)
            signs.append(np.where(last == 1, 1 if mine is self.a else 2, 0))
        total = len(order[0]) + len(order[1])
        index = np.zeros(total, dtype=np.int64)
        for place, sign, ids in zip(order, signs, self.ids, strict=True):
            index[place] = ids[: len(place)].astype(np.int64) * 3 + sign
        words, out, lo = index.tolist(), [], 0
        for n in (self.sizes[0] + self.sizes[1]).tolist():
            out.append(hashlib.sha256("".join(map(numbers.__getitem__, words[lo : lo + n]))[:-1].encode()).hexdigest() if n else "")
            lo += n
        return out


def release() -> None:
    """Let go of the tokenizers of this worker process, their pieces and powers: passes over ids do not need them, and later tasks that do load them again."""
    _LOADED.clear()
    _ENCODERS.clear()
    Encoder.powers[:] = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * 2
    trimmed()


def laid(incoming: Iterator[pa.RecordBatch], spelled: tuple[Spelling, Spelling]) -> Iterator[tuple[list, Aligned]]:
    release()
    rows = (r for batch in incoming for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for group in batches(rows, lambda r: len(r[2]) + 100, 2 * BATCH_CHARS):
        yield group, Aligned(spelled, [r[2] for r in group], [r[3] for r in group])


def pair_index(ids: DataFrame, spelled: tuple[Spelling, Spelling]) -> tuple[DataFrame, int]:
    """Segments of the perfect hash over all distinct linked pairs (segment, levels, words, keys), and their number."""

    def distinct(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, aligned in laid(incoming, spelled):
            held.append(np.unique(aligned.keys))
            size += len(held[-1])
            if size > 1 << 20:
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
                if size > 1 << 19:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0].astype(np.int64))], names=["pair"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)).astype(np.int64))], names=["pair"])

    pairs = save(ids.mapInArrow(lean(distinct), "pair long").distinct(), "pairs")
    n = max(1, -(-pairs.count() // SEGMENT))

    def place(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            keys = batch.column(0).to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((mixed(keys, 0) % np.uint64(n)).astype(np.int32)), batch.column(0)], names=["segment", "pair"])

    def hashed(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(number: int, parts: list[np.ndarray]) -> pa.RecordBatch:
            levels, words, keys = build(np.concatenate(parts))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([levels], pa.list_(pa.int32())), pa.array([words], pa.binary()), pa.array([keys.astype("<u8").tobytes()], pa.binary())], names=["segment", "levels", "words", "keys"])

        number, parts = None, []
        for batch in incoming:
            segment, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint64)
            at = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(segment) else np.zeros(0, int)
            for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(segment)], strict=True):
                if parts and segment[lo] != number:
                    yield out(number, parts)
                    parts = []
                number = int(segment[lo])
                parts.append(keys[lo:hi])
        if parts:
            yield out(number, parts)

    dealt = pairs.mapInArrow(place, "segment int, pair long").repartition("segment").sortWithinPartitions("segment", "pair")
    return save(dealt.mapInArrow(lean(hashed), "segment int, levels array<int>, words binary, keys binary"), "segments"), n


def parts_of(index: DataFrame) -> Iterator[tuple[int, int]]:
    """Ranges of segments whose index stays below ``INDEX_BYTES``; one row a segment of sizes goes to the driver."""
    lo = total = 0
    hi = -1
    for r in index.select("segment", (F.octet_length("words") + 2 * F.octet_length("keys")).alias("n")).orderBy("segment").toLocalIterator():
        if total and total + r["n"] > INDEX_BYTES:
            yield lo, hi
            lo, total = hi + 1, 0
        hi, total = r["segment"], total + r["n"]
    if hi >= lo:
        yield lo, hi


class Lookup:
    """Some consecutive segments of the index as a task reads them, numbered from the first."""

    def __init__(self, rows: list[dict], lo: int, n_segments: int):
        self.lo, self.n_segments = lo, n_segments
        rows = sorted(({**r, "segment": r["segment"] - lo} for r in rows), key=lambda r: r["segment"])
        self.hash, self.numbers = PerfectHash(rows), [r["segment"] for r in rows]
        self.starts = np.cumsum([0] + [len(r["keys"]) // 8 for r in rows])
        self.counts = np.concatenate([np.frombuffer(r["counts"], "<i8") for r in rows]) if rows and "counts" in rows[0] else None

    def places(self, keys: np.ndarray) -> np.ndarray:
        segment = (mixed(keys, 0) % np.uint64(self.n_segments)).astype(np.int64) - self.lo
        mine = np.flatnonzero((segment >= 0) & (segment < self.hash.segments))
        out = np.full(len(keys), -1)
        found = self.hash.placed(keys[mine], segment[mine])
        if (found < 0).any():
            raise ValueError("a pair is missing in the index")
        out[mine] = found
        return out


def counted(ids: DataFrame, index: DataFrame, n_segments: int, spelled: tuple[Spelling, Spelling]) -> DataFrame:
    """The index with ``counts``, a dense vector for each segment, summed as a tree."""
    spark, vectors = ids.sparkSession, None
    leaves = max(2, isqrt(ids.rdd.getNumPartitions()))
    for lo, hi in parts_of(index):
        sent = spark.sparkContext.broadcast([r.asDict() for r in index.filter(F.col("segment").between(lo, hi)).collect()])

        def count(incoming: Iterator[pa.RecordBatch], sent=sent, lo=lo) -> Iterator[pa.RecordBatch]:
            look = Lookup(sent.value, lo, n_segments)
            total = np.zeros(look.starts[-1], dtype=np.int64)
            for _, aligned in laid(incoming, spelled):
                at = look.places(aligned.keys)
                total += np.bincount(at[at >= 0], minlength=len(total))
            leaf = TaskContext.get().partitionId() % leaves
            for k, number in enumerate(look.numbers):
                own = total[look.starts[k] : look.starts[k + 1]]
                if own.any():
                    yield vector(number + lo, leaf, own)

        found = save(ids.mapInArrow(lean(count), VECTOR), "vectors")
        vectors = found if vectors is None else vectors.unionByName(found)
    if vectors is None:
        return index.withColumn("counts", F.lit(b""))
    twigs = vectors.repartition("segment", "leaf").sortWithinPartitions("segment", "leaf").mapInArrow(lean(lambda incoming: summed(incoming, 2)), VECTOR)
    sums = twigs.repartition("segment").sortWithinPartitions("segment").mapInArrow(lean(lambda incoming: summed(incoming, 1)), VECTOR)
    return save(index.join(sums.select("segment", "counts"), "segment"), "counts")


VECTOR = "segment int, leaf int, counts binary"


def vector(segment: int, leaf: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([leaf], pa.int32()), pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["segment", "leaf", "counts"])


def summed(incoming: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """The sum of the vectors of each (segment, leaf) or segment, one vector held at a time."""
    key, total, row = None, None, None
    for batch in incoming:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r[:n_keys] != key:
                if total is not None:
                    yield vector(*row, total)
                key, row, total = r[:n_keys], r[:2], np.zeros(len(r[2]) // 8, dtype=np.int64)
            total += np.frombuffer(r[2], "<i8")
    if total is not None:
        yield vector(*row, total)


def pair_counts(index: DataFrame) -> DataFrame:
    """a_id, b_id and count of every linked pair."""

    def spell(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(keys, "<u8")
                yield pa.RecordBatch.from_arrays([pa.array((keys >> np.uint64(32)).astype(np.int32)), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int32)), pa.array(np.frombuffer(counts, "<i8"))], names=["a_id", "b_id", "count"])

    return index.select("keys", "counts").mapInArrow(spell, "a_id int, b_id int, count long")


ALIGNED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, byte_vocabulary: str | None = None, piece_model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """One row for each document (``ALIGNED`` without ``row``), and the counts of all pairs."""
    spark = docs.sparkSession
    ids = save(encoded(docs, byte_vocabulary, piece_model, id_col, text_col), "ids")
    spelled = spellings(byte_vocabulary, piece_model)
    bare, n_segments = pair_index(ids, spelled)
    index = counted(ids, bare, n_segments, spelled)
    highest = np.zeros(1, dtype=np.int64)
    for r in pair_counts(index).groupBy("b_id").agg(F.max("count").alias("most")).collect():  # one row for each id of a vocabulary
        if r["b_id"] >= len(highest):
            highest = np.concatenate([highest, np.zeros(r["b_id"] + 1, dtype=np.int64)])
        highest[r["b_id"]] = r["most"]
    best, out = spark.sparkContext.broadcast(highest), None
    for lo, hi in parts_of(index):
        sent = spark.sparkContext.broadcast([r.asDict() for r in index.filter(F.col("segment").between(lo, hi)).collect()])

        def look_up(incoming: Iterator[pa.RecordBatch], sent=sent, lo=lo) -> Iterator[pa.RecordBatch]:
            look, numbers = Lookup(sent.value, lo, n_segments), [f"{k}{sign}" for k in range(max(len(x.size) for x in spelled)) for sign in ",|;"]
            for group, aligned in laid(incoming, spelled):
                at = look.places(aligned.keys)
                mine = at >= 0
                counts, doc = look.counts[at[mine]], aligned.doc[mine]
                tops = counts == best.value[aligned.ids[1][aligned.b[mine]]]
                per = [np.bincount(d, minlength=len(group)) for d in (aligned.doc, doc[tops])]
                total = np.zeros(len(group), dtype=np.int64)
                np.add.at(total, doc, counts)
                columns = [*aligned.sizes, per[0], per[0], per[1], total]
                digests = aligned.digests(numbers) if lo == 0 else [None] * len(group)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in group], pa.int64()) for k in (0, 1)] + [pa.array(c.astype(np.int64)) for c in columns] + [pa.array(digests, pa.string())], names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

        found = ids.mapInArrow(lean(look_up), ALIGNED)
        out = found if out is None else out.unionByName(found)
    if out is None:  # no document has tokens
        zero = F.lit(0).cast("long")
        out = ids.select("doc_id", "row", *[zero.alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], F.lit("").alias("groups_sha256"))
    elif bare.count() and lo > 0:  # several parts: the documents' sums are added up
        same = [F.first(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        out = out.groupBy("row").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.max("groups_sha256").alias("groups_sha256"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), pair_counts(index)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents").select("doc_id", "text"))[0]
