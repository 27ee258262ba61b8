"""Removal of repeated byte strings across documents by distributed prefix doubling.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id. Positions are ranked by
longer and longer strings, two ranks at growing offsets making the next one; positions whose rank is unique drop out, and the end is
the threshold. The rank of a string is a fingerprint of the pair of ranks below it, so equal strings get equal ranks in every task:

1. Up to half the threshold the pairs are in one text, so tasks rank by themselves (1, 2, 4, 8 ... bytes).
2. At half the threshold Spark sorts (rank, position) pairs. One position stands for a run of neighbours: each window of ``length`` bytes
   is held by the smallest rank in it, and a run of windows with one holder is a block. Equal windows have equal holders, so a
   block whose holder's rank is found in one document only is unique and drops out. A block that is equal as a whole to a block of a
   smaller document goes as a whole. All others stay: their windows may be repeated.
3. For these the pair (rank at p, rank at p + half) makes the rank of the whole window, and Spark sorts (rank, position) pairs again.
   Windows whose rank also starts in a smaller document go.

Pairs travel as packed arrays, one row for each task and bucket of ranks. A task settles what it can: of equal blocks or windows
all but its own smallest document's go without travelling, so a passage of any number of documents sends a few pairs a task to its bucket. A
rank that many blocks of a task share (``CROWD``) is known to be no unique one, so its blocks are dealt by block instead, with a single witness for
the blocks of other tasks. A window is known by 96 bits of two independent fingerprints, a whole block by 112.

Defined results: null text is empty and has nothing to remove; a null id is smaller than all others; rows with the same id do not remove each
other's bytes, and each is judged by its own text; an empty table gives no rows; extra columns are ignored; texts are cut between bytes, so
``kept`` need not be valid UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import lean, save, table

LENGTH = 50
#: Bytes of text that are ranked at once; longer texts are ranked in parts that overlap by a window.
PART = 1 << 20
#: Pairs that a task holds before it settles and sends them.
HELD = 1_500_000
#: Bytes of text for each bucket of ranks.
BUCKET_BYTES = 32 << 20
#: Blocks with one rank in a task from which they are dealt by block.
CROWD = 16
LEAST = -(1 << 63)
REMOVED, OPEN = 0, 1
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LETTERS = np.random.default_rng(12).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_SHIFT = np.uint64(29)


def paired(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The rank of each pair of ranks."""
    x = (other ^ (other >> _SHIFT)) * _B
    x += one * _A
    x ^= x >> np.uint64(32)
    x *= _C
    return x


def doubled(ranks: np.ndarray, have: int, length: int) -> np.ndarray:
    """Ranks of ``length`` bytes at each place from those of ``have`` bytes; fewer places at the end."""
    while have < length:
        step = min(have, length - have)
        ranks = paired(ranks[: len(ranks) - step], ranks[step:]) if len(ranks) > step else ranks[:0]
        have += step
    return ranks


def lowest(ranks: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        ranks = np.minimum(ranks[: len(ranks) - step], ranks[step:])
        have += step
    return ranks


class Packed:
    """Parallel arrays of (rank, check, document, first, last), documents by place in a list of (id, mark)."""

    def __init__(self):
        self.ids: list[int] = []
        self.marks: list[int] = []
        self.seen: dict[tuple[int, int], int] = {}
        self.columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        self.n = 0

    def document(self, doc_id: int | None, mark: int) -> int | None:
        """Its place; None if it came before."""
        key = (LEAST if doc_id is None else doc_id, mark)
        if key in self.seen:
            return None
        self.seen[key] = len(self.ids)
        self.ids.append(key[0])
        self.marks.append(mark)
        return len(self.ids) - 1

    def add(self, *columns: np.ndarray) -> None:
        for held, new in zip(self.columns, columns, strict=True):
            held.append(new)
        self.n += len(columns[0])

    def arrays(self) -> list[np.ndarray]:
        kinds = ("u8", "u8", "i4", "i4", "i4")
        return [np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(self.columns, kinds, strict=True)]


def groups_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the first place of each group of equal keys, and the number of each row's group."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def repeated(rank: np.ndarray, check: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The rows whose rank is not unique, in the order of rank, check and document; unique ranks need no second sort."""
    order = np.argsort(rank)
    same = rank[order[1:]] == rank[order[:-1]]
    rows = order[np.append(same, False) | np.append(False, same)]
    return rows[np.lexsort((own[rows], check[rows], rank[rows]))]


def spread(own: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest document among the rows of each group that count."""
    return np.minimum.reduceat(np.where(counts, own, np.iinfo(np.int64).max), at), np.maximum.reduceat(np.where(counts, own, LEAST), at)


def merged(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in the order of documents, neighbours and overlaps as one."""
    order = np.lexsort((first, doc))
    doc, first, last = doc[order], first[order], last[order]
    start = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (first[1:] > last[:-1] + 1)))
    return doc[start], first[start], np.maximum.reduceat(last, start)


def by_document(ids: np.ndarray, marks: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray, kind: int) -> Iterator[tuple]:
    """Rows (id, mark, kind, bytes of (first, last) in runs) for each document."""
    if not len(doc):
        return
    doc, first, last = merged(doc, first, last)
    at, _ = groups_of(doc)
    raw, ids, marks = np.stack([first, last], axis=1).astype("<i4").tobytes(), ids[doc[at]].tolist(), marks[doc[at]].tolist()
    for k, (lo, hi) in enumerate(zip(at.tolist(), [*at[1:].tolist(), len(doc)], strict=True)):
        yield ids[k], marks[k], kind, raw[8 * lo : 8 * hi]


def planes(values: np.ndarray) -> bytes:
    """Differences of 32-bit numbers, all low bytes first, so that what is small and alike is packed well on its way."""
    return np.diff(values.astype("<i4"), prepend=np.int32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def unplaned(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel(), dtype=np.int32)


def cut_to(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widened(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


_BYTES = ("ids", "marks", "ranks", "checks", "docs", "firsts", "sizes", "signs")
SENT = "bucket int, settled boolean, " + ", ".join(f"{c} binary" for c in _BYTES)
_SENT = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), *[(c, pa.binary()) for c in _BYTES]])
BLOCK, CROWDED, WITNESS = range(3)
#: Bytes of (rank, check) that travel: a block's rank only chooses what is looked at again, its check and a window's both are its identity.
WIDTHS = {True: (6, 8), False: (8, 4)}


def sent(held: Packed, buckets: int, blocks: bool) -> Iterator[pa.RecordBatch]:
    """Settle what the task can by itself and pack the rest, a row for each bucket."""
    rank, check, doc, first, last = held.arrays()
    if not len(rank):
        return
    ids, marks = np.array(held.ids, dtype="<i8"), np.array(held.marks, dtype="<i8")
    widths = WIDTHS[blocks]
    rank, check = (c & np.uint64((1 << 8 * w) - 1) for c, w in zip((rank, check), widths, strict=True))
    own, target, sign = ids[doc], rank.copy(), np.zeros(len(rank), dtype=np.uint8)
    settled, witness = np.zeros(len(rank), dtype=bool), np.zeros(0, dtype=np.int64)
    rows = repeated(rank, check, own)
    if len(rows):
        at, group = groups_of(rank[rows], check[rows])
        settled[rows] = own[rows] > own[rows[at]][group]
        if blocks:
            # ranks with many different blocks and more than one document: dealt by block, and rows of the first and last document as witnesses
            at, group = groups_of(rank[rows])
            kinds = np.add.reduceat((~settled[rows]).astype(np.int64), at)
            low, high = spread(own[rows], ~settled[rows], at)
            crowd = (kinds >= CROWD) & (low < high)
            crowded = rows[crowd[group] & ~settled[rows]]
            target[crowded], sign[crowded] = paired(rank[crowded], check[crowded]), CROWDED
            inside = np.flatnonzero(crowd[group])
            for edge in (low, high) if len(inside) else ():
                hit = inside[(own[rows[inside]] == edge[group[inside]]) & ~settled[rows[inside]]]
                witness = np.append(witness, rows[hit[groups_of(group[hit])[0]]])

    def row(bucket: int, done: bool, doc: np.ndarray, *columns: bytes) -> pa.RecordBatch:
        used, place = np.unique(doc, return_inverse=True)
        values = [bucket, done, ids[used].tobytes(), marks[used].tobytes(), *columns[:2], planes(place), *columns[2:]]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _SENT, strict=True)], schema=_SENT)

    done = np.flatnonzero(settled)
    if len(done):
        runs = merged(doc[done], first[done], last[done])
        number = runs[0] % buckets
        order = np.argsort(number, kind="stable")
        runs, number = [c[order] for c in runs], number[order]
        at, _ = groups_of(number)
        for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(number)], strict=True):
            yield row(int(number[lo]), True, runs[0][lo:hi], b"", b"", planes(runs[1][lo:hi]), planes(runs[2][lo:hi] - runs[1][lo:hi]), b"")
    rest = np.flatnonzero(~settled)
    target = np.concatenate([target[rest], rank[witness]])
    sign = np.concatenate([sign[rest], np.full(len(witness), WITNESS, np.uint8)])
    rest = np.concatenate([rest, witness])
    number = ((target ^ (target >> np.uint64(31))) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int32)
    order = np.argsort(number, kind="stable")  # documents and places stay in order
    rest, number, sign = rest[order], number[order], sign[order]
    at, _ = groups_of(number)
    for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(rest)], strict=True):
        one = rest[lo:hi]
        yield row(int(number[lo]), False, doc[one], cut_to(rank[one], widths[0]), cut_to(check[one], widths[1]), planes(first[one]), planes(last[one] - first[one]), sign[lo:hi].tobytes())


JUDGED = "doc_id long, mark long, kind int, runs binary"


def judged(incoming: Iterator[pa.RecordBatch], blocks: bool) -> Iterator[pa.RecordBatch]:
    """All rows of a bucket together: what a smaller document holds too is removed; blocks whose rank several documents hold stay open."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(4)], names=["doc_id", "mark", "kind", "runs"])

    def bucket(rows: list[dict]) -> Iterator[tuple]:
        ids, marks = ([np.frombuffer(r[name], "<i8") for r in rows] for name in ("ids", "marks"))
        shift = np.cumsum([0, *map(len, ids)])
        doc = np.concatenate([unplaned(r["docs"]) + s for r, s in zip(rows, shift, strict=False)])
        ids, marks = np.concatenate(ids), np.concatenate(marks)
        rank, check = (np.concatenate([widened(r[name], w) for r in rows]) for name, w in zip(("ranks", "checks"), WIDTHS[blocks], strict=True))
        first, size = (np.concatenate([unplaned(r[name]) for r in rows]) for name in ("firsts", "sizes"))
        sign = np.concatenate([np.frombuffer(r["signs"], np.uint8) for r in rows])
        own = ids[doc]
        found = repeated(rank, check, own)
        gone, shared = np.zeros(len(rank), dtype=bool), sign == CROWDED
        if len(found):
            at, group = groups_of(rank[found], check[found])
            # witnesses hold no block of their own, so they settle nothing
            smallest = np.minimum.reduceat(np.where(sign[found] == WITNESS, np.iinfo(np.int64).max, own[found]), at)[group]
            gone[found] = (own[found] > smallest) & (sign[found] != WITNESS)
            if blocks:
                at, group = groups_of(rank[found])
                low, high = spread(own[found], ~gone[found], at)  # a block that goes is one with a block that stays
                shared[found] |= (low < high)[group]
        yield from by_document(ids, marks, doc[gone], first[gone], (first + size)[gone], REMOVED)
        if blocks:
            left = shared & ~gone & (sign != WITNESS)
            yield from by_document(ids, marks, doc[left], first[left], (first + size)[left], OPEN)

    def held() -> Iterator[tuple]:
        number, rows = None, []
        for batch in incoming:
            for r in batch.to_pylist():
                if r["settled"]:
                    doc, first, size = (unplaned(r[name]) for name in ("docs", "firsts", "sizes"))
                    yield from by_document(np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["marks"], "<i8"), doc, first, first + size, REMOVED)
                    continue
                if r["bucket"] != number and rows:
                    yield from bucket(rows)
                    rows = []
                number = r["bucket"]
                rows.append(r)
        if rows:
            yield from bucket(rows)

    rows = []
    for row in held():
        rows.append(row)
        if len(rows) >= 10_000:
            yield out(rows)
            rows = []
    yield out(rows)


def exchanged(pairs: DataFrame, blocks: bool) -> DataFrame:
    dealt = pairs.repartition("bucket").sortWithinPartitions("bucket", "settled")
    return dealt.mapInArrow(lean(lambda incoming: judged(incoming, blocks)), JUDGED)


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, mark (tells rows of one id apart by their text) and the text's bytes."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("raw"))


def block_pairs(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """Ranks at half the length, one for each block of windows."""
    half = (length + 1) // 2

    def rank(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, size = Packed(), [], 0
        for batch in incoming:
            for doc_id, mark, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(raw) < length or (doc := held.document(doc_id, mark)) is None:
                    continue
                for lo in range(0, len(raw) - length + 1, PART):
                    parts.append((doc, lo, raw[lo : lo + PART + length - 1]))
                    size += len(parts[-1][2])
                    if size >= PART:
                        held.add(*_blocks(parts, length, half))
                        parts, size = [], 0
                if held.n >= HELD:
                    if parts:
                        held.add(*_blocks(parts, length, half))
                    yield from sent(held, buckets, True)
                    held, parts, size = Packed(), [], 0
        if parts:
            held.add(*_blocks(parts, length, half))
        yield from sent(held, buckets, True)

    return rows.mapInArrow(lean(rank), SENT)


def _blocks(parts: list[tuple[int, int, bytes]], length: int, half: int) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    sizes = np.array([len(p[2]) for p in parts])
    start = np.cumsum(sizes) - sizes
    ranks = doubled(_LETTERS[0][raw], 1, half)
    whole = paired(ranks[: len(ranks) - (length - half)], ranks[length - half :])
    holder = lowest(ranks, length - half + 1)
    n = len(whole)
    part = np.repeat(np.arange(len(parts)), sizes)[:n]
    valid = np.arange(n) + length <= (start + sizes)[part]
    new = np.ones(n, dtype=bool)
    new[1:] = (holder[1:] != holder[:-1]) | (part[1:] != part[:-1]) | ~valid[:-1]
    # a block has fewer windows than ``length``, so its first and last window cover all its bytes
    lo = np.flatnonzero(new & valid)
    ends = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    long = ends - lo >= length - 1
    if long.any():  # one rank that holds a long run, as in a text of one letter: cut so that the two windows still cover the block
        pieces = [np.arange(a, b + 1, length - 1) for a, b in zip(lo[long].tolist(), ends[long].tolist(), strict=True)]
        more = np.concatenate(pieces)
        stops = np.concatenate([np.append(p[1:] - 1, b) for p, b in zip(pieces, ends[long].tolist(), strict=True)])
        lo, ends = np.concatenate([lo[~long], more]), np.concatenate([ends[~long], stops])
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    up, down = _powers(len(raw))
    np.cumsum(_LETTERS[1][raw] * up[: len(raw)], out=total[1:])
    other = (total[ends + length] - total[lo]) * down[lo]
    check = paired(paired(whole[lo], whole[ends]), other + (ends - lo).astype(np.uint64) * _C)
    doc = np.array([p[0] for p in parts], dtype=np.int32)[part[lo]]
    shift = np.array([p[1] for p in parts], dtype=np.int64) - start
    return holder[lo], check, doc, (lo + shift[part[lo]]).astype(np.int32), (ends + shift[part[lo]]).astype(np.int32)


_POWER: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWER[0]) <= n:
        for k, by in enumerate((int(_B), pow(int(_B), -1, 1 << 64))):
            _POWER[k] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n + (1 << 16), by, np.uint64))])
    return _POWER


def window_pairs(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """doc_id, mark, raw and the open runs of windows: ranks of whole windows."""
    half = (length + 1) // 2

    def rank(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, size = Packed(), [], 0
        for batch in incoming:
            for doc_id, mark, raw, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc := held.document(doc_id, mark)) is None:
                    continue
                spans = np.frombuffer(b"".join(runs), "<i4").reshape(-1, 2)
                for first, last in spans[np.argsort(spans[:, 0])].tolist():
                    for lo in range(first, last + 1, PART):
                        parts.append((doc, lo, raw[lo : min(lo + PART, last + 1) + length - 1]))
                        size += len(parts[-1][2])
                        if size >= PART:
                            held.add(*_windows(parts, length, half))
                            parts, size = [], 0
                if held.n >= HELD:
                    if parts:
                        held.add(*_windows(parts, length, half))
                    yield from sent(held, buckets, False)
                    held, parts, size = Packed(), [], 0
        if parts:
            held.add(*_windows(parts, length, half))
        yield from sent(held, buckets, False)

    return rows.mapInArrow(lean(rank), SENT)


def _windows(parts: list[tuple[int, int, bytes]], length: int, half: int) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    sizes = np.array([len(p[2]) for p in parts])
    start = np.cumsum(sizes) - sizes
    whole = []
    for letters in _LETTERS:
        ranks = doubled(letters[raw], 1, half)
        whole.append(paired(ranks[: len(ranks) - (length - half)], ranks[length - half :]))
    part = np.repeat(np.arange(len(parts)), sizes)[: len(whole[0])]
    at = np.flatnonzero(np.arange(len(part)) + length <= (start + sizes)[part])
    part = part[at]
    place = (at + (np.array([p[1] for p in parts], dtype=np.int64) - start)[part]).astype(np.int32)
    return whole[0][at], whole[1][at], np.array([p[0] for p in parts], dtype=np.int32)[part], place, place


def removed_runs(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark and runs (list of bytes: pairs of the first and last start of removed strings), one row for each text with any."""
    rows = marked(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(total / BUCKET_BYTES))
    first = save(exchanged(block_pairs(rows, length, buckets), True), "blocks")
    per_document = lambda df: df.groupBy("doc_id", "mark").agg(F.collect_list("runs").alias("runs"))  # noqa: E731  (bounded by the document's length)
    unnulled = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(LEAST)))
    # rows that repeat an id and a text are judged once
    left = unnulled.join(per_document(first.filter(F.col("kind") == OPEN)), ["doc_id", "mark"]).select("doc_id", "mark", "raw", "runs")
    second = save(exchanged(window_pairs(left, length, buckets), False), "windows")
    return per_document(first.filter(F.col("kind") == REMOVED).unionByName(second))


KEPT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (the maximal removed runs of bytes) and kept (what is left), one row for each row."""
    if length < 4:
        raise ValueError("strings of fewer than 4 bytes are no repeats")
    runs = removed_runs(docs, length, id_col, text_col).select(F.col("doc_id").alias("run_id"), F.col("mark").alias("run_mark"), "runs")
    rows = marked(docs, id_col, text_col)
    same = (F.coalesce(rows["doc_id"], F.lit(LEAST)) == runs["run_id"]) & (rows["mark"] == runs["run_mark"])

    def cut(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            out = [], [], []
            for raw, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = np.frombuffer(b"".join(found or []), "<i4").reshape(-1, 2).astype(np.int64)
                spans = spans[np.argsort(spans[:, 0], kind="stable")]
                starts, ends = spans[:, 0], np.maximum.accumulate(spans[:, 1] + length)
                new = np.flatnonzero(np.append(True, starts[1:] > ends[:-1])) if len(spans) else np.zeros(0, int)
                starts, ends = starts[new].tolist(), ends[np.append(new[1:] - 1, len(spans) - 1)].tolist() if len(spans) else []
                out[0].append(len(raw))
                out[1].append([{"start": a, "end": b} for a, b in zip(starts, ends, strict=True)])
                out[2].append(b"".join(raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)], strict=True)))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], span), pa.array(out[2], pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return rows.join(runs, same, "left").select("doc_id", "raw", "runs").mapInArrow(lean(cut), KEPT)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes left."""
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Every string of 50 bytes as hex, cut from chunks of 1,000 starts.
ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (SELECT doc_id, c, substr(h, 2000 * c + 1, 2098) AS part FROM (SELECT doc_id, h, unnest(range(0, (length(h) // 2) // 1000 + 1)) AS c FROM d)),
windows AS (SELECT doc_id, 1000 * c + i AS p, substr(part, 2 * i + 1, 100) AS s FROM (SELECT doc_id, c, part, unnest(range(0, least(1000, length(part) // 2 - 49))) AS i FROM chunks WHERE length(part) >= 100)),
gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS low FROM windows) WHERE low < doc_id),
steps AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM gone),
runs AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM steps),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run),
pieces AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS lo, a AS hi FROM spans UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (SELECT d.doc_id, string_agg(CASE WHEN hi IS NULL THEN substr(h, 2 * lo + 1) ELSE substr(h, 2 * lo + 1, 2 * (hi - lo)) END, '' ORDER BY lo) AS k FROM d JOIN pieces USING (doc_id) GROUP BY d.doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
