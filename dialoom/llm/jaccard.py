"""N-gram Jaccard join with Bayesian candidate pruning, and near-duplicate classes on top of it.

Shingles are ``SHINGLE`` consecutive words (64-bit hashes); a shorter text with words has one shingle, all of
its words. Two texts are linked if the Jaccard similarity of their shingle sets is at least 4/5.

1. Documents with the same shingle set are one set, which gets a number (``sid``) of its own; what follows is on sets.
2. MinHash values (``BANDS`` x ``ROWS``) put sets into buckets, one for each band. A pair at similarity 0.8 shares
   no bucket with probability (1 - 0.8**5)**32, about 3 in a million.
3. In a bucket, pairs are compared on their MinHash values, ``STEP`` at a time, and dropped as soon as the
   posterior probability (uniform prior) of reaching the threshold is below ``TOLERANCE``. A bucket of more than
   ``BLOCK`` sets is cut into blocks by chance, anew in every band. First pairs of one block are compared, and chains
   through the surviving pairs' trees give components. Only in buckets that then still hold several components are pairs of
   different components compared across blocks: the largest component's blocks meet the blocks of the others. So what goes
   on is in proportion to the rows, never the pairs themselves, and a group whose sets all resemble each other is not copied.
4. The components hold every surviving pair. Their sets are shingled again, and inside a component the pairs that survive
   the same pruning are verified exactly: in blocks of ``HELD_ROWS`` sets (``HELD_BYTES`` of shingles), then, for larger components, a block
   in memory against the stream of all the others.
5. Links are counted per set, copies included; classes are the components of the verified links.

Defined results: texts without words (null or empty) are linked to nothing and are classes of their own; rows with a null
id are linked like all others, and a class of only such rows has class null;
repeated rows are copies; rows that repeat an id with another text are judged by their own text; an empty table gives no
rows; extra columns are ignored (kept by ``deduplicate``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import hub_join, lean, packed, save, table, unpacked
from dialoom.llm.components import components, relabelled
from dialoom.llm.tokens import batches

SHINGLE = 5
NUMERATOR, DENOMINATOR = 4, 5
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-6
BLOCK = 512
HELD_ROWS, HELD_BYTES = 2048, 16_000_000
TILE_ROWS, TILE_BYTES = 128, 4_000_000
FAN = 32
WORD_CACHE = 300_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)
_words: dict[bytes, int] = {}


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if len(_words) > WORD_CACHE:
        _words.clear()
    ids = np.empty(len(words), dtype=np.uint64)
    for i, w in enumerate(words):
        h = _words.get(w)
        if h is None:
            h = _words[w] = xxhash.xxh64_intdigest(w)
        ids[i] = h
    n = min(SHINGLE, len(words))
    if not n:
        return ids
    width = len(words) - n + 1
    total = np.full(width, n, dtype=np.uint64)
    for k in range(n):
        total = _finish(total + ids[k : k + width] * _MIX[k])
    return np.unique(total)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    seed = _finish(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * _MIX[0])
    return seed[:HASHES] | np.uint64(1), seed[HASHES:]


def minhash(found: np.ndarray) -> np.ndarray:
    factor, shift = _permutations()
    low = np.full(HASHES, np.uint64(2**64 - 1))
    for at in range(0, len(found), 2048):
        part = np.multiply.outer(factor, found[at : at + 2048])
        part += shift[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def least_matches(tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches needed): below it the posterior, one minus the beta(m+1, n-m+1) CDF at the threshold, is under the tolerance."""
    t, out = NUMERATOR / DENOMINATOR, []
    for n in range(STEP, HASHES + 1, STEP):
        reach = lambda m, n=n: sum(comb(n + 1, j) * t**j * (1 - t) ** (n + 1 - j) for j in range(m + 1))
        out.append((n, next((m for m in range(n + 1) if reach(m) >= tolerance), n + 1)))
    return out


NEEDED = least_matches()


def survivors(one: np.ndarray, other: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Those of the pairs (row ``left`` of one, row ``right`` of other) that are still possible; values are the MinHashes' low bytes."""
    matches, at = np.zeros(len(left), dtype=np.int32), 0
    for n, least in NEEDED:
        matches += (one[left, at:n] == other[right, at:n]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        left, right, matches, at = left[keep], right[keep], matches[keep], n
        if not len(left):
            break
    return np.stack([left, right], axis=1)


def every_pair(one: int, other: int, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of two tiles, or those of one tile with itself, each once."""
    if same:
        return np.triu_indices(one, 1)
    return np.divmod(np.arange(one * other), other)


def chains(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Edges (a, b), a > b, with the same components as the edges (x, y): each component's nodes as a heap-shaped tree of ``FAN`` children
    a node, the smallest at the top. So no node has many edges, and paths are short, which saves rounds of ``components``."""
    ids, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = at[: len(x)], at[len(x) :]
    label = np.arange(len(ids))
    while True:
        low, new = np.minimum(label[x], label[y]), label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    order = np.argsort(label, kind="stable")
    top = np.searchsorted(label[order], label[order])  # place of the smallest node of each one's component
    below = np.flatnonzero(np.arange(len(order)) > top)
    over = top[below] + (below - top[below] - 1) // FAN
    return np.stack([ids[order[below]], ids[order[over]]], axis=1)


def grouped(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def groups(incoming: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of a stream that is sorted by its first columns."""
    key, held = None, []
    for batch in incoming:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:n_keys] != key:
                if held:
                    yield key, held
                key, held = row[:n_keys], []
            held.append(row[n_keys:])
    if held:
        yield key, held


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, set_key (null without words), low bytes of the MinHashes, and a hash for each band."""

    def sign(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            ids, lows, bands = batch.column(0), [], []
            keys, every = set_keys(batch.column(1))
            for found in every:
                if not len(found):
                    lows.append(None), bands.append(None)
                    continue
                values = minhash(found)
                lows.append((values & 0xFF).astype(np.uint8).tobytes())
                mixed = np.arange(1, BANDS + 1, dtype=np.uint64)
                for k in range(ROWS):
                    mixed = _finish(mixed + values.reshape(BANDS, ROWS)[:, k].astype(np.uint64) * _MIX[k])
                bands.append(mixed.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), pa.array(lows, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "set_key", "low", "bands"])
        _words.clear()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(sign), "doc_id long, set_key binary, low binary, bands array<long>")


def lows_of(rows: list[tuple], at: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[at] for r in rows), np.uint8).reshape(len(rows), HASHES)


def prune(dealt: DataFrame) -> DataFrame:
    """(bucket, i, j, own, node, low) to edges (a, b) that connect the nodes of surviving pairs between the blocks i and j of a bucket."""

    def forests(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[np.ndarray] = []
        for (_, i, j), rows in groups(incoming, 3):
            one, other = ([r for r in rows if r[0] == k] for k in (i, j))
            left, right = every_pair(len(one), len(other), i == j)
            nodes = np.array([r[1] for r in one]), np.array([r[1] for r in other])
            apart = nodes[0][left] != nodes[1][right] if len(left) else np.zeros(0, bool)
            if not apart.any():
                continue
            pairs = survivors(lows_of(one, 2), lows_of(other, 2), left[apart], right[apart])
            if len(pairs):
                edges.append(chains(nodes[0][pairs[:, 0]], nodes[1][pairs[:, 1]]))
            if len(edges) > 5_000:
                yield _pairs(edges)
                edges = []
        yield _pairs(edges)

    return grouped(dealt.select("bucket", "i", "j", "own", "node", "low"), ["bucket", "i", "j"]).mapInArrow(lean(forests), "a long, b long")


def candidates(sets: DataFrame) -> DataFrame:
    """(node, component) such that sets which share a bucket and survive the pruning are in one component."""
    bands = sets.select("sid", F.explode("bands").alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = save(hub_join(bands, save(sizes, "sizes"), "bucket", "m", BANDS * sets.count()), "members")
    lows, blocks = sets.select("sid", "low"), F.ceil(F.col("m") / F.lit(BLOCK))
    own = F.pmod(F.xxhash64("sid", "bucket"), blocks).cast("int")
    inside = members.withColumns({"own": own, "i": own, "j": own}).join(lows, "sid").withColumnRenamed("sid", "node")
    first = save(components(prune(inside)), "components")
    # buckets of several blocks that still hold several components
    wide = members.filter(F.col("m") > BLOCK).join(first.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "bucket", F.coalesce("component", "sid").alias("label"))
    wide = save(wide, "wide")
    shares = wide.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = shares.groupBy("bucket").agg(F.sum("n").alias("m"), F.max("n").alias("most"), F.max_by("label", F.struct("n", "label")).alias("major"), F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    mixed = save(mixed, "mixed")
    if mixed.isEmpty():
        return first
    crossing = hub_join(wide, mixed, "bucket", "m", members.count())
    major, n_major, n_minor = F.col("label") == F.col("major"), F.ceil(F.col("most") / F.lit(BLOCK)).cast("int"), F.ceil((F.col("m") - F.col("most")) / F.lit(BLOCK)).cast("int")
    place = F.xxhash64("sid", "bucket")
    crossing = crossing.withColumn("own", F.when(major, F.pmod(place, n_major)).otherwise(n_major + F.pmod(place, n_minor)).cast("int"))
    crossing = crossing.withColumn("with", F.explode(F.sequence(F.when(major, n_major).otherwise(F.lit(0)), n_major + n_minor - 1)))
    crossing = crossing.withColumns({"i": F.least("own", "with"), "j": F.greatest("own", "with")}).join(lows, "sid").withColumn("node", F.col("label"))
    return save(relabelled(first, save(components(prune(crossing)), "components")), "candidates")


def _pairs(edges: list[np.ndarray]) -> pa.RecordBatch:
    """What the edges of many groups connect, as the edges of one forest."""
    every = chains(*np.concatenate(edges).T) if edges else np.zeros((0, 2), dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(every[:, k], pa.int64()) for k in (0, 1)], names=["a", "b"])


def exact_links(one: list[np.ndarray], other: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Those of the index pairs whose shingle sets reach the threshold; many pairs go through a product of 0/1 matrices, columns in chunks."""
    if not len(pairs):
        return pairs
    n_one, n_other = np.array([len(s) for s in one]), np.array([len(s) for s in other])
    if len(pairs) <= 64:
        both = np.array([np.intersect1d(one[x], other[y], assume_unique=True).size for x, y in pairs.tolist()])
    else:
        every, column = np.unique(np.concatenate([*one, *other]), return_inverse=True)
        row = np.repeat(np.arange(len(one) + len(other)), np.concatenate([n_one, n_other]))
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        total = np.zeros((len(one), len(other)), dtype=np.int64)
        for lo in range(0, len(every), 8192):
            width = min(8192, len(every) - lo)
            first, last = np.searchsorted(column, [lo, lo + width])
            held = np.zeros((len(one) + len(other), width), dtype=np.float32)
            held[row[first:last], column[first:last] - lo] = 1
            total += (held[: len(one)] @ held[len(one) :].T).astype(np.int64)
        both = total[pairs[:, 0], pairs[:, 1]]
    union = n_one[pairs[:, 0]] + n_other[pairs[:, 1]] - both
    return pairs[DENOMINATOR * both >= NUMERATOR * union]


def set_keys(texts: pa.Array) -> tuple[list[bytes | None], list[np.ndarray]]:
    found = [shingles(t.as_py()) for t in texts]
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in found], found


def with_shingles(docs: DataFrame, sets: DataFrame, chosen: DataFrame) -> DataFrame:
    """(component, sid, copies, low, shingles, blocks) of the chosen sets, whose text is looked up by the first id and known by the set key."""

    def read(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            keys, found = set_keys(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())], names=["set_key", "shingles"])

    members = save(chosen.withColumnRenamed("node", "sid").join(sets.select("sid", "set_key", "first_id", "copies", "low"), "sid"), "chosen")
    ids = save(members.select(F.col("first_id").alias("doc_id")).distinct(), "chosen_ids")  # Spark broadcasts it if its file is small
    wanted = docs.join(ids, "doc_id", "left_semi")
    if not members.filter("first_id is null").isEmpty():  # sets that only rows without an id have
        wanted = wanted.unionByName(docs.filter("doc_id is null"))
    texts = wanted.select("text").mapInArrow(lean(read), "set_key binary, shingles binary").dropDuplicates(["set_key"])
    held = save(members.drop("first_id").join(texts, "set_key").drop("set_key"), "shingles")
    sizes = held.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum(F.octet_length("shingles")).alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("m") / F.lit(HELD_ROWS), F.col("bytes") / F.lit(HELD_BYTES))).cast("int")
    return hub_join(held, save(sizes.select("component", "m", blocks.alias("blocks")), "sizes"), "component", "m", held.count())


class Tile:
    """Some sets of a component: label, sid and copies, MinHashes, shingles, and the links found so far."""

    def __init__(self, rows: list[tuple]):
        self.labels, self.sids, self.copies = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(3))
        self.lows, self.held = lows_of(rows, 3), [np.frombuffer(r[4], "<u8") for r in rows]
        self.links = np.zeros(len(rows), dtype=np.int64)

    def link(self, other: Tile, mutual: bool) -> np.ndarray:
        """Count the links to another tile (or to itself), for the other too if mutual; edges that connect the linked labels."""
        pairs = survivors(self.lows, other.lows, *every_pair(len(self.sids), len(other.sids), self is other))
        x, y = exact_links(self.held, other.held, pairs).T
        np.add.at(self.links, x, other.copies[y])
        if mutual:
            np.add.at(other.links, y, self.copies[x])
        return chains(self.labels[x], other.labels[y])


def tiles(rows: Iterator[tuple]) -> Iterator[Tile]:
    """Rows (label, sid, copies, low, shingles) in tiles of a size that two may be compared at once."""
    return map(Tile, batches(rows, lambda r: max(len(r[4]), TILE_BYTES // TILE_ROWS), TILE_BYTES))


def verify(dealt: DataFrame) -> DataFrame:
    """(component, i, apart, label, sid, copies, low, shingles): block i of a component (apart = 0) and what is compared with it.

    Without rows apart the pairs of the block itself are compared, else the block with all rows apart, which are read as a stream.
    Gives rows (sid, links, null, null) for the block's sets and rows (null, null, a, b) that connect the labels of linked sets.
    """

    def out(own: list[Tile], edges: np.ndarray) -> pa.RecordBatch:
        sids, links = np.concatenate([t.sids for t in own]), np.concatenate([t.links for t in own])
        n, k = len(sids), len(edges)
        columns = [[*sids.tolist(), *[None] * k], [*links.tolist(), *[None] * k], [*[None] * n, *edges[:, 0].tolist()], [*[None] * n, *edges[:, 1].tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["sid", "links", "a", "b"])

    def check(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in incoming for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, block in groupby(rows, key=lambda r: r[:2]):
            own, alone, edges = [], True, np.zeros((0, 2), dtype=np.int64)
            for apart, part in groupby(block, key=lambda r: r[2]):
                if not apart:
                    own = list(tiles(r[3:] for r in part))
                    continue
                alone = False
                for tile in tiles(r[3:] for r in part):
                    new = np.concatenate([edges, *(mine.link(tile, False) for mine in own)])
                    edges = chains(*new.T)
            if alone:
                for k, mine in enumerate(own):
                    edges = chains(*np.concatenate([edges, *(mine.link(tile, True) for tile in own[: k + 1])]).T)
            if own:
                yield out(own, edges)

    wanted = dealt.select("component", "i", "apart", "label", "sid", "copies", "low", "shingles")
    return wanted.repartition("component", "i").sortWithinPartitions("component", "i", "apart").mapInArrow(lean(check), "sid long, links long, a long, b long")


def links_and_classes(docs: DataFrame, sets: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sid, links) of linked sets and (node, component) of the verified links."""
    held = with_shingles(docs, sets, chosen).withColumn("own", F.pmod(F.xxhash64("sid", F.lit(11)), F.col("blocks")).cast("int"))
    inside = save(verify(held.withColumns({"i": F.col("own"), "apart": F.lit(0), "label": F.col("sid")})), "links")
    first = save(components(inside.filter("a is not null")), "classes")
    large = held.filter("blocks > 1")
    if large.isEmpty():
        return inside.filter("sid is not null").select("sid", "links"), first
    wide = large.join(first.select(F.col("node").alias("sid"), F.col("component").alias("class")), "sid", "left").withColumn("label", F.coalesce("class", "sid"))
    wide = wide.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("apart", (F.col("i") != F.col("own")).cast("int"))
    across = save(verify(wide), "links")
    links = inside.unionByName(across).filter("sid is not null").groupBy("sid").agg(F.sum("links").alias("links"))
    return links, save(relabelled(first, save(components(across.filter("a is not null")), "classes")), "classes")


def classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) to its signed rows (doc_id, set_key) and the sets: set_key, copies, class_id, n_links, and wins for one set of each class."""
    sign = save(signed(docs), "signed")
    sets = sign.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("low").alias("low"), F.first("bands").alias("bands"))
    sets = save(sets.withColumn("sid", F.monotonically_increasing_id()), "sets")  # written once, so the numbers stay
    links, classes = links_and_classes(docs, sets, candidates(sets))
    known = sets.select("sid", "set_key", "first_id", "copies").join(links, "sid", "left").join(classes.withColumnRenamed("node", "sid"), "sid", "left")
    known = save(known.withColumn("component", F.coalesce("component", "sid")), "known")
    firsts = known.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.min("first_id").alias("class_id"))
    winner = known.filter("first_id is not null").groupBy("component").agg(F.min_by("set_key", F.struct("first_id", "set_key")).alias("winner"))
    firsts = firsts.join(winner, "component", "left")
    known = hub_join(known, save(firsts, "firsts"), "component", "m", known.count())
    n_links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long")
    return sign.select("doc_id", "set_key"), save(known.select("set_key", "copies", "class_id", n_links.alias("n_links"), F.col("set_key").eqNullSafe(F.col("winner")).alias("wins")), "known")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (smallest id among all that links connect) and n_links (other rows linked, copies included), one row for each row."""
    sign, known = classified(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    return _rows(sign, known).select("doc_id", "class_id", "n_links")


def _rows(sign: DataFrame, known: DataFrame) -> DataFrame:
    worded = hub_join(sign.filter("set_key is not null"), known, "set_key", "copies", sign.count())
    none = sign.filter("set_key is null").select("doc_id", "set_key", F.lit(1).cast("long").alias("copies"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("wins"))
    return worded.unionByName(none)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class stays, one with the smallest id; texts without words are classes of their own.

    Of rows that repeat an id and a shingle set one stays; rows that repeat an id with another set are judged each by its own; rows with a null
    id stay. Texts are not shuffled: ids that go are anti-joined, and only rows with a repeated id are looked at by their text.
    """
    sign, known = classified(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    stays = F.col("wins") & (F.col("doc_id") == F.col("class_id"))
    ids = _rows(sign, known).filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or(stays).alias("stays"))
    ids = save(ids.filter("n > 1 or not stays").select(F.col("doc_id").alias("near_id"), (F.col("n") > 1).alias("near_repeated")), "near_ids")
    columns, docs = docs.columns, packed(docs, id_col, text_col)
    out = docs.join(ids.select("near_id"), F.col(id_col) == F.col("near_id"), "left_anti")
    repeated = ids.filter("near_repeated").select("near_id")
    if repeated.isEmpty():
        return unpacked(out, columns)
    key = F.pandas_udf(lambda texts: pd.Series(set_keys(pa.array(texts, pa.string()))[0], dtype=object), "binary")
    again = docs.join(repeated, F.col(id_col) == F.col("near_id"), "left_semi").withColumn("near_key", key(F.col(text_col)))
    winners = known.filter("wins").select(F.col("set_key").alias("near_set"), F.col("class_id").alias("near_class"))
    won = again.join(winners, (F.col("near_key") == F.col("near_set")) & (F.col(id_col) == F.col("near_class")), "left_semi")
    again = won.unionByName(again.filter("near_key is null")).dropDuplicates([id_col, "near_key"]).drop("near_key")
    return unpacked(out.unionByName(again), columns)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
