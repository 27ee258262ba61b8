"""Token ids in binary blocks with Elias-Fano document boundaries.

File format: a Parquet folder of blocks, ordered by (part, seq). ``part`` is the range partition of the
document order, ``seq`` counts blocks in it and ``part_start`` says how many ids of the part come before the
block. ``ids`` holds the concatenated ids (little-endian, 2 bytes if the vocabulary allows, else 4), every
document closed by the end id. The ends of the documents inside the block are an Elias-Fano sequence:
``lows`` (low bits), ``highs`` (unary high bits) and ``hints`` (position of every 256th one, for select).
So a boundary takes about 2 + log2(ids per document) bits, and an offset is found without a table. The ids of the documents, in ascending
order from ``first_id`` on after ``n_null`` null ones, are a second such sequence (``id_lows``, ``id_highs``).

Spark's own writer makes the files, so a lost executor's task is run again and only committed files count,
and any store that Spark can write will do. Documents are dealt by range of the id column; a block holds
``BLOCK_IDS`` ids or ``BLOCK_DOCS`` documents or one longer document, whichever comes first.

Defined results: null text is empty and gives one id (the end id); null ids sort first; rows that repeat an
id are ordered by text; an empty table gives an empty folder and no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import lean, new_path, table

BLOCK_IDS, BLOCK_DOCS = 1_000_000, 4096
BATCH_CHARS = 1_000_000
CACHE_WORDS = 3_000_000
CHAIN = 256
LONG_PIECE = 256
HINT = 256
END_ID = 0
BLOCKS = ("part int, seq int, part_start long, n_docs int, n_ids long, width int, ids binary, "
          "low_bits int, lows binary, highs binary, hints binary, n_null int, first_id long, id_low_bits int, id_lows binary, id_highs binary")  # fmt: skip
#: Ids of a block lie closer than this.
ID_RANGE = 1 << 62

class EliasFano:
    """A non-decreasing sequence of integers in [0, universe]."""

    def __init__(self, n: int, low_bits: int, lows: bytes, highs: bytes, hints: bytes):
        self.n, self.low_bits, self.lows, self.highs, self.hints = n, low_bits, lows, highs, hints
        self.places = np.frombuffer(hints, "<u4").tolist()

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        values, n = np.asarray(values, dtype=np.int64), len(values)
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        ones = (values >> low_bits) + np.arange(n)
        high = np.zeros((int(ones[-1]) + 1) if n else 0, dtype=np.uint8)
        high[ones] = 1
        low = (values[:, None] >> np.arange(low_bits)) & 1
        return cls(n, low_bits, np.packbits(low.astype(np.uint8), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::HINT].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        return (int.from_bytes(self.lows[first // 8 : (last + 7) // 8], "little") >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value i: start at the hint below it and count ones byte by byte."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = self.places[i // HINT]
        left, byte = i % HINT, at // 8
        bits = self.highs[byte] >> (at % 8) << (at % 8)
        while left >= (ones := bits.bit_count()):
            left -= ones
            byte += 1
            bits = self.highs[byte]
        for _ in range(left):
            bits &= bits - 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low(i)

    def decode(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.highs, np.uint8), bitorder="little"))
        low = np.unpackbits(np.frombuffer(self.lows, np.uint8), bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        return ((ones - np.arange(self.n)) << self.low_bits) | (low.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64)))


LETTER, DIGIT, SIGN, SPACE, LINE, CONTROL, OTHER = range(7)
_KIND = np.full(256, OTHER, dtype=np.uint8)
_KIND[:128] = CONTROL
_KIND[33:127] = SIGN
_KIND[ord("0") : ord("9") + 1] = DIGIT
_KIND[ord("a") : ord("z") + 1] = _KIND[ord("A") : ord("Z") + 1] = LETTER
_KIND[ord(" ")], _KIND[ord("\n")] = SPACE, LINE
#: Kinds between which the pre-tokenizer always ends a piece (a sign before a letter only if it is no apostrophe).
_ENDS = np.zeros((7, 7), dtype=bool)
_ENDS[LETTER, [DIGIT, SIGN, SPACE, LINE]] = _ENDS[DIGIT, [LETTER, SIGN, SPACE, LINE]] = _ENDS[SIGN, [LETTER, DIGIT, SPACE, LINE]] = _ENDS[OTHER, SPACE] = True
_ENDS = _ENDS.ravel()
#: Three-byte white space: last two bytes after 0xE2, and the two single ones.
_E2_SPACE = {(0x80, x) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)} | {(0x81, 0x9F)}


def piece_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Places where UTF-8 texts may be cut so that the ids of the pieces, concatenated, are those of the texts (which start at ``texts``).

    A cut lies between an ASCII letter, digit or sign and what the pre-tokenizer never joins to it, before a space that
    follows a visible character, and after a single line end between visible ASCII characters.
    """
    kind = _KIND[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[1:-1] = _ENDS[kind[:-1] * np.uint8(7) + kind[1:]]
    cut[1:-1] &= ~((raw[:-1] == ord("'")) & (kind[1:] == LETTER))
    if len(raw) > 2:
        visible = kind <= SIGN
        cut[2:-1] |= (kind[1:-1] == LINE) & visible[:-2] & visible[2:]
        after = np.flatnonzero(cut[:-1] & (kind == SPACE))  # a space after a character of several bytes, which may be white space itself
        after = after[kind[after - 1] == OTHER]
        one, two, three = raw[after - 1], raw[after - 2], raw[np.maximum(after - 3, 0)]
        blank = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (three == 0xE1) & (two == 0x9A) & (one == 0x80) | (three == 0xE3) & (two == 0x80) & (one == 0x80)
        for x, y in _E2_SPACE:
            blank |= (three == 0xE2) & (two == x) & (one == y)
        cut[after[blank]] = False
    cut[texts] = True
    cut[-1] = False
    return np.flatnonzero(cut)


class Pieces:
    """Ids of known pieces by two 64-bit hashes: a sorted array, so a million pieces take some 30 MB and no objects."""

    def __init__(self, dtype: str):
        self.dtype = dtype
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, dtype), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if new."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return np.where(known, at, -1)

    def add(self, keys: np.ndarray, checks: np.ndarray, encoded: list[bytes]) -> None:
        """New pieces, keys in ascending order."""
        raw = np.frombuffer(b"".join(encoded), self.dtype)
        count = np.array([len(e) for e in encoded], dtype=np.int64) // raw.itemsize
        if self.used + len(raw) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + len(raw), self.dtype)])
        self.ids[self.used : self.used + len(raw)] = raw
        at = np.searchsorted(self.keys, keys)
        self.keys, self.checks, self.count = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks), np.insert(self.count, at, count)
        self.first = np.insert(self.first, at, self.used + np.cumsum(count) - count)
        self.used += len(raw)

    def spelled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows' pieces in a row, and how many each has."""
        count = self.count[rows]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.first[rows] - ends + count, count) + np.arange(total)], count


_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_LETTERS = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


class Encoder:
    """Texts to ids with a tokenizers file, piece by piece with a bounded cache.

    Texts are cut where the pre-tokenizer always cuts (``piece_starts``), so the library sees every distinct piece once per cache
    period. Pieces are told apart by two polynomial hashes of their bytes, taken for all pieces at once. Texts with a piece of over
    ``LONG_PIECE`` bytes go to the library whole, and so do all should two pieces ever share one hash but not the other. New
    pieces that begin with a space go through the library in chains of ``CHAIN``, whose ids are cut where a token begins with a space.

    The vocabulary's special tokens inside a text get their ids, as the library gives them; with ``plain_specials`` their strings are
    ordinary text. Texts that hold one go to the library whole.
    """

    #: Powers of the multipliers and of their inverses, one set for all encoders of a process.
    powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * 2

    def __init__(self, vocabulary: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.pieces = Pieces(self.dtype)
        self.opens = np.zeros(1 << 8 * np.dtype(self.dtype).itemsize if self.dtype == "<u2" else self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")  # the vocabulary's sign for a leading space

    def starts(self, raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
        return piece_starts(raw, texts)

    def plain(self, texts: list[str]) -> list[bytes]:
        """Straight through the library."""
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def spaced(self, pieces: list[str]) -> list[bytes]:
        """Pieces of a space and no other white space, many in one call."""
        out = []
        chains = [pieces[lo : lo + CHAIN] for lo in range(0, len(pieces), CHAIN)]
        for chain, e in zip(chains, self.tokenizer.encode_batch_fast(["".join(c) for c in chains], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=self.dtype)
            starts = np.flatnonzero(self.opens[ids]).tolist()
            if len(starts) != len(chain):
                raise ValueError("the vocabulary does not mark every space")
            width, raw = ids.itemsize, ids.tobytes()
            out += [raw[lo * width : hi * width] for lo, hi in zip(starts, [*starts[1:], len(ids)], strict=True)]
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Each piece alone."""
        chained = [p[0] == " " and (p[1:].isalpha() or p.split() == [p[1:]]) for p in pieces]
        found = iter(self.spaced([p for p, c in zip(pieces, chained, strict=True) if c])), iter(self.plain([p for p, c in zip(pieces, chained, strict=True) if not c]))
        return [next(found[not c]) for c in chained]

    def after_space(self, words: list[str]) -> list[bytes]:
        """Ids of words as after a space."""
        return self.encode_pieces([" " + w for w in words])

    def _hashes(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        out = []
        for k, by in enumerate(_MULTIPLIERS):
            if len(self.powers[k][0]) <= len(raw):
                inverse = np.uint64(pow(int(by), -1, 1 << 64))
                self.powers[k] = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(raw) + (1 << 20), x, np.uint64))]) for x in (by, inverse))
            up, down = self.powers[k]
            total = np.zeros(len(raw) + 1, dtype=np.uint64)
            np.cumsum(_LETTERS[k][raw] * up[: len(raw)], out=total[1:])
            x = (total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * by
            x ^= x >> np.uint64(32)
            out.append(x * np.uint64(0xFF51AFD7ED558CCD))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of ``dtype``."""
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(e) for e in encoded], dtype=np.int64)
        joined = b"".join(encoded)
        raw = np.frombuffer(joined, np.uint8)
        if not len(raw):
            return [b""] * len(texts)
        offsets = np.cumsum(sizes) - sizes
        start = self.starts(raw, offsets[sizes > 0])
        end = np.append(start[1:], len(raw))
        long = np.flatnonzero(end - start > LONG_PIECE)
        whole = {k for k, t in enumerate(texts) if any(x in t for x in self.specials)}
        if len(long) or whole:
            whole.update((np.searchsorted(offsets, start[long], side="right") - 1).tolist())
            found = iter(self.plain([texts[k] for k in sorted(whole)])), iter(self.encode([t for k, t in enumerate(texts) if k not in whole]))
            return [next(found[k not in whole]) for k in range(len(texts))]
        hashed, checked = self._hashes(raw, start, end)
        keys, one, which = np.unique(hashed, return_index=True, return_inverse=True)
        checks = checked[one]
        rows = self.pieces.find(keys)
        known = rows >= 0
        if (checks[which] != checked).any() or (self.pieces.checks[rows[known]] != checks[known]).any():
            return self.plain(texts)
        if not known.all():
            if len(self.pieces.keys) + len(keys) > CACHE_WORDS or self.pieces.used > 8 * CACHE_WORDS:
                self.pieces = Pieces(self.dtype)
                known[:] = False
            new = np.flatnonzero(~known)
            bounds = zip(start[one[new]].tolist(), end[one[new]].tolist(), strict=True)
            self.pieces.add(keys[new], checks[new], self.encode_pieces([joined[lo:hi].decode("utf-8", "surrogatepass") for lo, hi in bounds]))
            rows = self.pieces.find(keys)
        ids, count = self.pieces.spelled(rows[which])
        ends = np.concatenate([[0], np.cumsum(count)])
        bounds = (ends[np.searchsorted(start, np.append(offsets, len(raw)))] * ids.itemsize).tolist()
        spelled = ids.tobytes()
        return [spelled[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(vocabulary: str | None = None, plain_specials: bool = False) -> Encoder:
    """One encoder for each worker process and vocabulary; without one the default is looked up where the task runs."""
    key = vocabulary or default_vocabulary(), plain_specials
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def batches(rows: Iterator, size, most: int) -> Iterator[list]:
    """Lists of rows of ``most`` in total size, or one larger row."""
    held, total = [], 0
    for row in rows:
        if held and total + size(row) > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += size(row)
    if held:
        yield held


def _block(part: int, seq: int, start: int, docs: list[tuple[int | None, bytes]], dtype: str) -> pa.RecordBatch:
    width = np.dtype(dtype).itemsize
    ends = np.cumsum([len(b) // width for _, b in docs])
    ef = EliasFano.encode(ends, int(ends[-1]))
    ids = [d for d, _ in docs if d is not None]
    first = ids[0] if ids else 0
    id_ef = EliasFano.encode(np.array(ids, dtype=np.int64) - first, ids[-1] - first if ids else 0)
    row = {"part": part, "seq": seq, "part_start": start, "n_docs": len(docs), "n_ids": int(ends[-1]), "width": width, "ids": b"".join(b for _, b in docs),
           "low_bits": ef.low_bits, "lows": ef.lows, "highs": ef.highs, "hints": ef.hints,
           "n_null": len(docs) - len(ids), "first_id": first, "id_low_bits": id_ef.low_bits, "id_lows": id_ef.lows, "id_highs": id_ef.highs}
    kinds = {"part": pa.int32(), "seq": pa.int32(), "part_start": pa.int64(), "n_docs": pa.int32(), "n_ids": pa.int64(), "width": pa.int32(), "low_bits": pa.int32(), "n_null": pa.int32(), "first_id": pa.int64(), "id_low_bits": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()], names=list(row))


def write_blocks(docs: DataFrame, path: str, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every document and write the folder, in ascending order of the id column."""

    def encoded(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        part, seq, start, held, n, first = TaskContext.get().partitionId(), 0, 0, [], 0, None
        rows = ((i.as_py(), t.as_py() or "") for batch in incoming for i, t in zip(batch.column(0), batch.column(1), strict=True))
        for group in batches(rows, lambda r: len(r[1]) + 100, BATCH_CHARS):
            for (doc_id, _), ids in zip(group, coder.encode([t for _, t in group]), strict=True):
                far = first is not None and doc_id - first >= ID_RANGE
                if held and (n + len(ids) // len(end) + 1 > BLOCK_IDS or len(held) >= BLOCK_DOCS or far):
                    yield _block(part, seq, start, held, coder.dtype)
                    seq, start, held, n, first = seq + 1, start + n, [], 0, None
                first = doc_id if first is None else first
                held.append((doc_id, ids + end))
                n += len(ids) // len(end) + 1
        if held:
            yield _block(part, seq, start, held, coder.dtype)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # rows that repeat an id are dealt by the head of their text, so no task has all of them
    rows.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text").mapInArrow(lean(encoded), BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``block_start``, the ids of all blocks before; one row per part is added up and broadcast, parts being as many as the partitions of the write."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("part_offset"))
    return blocks.join(F.broadcast(offsets), "part").withColumn("block_start", F.col("part_offset") + F.col("part_start")).drop("part_offset")


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the folder, from its files alone."""

    def decoded(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for b in batch.to_pylist():
                found = EliasFano(b["n_docs"], b["low_bits"], b["lows"], b["highs"], b["hints"])
                ends = np.array([found.select(i) for i in range(found.n)])
                ids = EliasFano(b["n_docs"] - b["n_null"], b["id_low_bits"], b["id_lows"], b["id_highs"], b"").decode() + b["first_id"]
                doc_ids = [None] * b["n_null"] + ids.tolist()
                starts = np.concatenate([[0], ends[:-1]])
                raw = memoryview(np.frombuffer(b["ids"], f"<u{b['width']}").astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts + b["block_start"], pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    wanted = ["block_start", "n_docs", "width", "ids", "low_bits", "lows", "highs", "hints", "n_null", "first_id", "id_low_bits", "id_lows", "id_highs"]
    return read_blocks(spark, path).select(*wanted).mapInArrow(lean(decoded), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_boundaries(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the folder below the shared folder and read it back."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_blocks(docs, path, vocabulary)
    return boundaries(spark, path)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_boundaries(table(spark, sf_dir, "documents").select("doc_id", "text"))
