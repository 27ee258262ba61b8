"""Importance resampling, repeated byte strings and tokenizer alignment against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import align, repeats, resample
from tests.llm.helpers import empty, odd

DOCS = "doc_id long, text string"


def hashed(doc_id) -> int:
    return int(hashlib.sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)


def brute_resample(docs, target, percent=10, least=20):
    words = lambda t: re.findall(resample.WORD, (t or "").translate(str.maketrans(resample.UPPER, resample.LOWER)))
    bucket = lambda w: zlib.crc32(w.encode()) % 10_000
    s, t = (Counter(bucket(w) for x in texts for w in words(x)) for texts in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    rows = []
    for doc_id, text in docs:
        found = words(text)
        weight = sum(gain(bucket(w)) for w in found)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((hashed(doc_id) + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0], r[1]))
    return rows, able[: percent * len(able) // 100]


def test_resampling_equals_brute_force(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(rng.choice(["Öl", "AB", "x9", "the", "cat", "日本", "end."]) for _ in range(rng.randint(0, 60)))) for k in range(400)]
    docs += [(7, docs[7][1]), (7, "other words " * 15), (None, "no id " * 20), (None, "no id " * 20), (900, None), (901, "")]
    target = ["the cat", None, "AB ab aB"]
    rows, drawn = brute_resample(docs, target)
    out = resample.resample(spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame([(x,) for x in target], "text string")).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in out), key=key) == sorted(rows, key=key)
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in sorted((r for r in out if r.rank), key=lambda r: r.rank)] == drawn
    assert sorted(r.rank for r in out if r.rank) == list(range(1, len(drawn) + 1))


def test_resampling_ties_and_small_tables(spark):
    same = spark.createDataFrame([(k % 3, "word " * 25) for k in range(90)], DOCS)  # three scores, thirty rows each
    out = resample.resample(same, same, percent=50).collect()
    assert sorted(r.rank for r in out if r.rank) == list(range(1, 46))
    best = [r.doc_id for r in sorted((r for r in out if r.rank), key=lambda r: r.rank)]
    assert best == sorted(best, key=lambda d: (-max(r.score for r in out if r.doc_id == d), d))
    few = spark.createDataFrame([(1, "word " * 25)], DOCS)
    assert [r.rank for r in resample.resample(few, few).collect()] == [None]
    assert resample.resample(empty(spark), few).collect() == []
    assert resample.resample(odd(spark), odd(spark)).count() == odd(spark).count()


def test_runs_of_several_words(spark):
    row = spark.createDataFrame([("A b, c",), ("x",), (None,)], "text string")
    assert [sorted(r[0]) for r in row.select(resample.features(F.col("text"), 2)).collect()] == [["a", "a b", "b", "b c", "c"], ["x"], []]


def test_smallest_sufficient_value(spark):
    values = [(v,) for v in [5, 5, 5, -(1 << 62), 1 << 61, 7, 7, 9]]
    rows, order = spark.createDataFrame(values, "v long"), sorted(v for v, in values)
    assert [resample.smallest_with(rows, F.col("v"), k + 1) for k in range(len(order))] == order


def brute_repeats(docs, length=50):
    first = {}
    for doc_id, text in docs:
        raw, own = (text or "").encode(), -(1 << 63) if doc_id is None else doc_id
        for p in range(len(raw) - length + 1):
            first[raw[p : p + length]] = min(own, first.get(raw[p : p + length], own))
    out = []
    for doc_id, text in docs:
        raw, own, spans = (text or "").encode(), -(1 << 63) if doc_id is None else doc_id, []
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < own:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        out.append((doc_id, len(raw), tuple(map(tuple, spans)), b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(raw)], strict=True))))
    return out


def repeated_docs():
    rng = random.Random(3)
    words = ["alpha", "béta", "γ", "delta delta", "\n", "zz", "12345", "日本語"]
    said = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(n))
    passage, docs = said(40), []
    for k in range(60):
        docs.append((k, said(rng.randint(0, 30)) + (passage[rng.randint(0, 60) :] if k % 2 else "") + said(rng.randint(0, 30))))
    docs += [(k + 100, docs[k][1]) for k in range(0, 60, 7)] + [(5, said(30)), (5, docs[5][1]), (200, "a" * 700), (201, "b" + "a" * 400), (202, None), (203, ""), (None, docs[9][1]), (None, passage)]
    docs += [(300, "x" * 49), (301, "x" * 50), (302, "y" + "x" * 50), (303, docs[3][1] * 3)]
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_repeats_equal_brute_force(spark, monkeypatch, small):
    if small:  # parts, packs and crowds of a few rows; each partition settles little by itself
        for name, value in (("PART", 200), ("HELD", 500), ("CROWD", 2), ("BUCKET_BYTES", 300)):
            monkeypatch.setattr(repeats, name, value)
    docs = repeated_docs()
    out = repeats.without_repeats(spark.createDataFrame(docs, DOCS).repartition(9)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3])
    assert sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in out), key=key) == sorted(brute_repeats(docs), key=key)


@pytest.mark.parametrize("length", [7, 20])
def test_other_lengths(spark, length):
    docs = repeated_docs()[:30]
    out = repeats.without_repeats(spark.createDataFrame(docs, DOCS), length).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in out) == sorted((d, k) for d, _, _, k in brute_repeats(docs, length))


def test_repeats_odd_rows(spark):
    assert repeats.without_repeats(odd(spark)).count() == odd(spark).count()
    assert repeats.without_repeats(empty(spark)).collect() == []


def test_planes_round_trip():
    values = np.array([5, 5, 0, 1 << 30, 7], dtype=np.int32)
    assert repeats.unplaned(repeats.planes(values)).tolist() == values.tolist()
    wide = np.array([0, 1, (1 << 48) - 1], dtype=np.uint64)
    assert repeats.widened(repeats.cut_to(wide, 6), 6).tolist() == wide.tolist()


def brute_align(docs):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters, rows, counts = align.byte_letters(), [], Counter()
    for doc_id, text in docs:
        text = text or ""
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids if text else [], b_side.encode(text) if text else []
        spelled = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a], [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_side.id_to_piece(i)) for i in b)]
        if any(b"".join(s) != (" " + text).encode() for s in spelled):
            a, b, spelled = [], [], ([], [])
        ends = [np.cumsum([len(x) for x in s], dtype=int).tolist() for s in spelled]
        links, groups, x0, y0 = [], [], 0, 0
        for x, end in enumerate(ends[0]):
            if end in ends[1]:
                y = ends[1].index(end)
                links.append((a[x], b[y]))
                groups.append(",".join(map(str, a[x0 : x + 1])) + "|" + ",".join(map(str, b[y0 : y + 1])))
                x0, y0 = x + 1, y + 1
        counts.update(links)
        rows.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(d, a, b, len(k), len(k), sum(counts[p] == best[p[1]] for p in k), sum(counts[p] for p in k), h) for d, a, b, k, h in rows], counts


ALIGN_DOCS = [(1, "The quick brown fox"), (2, "  two  spaces\tand\nlines "), (3, "naïve café 日本語 😀"), (4, "a<|endoftext|>b <s> </s>"), (5, "a▁b loses its sign"), (6, None), (7, ""), (8, " "), (None, "The quick"), (1, "The quick brown fox"), (9, "x" * 900 + " " + "word " * 200), (10, "don't stop\r\n\r\nNOW 12345 ++ \x00 end")]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_brute_force(spark, monkeypatch, small):
    if small:  # many segments, an index that no task may hold whole
        monkeypatch.setattr(align, "SEGMENT", 8)
        monkeypatch.setattr(align, "INDEX_BYTES", 400)
    rows, counts = brute_align(ALIGN_DOCS)
    out, pairs = align.align(spark.createDataFrame(ALIGN_DOCS, DOCS).repartition(5))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(rows, key=key)
    assert {(r.a_id, r.b_id): r["count"] for r in pairs.collect()} == dict(counts)


def test_alignment_odd_rows(spark):
    assert align.align(odd(spark))[0].count() == odd(spark).count()
    out, pairs = align.align(empty(spark))
    assert out.collect() == [] and pairs.collect() == []
    assert [tuple(r)[1:] for r in align.align(spark.createDataFrame([(1, None)], DOCS))[0].collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 5000, dtype=np.uint64))
    levels, words, order = align.build(keys)
    found = align.PerfectHash([{"segment": 0, "levels": levels, "words": words, "keys": order.astype("<u8").tobytes()}])
    places = found.placed(keys, np.zeros(len(keys), dtype=np.int64))
    assert sorted(places.tolist()) == list(range(len(keys))) and (order[places] == keys).all()
    assert (found.placed(keys + np.uint64(1 << 50), np.zeros(len(keys), dtype=np.int64)) == -1).all()
    assert len(words) * 8 < 4 * len(keys)


def test_passes_over_ids_hold_no_tokenizers():
    from dialoom.llm import tokens

    spelled = align.spellings()
    one, other = tokens.encoder(None, True), align.piece_encoder()
    before = [one.encode([" some words of a text"]), other.encode([" some words of a text"])]
    assert one.powers is other.powers and len(one.powers[0][0]) > 1
    assert list(align.laid(iter([]), spelled)) == []
    assert not tokens._ENCODERS and not align._LOADED and len(tokens.Encoder.powers[0][0]) == 1
    assert before == [tokens.encoder(None, True).encode([" some words of a text"]), align.piece_encoder().encode([" some words of a text"])]
