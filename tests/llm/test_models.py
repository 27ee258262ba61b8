"""Near duplicates, decontamination, toxicity, language-model scores and the pipeline."""

import math
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dialoom.llm import decontaminate, jaccard, lm, toxicity
from dialoom.llm.components import components
from tests.llm.helpers import CLASHES, LONG, empty, odd


def brute_classes(docs):
    sets = {i: frozenset(jaccard.shingles(t).tolist()) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (root(i), links[i]) for i in ids}


def near_copies(seed):
    rng = random.Random(seed)
    docs = []
    for base in range(12):
        words = [f"b{base}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 6, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 9])):
            mine = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                mine[rng.randrange(len(mine))] = f"x{rng.randint(0, 9)}"
            docs.append((len(docs), " ".join(mine)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_is_exact(spark, seed):
    docs = near_copies(seed)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs)


@pytest.mark.parametrize("held", [2048, 16])
def test_large_group_goes_through_blocks(spark, monkeypatch, held):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "HELD_ROWS", held)
    base = [f"w{i}" for i in range(100)]
    docs = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(60)]
    docs += [(100 + i, " ".join([*base[: 20 + i], *(f"far{k}" for k in range(i % 7 * 4)), *base[20 + i :]])) for i in range(40)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs)


def test_rows_that_repeat_an_id_are_judged_by_their_text(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    near = lambda w: " ".join([*w[:-1], "other"])
    docs = [(7, " ".join(a)), (7, " ".join(b)), (8, near(a)), (9, near(b)), (7, " ".join(b)), (7, None), (7, ""), (3, "alone"), (3, "alone"), (9, "some more")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(df).collect())
    assert got == sorted([(7, 7, 1), (7, 7, 2), (8, 7, 1), (9, 7, 2), (7, 7, 2), (7, 7, 0), (7, 7, 0), (3, 3, 1), (3, 3, 1), (9, 9, 0)])
    kept = sorted((r["doc_id"], r["text"] or "") for r in jaccard.deduplicate(df).collect())
    assert kept == sorted([(7, " ".join(a)), (7, " ".join(b)), (7, ""), (3, "alone"), (9, "some more")])


def test_rows_without_an_id_are_linked(spark):
    words = [f"w{i}" for i in range(80)]
    docs = [(1, " ".join(words)), (None, " ".join([*words, "zz"])), (None, " ".join([*words, "zz"])), (3, " ".join([*words, "qq"])), (None, "all alone here"), (None, "all alone here")]
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"]) for r in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == [(0, 0, 1), (0, 0, 1), (0, 1, 3), (0, 1, 3), (1, 1, 3), (3, 1, 3)]
    kept = jaccard.deduplicate(spark.createDataFrame(docs, "doc_id long, text string").withColumn("a.b", F.lit("x"))).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 0, 0, 0, 1] and {r["a.b"] for r in kept} == {"x"}


def test_prune_makes_rows_in_proportion_to_a_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    base, made = [f"w{i}" for i in range(200)], {}
    plain = jaccard.prune
    for n in (60, 240):
        counts = []
        monkeypatch.setattr(jaccard, "prune", lambda dealt, counts=counts: (lambda df: counts.append(df.count()) or df)(plain(dealt).persist()))
        docs = [(i, " ".join([*base[: i % 190], f"new{i}", *base[i % 190 + 1 :]])) for i in range(n)]
        jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).count()
        made[n] = sum(counts)
    assert made[240] < 6 * made[60]


def test_pruning_bounds_are_a_posterior():
    for n, least in jaccard.NEEDED:
        p = lambda m, n=n: sum(math.comb(n + 1, j) * 0.8**j * 0.2 ** (n + 1 - j) for j in range(m + 1))
        assert p(least) >= jaccard.TOLERANCE > p(least - 1)


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(101, 100), (102, 101), (100, 102), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def make_index(items, threshold):
    df = Counter(w for _, t in items for w in set(decontaminate.words_of(t)))
    return decontaminate.BlockMaxIndex(items, df, len(items), sum(len(decontaminate.words_of(t)) for _, t in items) / len(items), threshold)


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.6])
def test_wand_finds_all(threshold):
    rng = random.Random(3)
    word = lambda: f"w{min(rng.randint(1, 60), rng.randint(1, 60))}"
    index = make_index([(i, " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(300)], threshold)
    for _ in range(150):
        terms = sorted({index.vocabulary[w] for w in (word() for _ in range(rng.randint(1, 25))) if w in index.vocabulary})
        scores = np.zeros(300)
        for t in terms:
            scores[index.lists[t][0]] += index.lists[t][1]
        want = np.flatnonzero(scores >= index.threshold).tolist()
        assert sorted(i for i, _ in index.search(terms)) == want
        window = np.zeros(len(terms), dtype=np.int64)
        assert index.promising(window, np.array(terms, dtype=np.int64)) or not want


def test_contaminated_documents(spark):
    item = "Which river runs through the old town of Brell? It is the river Onda that runs there."
    filler = " ".join(f"filler{i}" for i in range(500))
    docs = [(1, f"{filler} {item} {filler}"), (2, filler), (3, "Which river runs through the old town of Brell? " + filler), (4, None), (5, ""), (6, item.upper())]
    items = spark.createDataFrame([(10, item), (10, item), (11, None), (12, ""), (13, "the of it is")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 10), (6, 10)}
    assert decontaminate.contaminated(odd(spark), items).isEmpty() and decontaminate.contaminated(empty(spark), items).isEmpty()
    assert decontaminate.contaminated(odd(spark), items.limit(0)).isEmpty()


def test_item_blocks_change_nothing(spark):
    rng = random.Random(5)
    texts = [" ".join(f"t{rng.randint(0, 300)}" for _ in range(25)) for _ in range(30)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(rng.sample(texts, 2))) for i in range(20)], "doc_id long, text string").persist()
    found = lambda size: {(d, k) for index in decontaminate.index_blocks(items, block_chars=size) for d, t in docs.collect() for k in (index.item_ids[i] for i in index.matches(t))}
    assert found(500) == found(10**6) and len(found(10**6)) >= 20


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_levenshtein_automaton_equals_distance():
    rng = random.Random(1)
    lexicon = ["idiot", "stupid", "worthless", "scum", "abcde", "abcdf"]
    trie = toxicity.Lexicon([(w, "w", 1.0) for w in lexicon])
    for _ in range(3000):
        word = list(rng.choice(lexicon))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            rng.choice([lambda w, a: w.insert(a, rng.choice("abcdef")), lambda w, a: w.pop(a) if a < len(w) and len(w) > 1 else None, lambda w, a: w.__setitem__(a, "z") if a < len(w) else None])(word, at)
        word = "".join(word)
        exact, near = trie.lookup(word)
        assert bool(exact) == (word in lexicon)
        if not exact:
            assert bool(near) == (len(word) >= 4 and any(edits(word, w) <= 1 for w in lexicon if len(w) >= 5))


def test_quotation_is_told_from_abuse():
    trie = toxicity.Lexicon([("idiot", "w", 2.0), ("gra", "b", 1.0)])
    assert trie.features("you idiot")[0] == 2.0 and trie.features("you idiott")[4] > 0 and trie.features("graxel")[0] == 1.0
    for text in ('the sign read "an idiot lives here" in red', "er sagte, ein idiot sei da", "„ein idiot“"):
        f = trie.features(text)
        assert f[0] == 0 and f[5] > 0
    assert trie.features(None) == trie.features("") == (0.0,) * 6


def test_toxicity_learns(spark):
    rng = random.Random(2)
    word = lambda: f"n{rng.randint(0, 500)}"
    docs, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        docs.append((i, " ".join([word() for _ in range(30)] + ([rng.choice(["blargh", "snurf", "wexelbad"])] if toxic else []))))
        labels.append((i, int(toxic)))
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(d, y, F.col("doc_id") < 300).collect()}
    assert sum((got[i] >= 0.3) == bool(t) for i, t in labels[300:]) >= 97
    out = toxicity.toxicity(odd(spark).drop("score"), y, F.col("doc_id") < 300).collect()
    assert len(out) == 10 and all(0 <= r["score"] <= 1 for r in out)
    assert len(toxicity.toxicity(d.limit(3), y.limit(0)).collect()) == 3 and toxicity.toxicity(empty(spark), y).isEmpty()


def test_gradient_is_right():
    rng = np.random.default_rng(0)
    flat = rng.standard_normal(lm.N_WEIGHTS).astype(np.float64) * 0.1
    bigram = rng.standard_normal((lm.N_IN, lm.N_OUT))
    into, out = rng.integers(0, lm.N_IN, (3, lm.WINDOW)), rng.integers(0, lm.N_OUT, (3, lm.WINDOW))
    scored = rng.random((3, lm.WINDOW)) < 0.7
    loss = lambda w: -lm.Attention(w, bigram).log_probabilities(into, out, scored).mean()
    g = lm.Attention(flat, bigram).gradient(into, out, scored)
    for i in [*np.argsort(-np.abs(g))[:5], lm.N_WEIGHTS - 5, lm.N_IN * lm.DIM * 2 + 40]:
        step = np.zeros_like(flat)
        step[i] = 1e-5
        assert g[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-5, rel=1e-3, abs=1e-7)


@pytest.mark.parametrize("n", [0, 1, 30, 31, 32, 55, 500])
def test_windows_score_every_target_once(n):
    ids = np.arange(n, dtype=np.int32)
    windows, scored = lm.windows_of(ids)
    assert windows[:, 1:][scored].tolist() == [*ids.tolist(), lm.END]
    later = scored[1:].argmax(axis=1)
    assert (later[scored[1:].any(axis=1)] == lm.OVERLAP).all()


def test_quotations_reach_over_the_whole_line():
    far = "calm words " * 40
    tries = toxicity.Lexicon([("idiot", "w", 3.0)])
    said = {f'"{far}" then "{far}" you idiot': 0, f'{far} "{far} idiot {far}" {far}': 1, f"„{far} idiot {far}“ {far}": 1, f"„{far}“ idiot „{far}“": 0, f"«{far}» idiot": 0, '"open\nidiot"': 0, f"“{far} ‹a› idiot {far}”": 1}
    for text, quoted in said.items():
        f = tries.features(text)
        assert (f[5] > 0, f[0] > 0) == (quoted == 1, quoted == 0), text[-30:]


def test_every_window_is_trained_on(spark):
    texts = ["one two three", None, "", *(f"short text {i}" for i in range(40)), " ".join(f"w{i}" for i in range(300))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    vocabulary = None
    kept = [r["window"] for r in lm.count_pass(df, vocabulary).filter("kind = 2").select("window").collect()]
    every = [lm.windows_of(x) for x in lm.word_ids(vocabulary).encode([lm.words_of(t) for t in texts])]
    assert sorted(kept) == sorted(w[k].astype("<u2").tobytes() + m[k].astype("u1").tobytes() for w, m in every for k in range(len(w)))
    rng = np.random.default_rng(0)
    groups = [(rng.integers(0, lm.N_IN, (n, lm.WINDOW)), rng.integers(0, lm.N_OUT, (n, lm.WINDOW)), np.ones((n, lm.WINDOW), bool)) for n in (70, 5)]
    flat, seen = lm.train_shard(lm.first_weights(), np.zeros((lm.N_IN, lm.N_OUT), np.float32), iter(groups), 0)
    assert seen == 75 and flat.dtype == np.float32 and np.isfinite(flat).all() and not np.array_equal(flat, lm.first_weights())


def test_probabilities_add_up():
    rng = np.random.default_rng(1)
    counts = np.zeros(lm.VOCABULARY)
    counts[rng.integers(0, lm.VOCABULARY, 4000)] += 1
    classes = lm.Classes(counts, rng.random(lm.VOCABULARY) < 0.5)
    classes.learn_pairs(rng.integers(0, 2, (lm.N_IN, lm.N_IN)).astype(float))
    model = lm.Attention(lm.first_weights(), classes.bigram)
    before = np.full(lm.VOCABULARY, 17)
    h = model.hidden(np.full((1, lm.WINDOW), classes.into[17]))[-1][0, 0]
    logits = h @ model.w["out"] + classes.bigram[classes.into[17]]
    logits -= logits.max()
    by_class = logits - np.log(np.exp(logits).sum())
    every = np.arange(lm.VOCABULARY)
    total = np.exp(by_class[classes.out[classes.into[every]]] + classes.rest(before, every)).sum()
    assert total == pytest.approx(1.0, abs=2e-3)


def test_contexts_are_those_of_the_words():
    coder = lm.word_ids(None)
    words = [b"w%d" % i for i in range(400)]
    twice = [*words, b"other", *words]
    (ids,) = coder.encode([twice])
    where, before, follows = lm.contexts(ids, np.append(coder.lengths(twice), 1))
    assert 0 < len(where) < 400 and (where >= lm.ORDER).all()
    by = {}
    for k, c, f in zip(where.tolist(), before.tolist(), follows.tolist(), strict=True):
        by.setdefault((tuple(twice[k - lm.ORDER : k]), twice[k] if k < len(twice) else None), set()).add((c, f))
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    assert len(lm.contexts(ids[:0], np.array([1]))[0]) == 0


def test_large_logits_stay_finite():
    model = lm.Attention(lm.first_weights(), np.full((lm.N_IN, lm.N_OUT), 3e4, np.float32))
    into = np.zeros((2, lm.WINDOW), int)
    assert np.isfinite(model.log_probabilities(into, into, np.ones((2, lm.WINDOW), bool))).all()


@pytest.mark.parametrize("few", [100_000, 10])
def test_repeated_documents_are_remembered(spark, monkeypatch, few):
    from dialoom.llm import common

    monkeypatch.setattr(common, "FEW_ROWS", few)
    rng = random.Random(6)
    said = lambda: " ".join(f"w{rng.randint(0, 3000)}" for _ in range(200))
    once, twice = [said() for _ in range(40)], [said() for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate([*once, *twice, *twice, twice[0]])), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in lm.lm_scores(docs, F.col("doc_id") == 50).collect()}
    assert max(got[i] for i in range(40)) < min(got[i] for i in range(40, 51))


def test_chains_are_short_and_thin():
    rng = np.random.default_rng(3)
    ids = np.sort(rng.choice(1 << 40, 3000, replace=False))
    shuffled = rng.permutation(ids[:2500])
    edges = jaccard.chains(np.concatenate([shuffled[1:], ids[2501:]]), np.concatenate([shuffled[:-1], ids[2500:-1]]))
    over = dict(edges.tolist())
    assert len(over) == len(edges) == 2499 + 499 and all(a > b for a, b in over.items())
    for i in ids.tolist():
        steps = 0
        top = i
        while top in over:
            top, steps = over[top], steps + 1
        assert top == ids[0 if i <= ids[2499] else 2500] and steps <= 4
    assert np.unique(edges[:, 1], return_counts=True)[1].max() <= jaccard.FAN
    assert len(jaccard.chains(ids[:0], ids[:0])) == 0


@pytest.mark.parametrize("few", [100_000, 10])
def test_every_context_is_remembered(spark, monkeypatch, few):
    """Texts of five words have two contexts; all of them count, also those that are in the memory as hubs."""
    from dialoom.llm import common

    monkeypatch.setattr(common, "FEW_ROWS", few)
    texts = [" ".join(f"w{5 * i + k}" for k in range(5)) for i in range(24)]
    texts = [*texts, *texts, *(f"x{i} y{i} z{i} u{i} v{i}" for i in range(10))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = lm.context_memory(docs, None, 6 * len(texts))[0].select("known", "hubs").collect()
    known = [x for r in held for part in (r["known"], r["hubs"]) for x in zip(*(c.tolist() for c in lm.split(part, lm.KNOWN)), strict=True)]
    assert len(known) == 48 and all(x[3] == pytest.approx(lm.TRUST) for x in known) and any(r["hubs"] for r in held) == (few == 10)
    with_memory = {r["doc_id"]: r["score"] for r in lm.lm_scores(docs, F.lit(False)).collect()}
    monkeypatch.setattr(lm, "TRUST", 0.0)
    without = {r["doc_id"]: r["score"] for r in lm.lm_scores(docs, F.lit(False)).collect()}
    assert all(with_memory[i] - without[i] > 0.5 for i in range(48))
    assert all(with_memory[i] == pytest.approx(without[i], abs=1e-3) for i in range(48, 58))


def test_base_scores_and_odd_rows(spark):
    docs = [(i, f"The cat {i % 3} sat\ton the MAT é{i}") for i in range(60)] + [(100, None), (101, ""), (102, LONG)]
    got = {r["doc_id"]: r for r in lm.lm_scores(spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("clash")), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2).collect()}
    words = {i: [w.lower() if w.isascii() else w for w in (t or "").split()] + ["\n"] for i, t in docs}
    train = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(train.values()), len(train)
    for i, ws in words.items():
        assert got[i]["train_tokens"] == n and got[i]["n_tokens"] == len(ws) and got[i]["n_known"] == sum(train[w] > 0 for w in ws)
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws))
        assert got[i]["score"] < 0
    assert lm.lm_scores(empty(spark), F.lit(False)).isEmpty()


def test_pipeline_stages_on_odd_and_empty_tables(spark, monkeypatch):
    """Clashing columns come back with the values of the input; null, empty, long and repeated rows pass every stage."""
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, d, name: spark.createDataFrame([(1, "which river runs here, the Onda river")], "item_id long, text string"))
    for make in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = make(spark)
            out = stage(spark, docs, "")
            rows = out.collect()
            assert make is odd or not rows, name
            if name != "token_output":
                assert out.columns == docs.columns, name
                assert all(r[c] == "clash" for r in rows for c in CLASHES if c in out.columns), name


def test_labels_other_than_two_are_none(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7} words") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, (0, 1, 5, None)[i % 4]) for i in range(60)], "doc_id long, toxic int")
    plain = toxicity.learn(docs, labels.filter("toxic in (0, 1)"))
    assert toxicity.learn(docs, labels) == plain


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from dialoom.llm import mixing, quality
    from dialoom.llm.common import table

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        before, docs = docs, stage(spark, docs, sf).persist()
        assert docs.columns == before.columns, name
        ids = [r["doc_id"] for r in docs.collect()]
        if k == 0:
            kept = {i for i, r in rows.items() if (lambda m: m[0] >= 50 and 100 * m[5] <= 50 * m[0] and 5 * m[2] <= m[0] and 2 * m[4] <= m[3])(quality.measure(r["text"]))}
        elif k == 1:
            kept = {i for i, (c, _) in brute_classes([(i, rows[i]["text"]) for i in kept]).items() if c == i}
        elif k == 2:
            items = [set(zip(*[w[j:] for j in range(5)], strict=False)) for r in table(spark, sf, "benchmark").collect() if len(w := decontaminate.words_of(r["text"])) >= 5]
            held = lambda t: (lambda w: set(zip(*[w[j:] for j in range(5)], strict=False)))(decontaminate.words_of(t))
            kept = {i for i in kept if not any(len(g & held(rows[i]["text"])) >= 0.9 * len(g) for g in items)}
        else:
            most = Counter(ids)
            assert set(most) <= kept and max(most.values()) <= mixing.MAX_RATE
            continue
        assert set(ids) == kept and len(ids) == len(kept), name
    out = corpus_pipeline.STAGES[4][1](spark, docs, sf)
    assert out.count() == docs.count() and out.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == out.agg(F.sum("n_tokens")).first()[0]


def test_texts_in_a_row_are_cut_like_single_ones(monkeypatch):
    monkeypatch.setattr(lm, "GROUP_IDS", 300)
    rng = random.Random(4)
    said = [" ".join(rng.choice(["a", "the", "Onda", "unpronounceably-strange-token-xyzzy", "é" * 9, "12345678901"]) for _ in range(n)) for n in (0, 1, 4, 5, 60, 0, 200, 3)]
    coder, docs = lm.word_ids(None), [lm.words_of(t) for t in said]
    ids = coder.encode(docs)
    column = pa.array([b"?", *(np.append(x, lm.END).astype("<u2").tobytes() for x in ids)], pa.binary())[1:]
    windows, scored, contexts, counts = [], [], [], Counter()
    for lo, hi, texts in lm.texts_of(column):
        texts.split_into_words(coder.coder.opens)
        assert texts.n_words.tolist() == [len(d) + 1 for d in docs[lo:hi]]
        key, long = texts.words()
        counts.update(texts.spelled(long))
        counts.update(x.tobytes() for x in np.delete(key, long))
        for out, found in zip((windows, scored), texts.windows(), strict=True):
            out += found.tolist()
        contexts += list(zip(*(x.tolist() for x in texts.contexts()[1:]), strict=True))
    each = [lm.windows_of(x) for x in ids]
    assert windows == [w for x, _ in each for w in x.tolist()] and scored == [s for _, x in each for s in x.tolist()]
    by_text = [lm.contexts(x, np.append(coder.lengths(d), 1), None) for x, d in zip(ids, docs, strict=True)]
    assert contexts == [(c, f) for _, before, follows in by_text for c, f in zip(before.view(np.uint64).tolist(), follows.astype(np.uint32).tolist(), strict=True)]
    assert sorted(counts.values()) == sorted(Counter(w for d in docs for w in [*d, b"\n"]).values()) and counts[lm.END_KEY] == len(docs)


def test_texts_are_encoded_once(spark, tmp_path):
    """One pass reads the texts; counting, training, the memory and scoring read their ids."""

    def noted(incoming):
        for batch in incoming:
            (tmp_path / uuid.uuid4().hex).write_text(str(batch.num_rows))
            yield batch

    docs = spark.createDataFrame([(i, f"text number {i % 7} of a few") for i in range(30)], "doc_id long, text string").mapInArrow(noted, "doc_id long, text string")
    assert len(lm.lm_scores(docs, F.col("doc_id") == 5).collect()) == 30
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == 30
