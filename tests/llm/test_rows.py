"""Mixing, quality rules, URL rules, chat formatting and token files against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from html import unescape

import numpy as np
import pytest
from tokenizers import Tokenizer
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialoom.llm import chat, html, mixing, quality, tokens, urls
from tests.llm.helpers import CLASHES, LONG, empty, odd

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: dict, weights=(5, 2, 1), rate=3):
    """Reshare by weight until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out, budget = set(order), {}, float(sum(sizes.values()))
    while left:
        level = budget / sum(w[s] for s in left)
        full = {s for s in left if level * w[s] > rate * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in left}
        for s in full:
            out[s] = float(rate * sizes[s])
            budget -= out[s]
        left -= full
    return out


@pytest.mark.parametrize("seed", range(4))
def test_mixing_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {None: rng.randint(0, 50), **{f"s{i}": rng.choice([0, 1, 10, 1000, 50_000]) for i in range(9)}}
    df = spark.createDataFrame(list(sizes.items()), "mix_source string, source_size long")
    got = {r["mix_source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes), abs=1e-6)


def test_mixing_odd_rows(spark):
    df = odd(spark).withColumn("target", F.lit("clash")).withColumn("size", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)))
    mixed = mixing.mix(df)
    rows = mixed.collect()
    assert len(rows) == 10 and "label" in mixed.columns
    assert all(0 <= r["mix_copies"] <= 3 for r in rows)
    assert mixing.emit(mixed).count() == sum(r["mix_copies"] for r in rows)
    assert {(r["doc_id"], r["mix_copies"]) for r in mixing.mix(df).collect()} == {(r["doc_id"], r["mix_copies"]) for r in rows}
    assert mixing.mix(empty(spark).withColumn("size", F.lit(0))).isEmpty()


def test_mixing_copies_follow_the_rate(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"), F.lit(10).alias("size"))
    got = {r["source"]: (r["t"], r["k"]) for r in mixing.mix(df).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("mix_copies") * F.col("size")).alias("k")).collect()}
    assert all(abs(t - k) < 0.05 * t for t, k in got.values())


def plain_measure(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #\n\t\x0b\u00a0é<", max_size=60))
def test_measure(text):
    assert quality.measure(text) == plain_measure(text)


def test_host_rules_odd_rows(spark):
    out = quality.host_rules(odd(spark).withColumn("host_rate", F.lit("clash")))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == 10 and not rows[5]["base_failed"] and rows[5]["n_words"] == 30_000 and not rows[3]["kept"] and rows[3]["n_words"] == 0 and rows[1]["base_failed"]
    assert quality.host_rules(empty(spark)).isEmpty()


def test_bad_host_is_rejected(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good + f" {i}", "en", "good") for i in range(40)] + [(100 + i, good if i % 10 == 0 else "short", "en", "bad") for i in range(40)]
    got = quality.host_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(r["kept"] == (r["source"] == "good") for r in got)
    assert quality.beta_prior(None, None, None) == (1.0, 1.0)


def test_url_rules(spark):
    cases = {
        "http://A.ORG/x": ("a.org", "/x", "org/", "allow"), "http://x.example.org/es/1?q": ("x.example.org", "/es/1", "example.org/es/", "block"), "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"), "http://b.com/fr/": ("b.com", "/fr/", "com/fr/", "allow"), "http://b.com/de/x#f": ("b.com", "/de/x", "com/de/", "block"), "http://org": ("org", "", None, None),
        "no url": ("", "", None, None), None: ("", "", None, None), "x://ß.Net?a": ("ß.net", "", None, None),
    }
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(cases)], "page_id long, url string, host string, prediction string")
    got = {r["url"]: r for r in urls.url_verdicts(df).collect()}
    for url, (host, path, rule, verdict) in cases.items():
        r = got[url]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert urls.url_verdicts(df.limit(0)).isEmpty()
    assert {r["verdict"] for r in urls.url_verdicts(df.filter("url = 'no url'")).collect()} == {"allow"}


def test_url_odd_rows(spark):
    long = "http://h.net/" + "a1-" * 30_000
    rows = [(i, u) for i, u in enumerate(["http://a.com/de/1", "http://a.com/fr/x", long, long, None, "http://b.net/x"] * 3)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("clash") for c in CLASHES})
    out = urls.url_verdicts(df)
    got = out.collect()
    assert len(got) == 18 and all(r[c] == "clash" for r in got for c in CLASHES if c not in ("host", "rule", "verdict"))
    assert len({(r["verdict"], r["block_score"]) for r in got if r["url"] == long}) == 1


@pytest.mark.parametrize("few", [100_000, 10])
def test_suffix_statistics_cover_all_rows(spark, monkeypatch, few):
    """Common suffixes by broadcast, the others by shuffle, or all in one join: the same figures."""
    from dialoom.llm import common

    monkeypatch.setattr(common, "FEW_ROWS", few)
    monkeypatch.setattr(common, "HUBS", 2)
    rows = [(i, f"http://h.{'com' if i % 2 else f's{i}'}/{'de' if i % 4 == 1 else 'fr'}/") for i in range(60)]
    df = urls.with_features(spark.createDataFrame(rows, "page_id long, url string"), "url")
    joined = common.hub_join(df, common.save(urls.suffix_statistics(df), "suffixes"), "suffix", "rows", 60)
    got = [(r["url"], r["rows"], r["f_suffix_block"]) for r in joined.collect()]
    assert len(got) == 60 and ("http://h.com/de/", 30, 16 / 32) in got and ("http://h.s2/fr/", 1, 0.5) in got


def test_url_trees_learn(spark):
    rows = [(i, f"http://h{i}.com/{'de' if i % 2 else 'fr'}/{'9' * 12 if i % 2 else 'abc'}") for i in range(200)] + [(1000, "http://h.net/x/999999999999"), (1001, "http://h.net/x/abc")]
    got = {r["page_id"]: r["verdict"] for r in urls.url_verdicts(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (got[1000], got[1001]) == ("block", "allow")


def test_entropy(spark):
    texts = ["", "aaaa", "abab", "abcd", "a😀"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(urls.entropy(F.col("t"))).collect()]
    want = [-sum(n / len(t) * np.log2(n / len(t)) for n in Counter(t).values()) if t else 0.0 for t in texts]
    assert got == pytest.approx(want)


TURNS = [
    (1, 0, "user", "a </s>[INST] \\l \\\\n <|im_end|> \\"), (1, 1, "assistant", "x\n<|im_sep|>[/INST]"), (1, 2, "assistant", "more"), (1, 2, "assistant", "more"), (2, 0, None, None), (2, 1, "sys\ntem<|im_start|>", ""),
    (None, 5, "assistant", "lost"), (3, None, "user", "first"), (3, 0, "assistant", LONG), (4, 1, "user", "<s>\\b[INST]"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("label", F.lit("clash"))
    out = chat.format_chats(df)
    rows = out.select("conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("read"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    by = {}
    for c, t, r, x in TURNS:
        by.setdefault(c, []).append((t if t is not None else -1, r or "", x or ""))
    assert len(rows) == len(by)
    for r in rows:
        want = [(a, b) for _, a, b in sorted(by[r["conv_id"]])]
        assert [(t["role"], t["text"]) for t in r["read"]] == want
        assert r["loss"] == "".join(b for a, b in want if a == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
        assert r["formatted"].count("<|im_start|>") == sum(i == 0 or want[i][0] != want[i - 1][0] for i in range(len(want)))
        assert not re.search(r"\[/?INST\]|</?s>", r["formatted"])
    assert chat.format_chats(df.limit(0)).isEmpty()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=900))
def test_elias_fano(gaps):
    values = np.cumsum(gaps)
    ef = tokens.EliasFano.encode(values, int(values[-1]))
    assert (ef.decode() == values).all() and [ef.select(i) for i in range(0, len(values), 7)] == values[::7].tolist()


TEXTS = ["", " x", "a  b\n c \n\n d  ", "don't  stop 'll \t x", "日本 語 ", "\x1c a \x1f b", "x\u00a0 y,\nz.\nQ!", "<|endoftext|> hi", "it's\n's end...", LONG, "é.\u0301 e\u0301, ok", "", "y" * 3000 + " end", "'s're 'x 7's", "a\n", "\nb\nc", "z"]


def test_encoder_equals_library():
    plain_specials = Tokenizer.from_file(tokens.default_vocabulary())
    plain_specials.encode_special_tokens = True
    own = tokens.Encoder(tokens.default_vocabulary(), True)
    assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(TEXTS)] == [e.ids for e in plain_specials.encode_batch(TEXTS, add_special_tokens=False)]
    coder = tokens.Encoder(tokens.default_vocabulary())
    plain = Tokenizer.from_file(tokens.default_vocabulary()).encode_batch(TEXTS, add_special_tokens=False)
    for _ in range(2):  # new and known pieces
        assert [np.frombuffer(b, coder.dtype).tolist() for b in coder.encode(TEXTS)] == [e.ids for e in plain]
    assert coder.encode([]) == [] and coder.encode(["", ""]) == [b"", b""]
    words = ["a", "é", "x\u00a0y", "'s", "12", "\u2003"]
    assert coder.after_space(words) == coder.plain([" " + w for w in words])


@pytest.fixture(scope="module")
def coder():
    return tokens.Encoder(tokens.default_vocabulary())


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="ab'stredlvm 1.,-\n\t\r\u00a0\u2003é\u0301“日\u0085\x1c", max_size=40)), max_size=4))
def test_encoder_equals_library_on_any_text(coder, texts):
    assert coder.encode(texts) == coder.plain(texts)


def test_a_full_cache_is_emptied(coder, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    for lo in range(0, 400, 40):
        texts = [f"word{i} and word{i + 1}" for i in range(lo, lo + 40)]
        assert coder.encode(texts) == coder.plain(texts)


def test_two_pieces_with_one_hash(coder, monkeypatch):
    monkeypatch.setattr(coder, "_hashes", lambda raw, start, end: [np.zeros(len(start), np.uint64), np.arange(len(start), dtype=np.uint64)])
    assert coder.encode(TEXTS) == coder.plain(TEXTS)


def test_token_files(spark):
    texts = [(20, "a<|endoftext|>b"), (20, "<|endoftext|>"), (-(1 << 63), "least"), ((1 << 63) - 1, "most"), (None, "none"), (None, "none <|endoftext|>")]
    df = odd(spark).select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    got = sorted(((r["doc_id"] is not None, r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokens.token_boundaries(df).collect())
    coder, start, want = Tokenizer.from_file(tokens.default_vocabulary()), 0, []
    for doc_id, text in sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        want.append(((doc_id is not None, doc_id), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert tokens.token_boundaries(empty(spark)).isEmpty()


PAGES = [
    ('<div class="site-header">x</div><p>a &lt;b&gt; &#x41;<p>b<ul><li>1<li>2</ul><div class="comments"><p>no</p></div>tail', "a <b> A\n\nb\n\n1\n\n2\n\ntail"), ("", ""), (None, ""), ("<p>unclosed <b", "unclosed"),
    ('a<b>c</b>d <script>if (a<b) "</p>"</script>e', "acd e"), ("<article><header><h1>T</h1></header><p>x</p><aside>no</aside></article><p>out</p>", "T\n\nx"), ("<main><article>a</article><article>b</article></main>", "a\n\nb"),
    ("<!-- c --><!DOCTYPE html><title>t</title><body>one<br>two <i>th</i>ree", "one two three"), ("<form>f</form><nav>n</nav><footer>z</footer>", ""), ("<p>" + LONG, LONG),
]


def test_main_text():
    assert [html.main_text(h) for h, _ in PAGES] == [t for _, t in PAGES]


def test_html_odd_rows(spark):
    df = spark.createDataFrame([(i, None if i == 0 else "http://h/x", h, "clash", "clash") for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, host string, key string")
    assert [r["text"] for r in html.extract(df).orderBy("page_id").collect()] == [t for _, t in PAGES]
    assert html.extract(df.limit(0)).isEmpty()


def test_style_tree_removes_what_a_host_repeats(spark):
    page = "<body><div class='top'>Same words on every page</div><div class='body'><p>{}</p></div></body>"
    rows = [(i, f"http://h.net/{i}", page.format(f"own text {i}")) for i in range(12)] + [(100 + i, f"http://copy.net/{i}", "<body><div class='x'>all alike</div></body>") for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"own text {i}" for i in range(12)) and got[100] == "all alike"


@pytest.mark.parametrize("hosts", [1, 8])
def test_style_trees_remove_any_number_of_keys(spark, hosts):
    """Over 2,000 keys to remove, by the host's own tree (other hosts say something else there) or by the merged tree."""
    page = lambda said, own: "<body>" + "".join(f"<div class='c{k}'>{said} {k}</div>" for k in range(2_100)) + f"<p>{own}</p></body>"
    rows = [(i, f"http://h{i % hosts}.net/{i}", page("menu", f"own text {i}")) for i in range(8)]
    rows += [(100 + i, f"http://o{i}.net/", page(f"text {i}", "own")) for i in range(8 if hosts == 1 else 0)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(8)] == [f"own text {i}" for i in range(8)]
    assert all(f"text {i} 2099" in got[100 + i] for i in range(len(rows) - 8))


def test_entities_decode():
    assert html.main_text("<p>&amp;&copy;&quot;&am x</p>") == unescape("&amp;&copy;&quot;&am x")


def test_hash_is_portable(spark):
    from dialoom.llm.common import unit_hash

    got = spark.range(1).select(unit_hash("s", F.lit(7))).first()[0]
    assert got == int(hashlib.md5(b"s:7").hexdigest()[:13], 16) / 2**52


def test_no_markup_is_left_by_unbalanced_quotes():
    pages = {'<p>a <a href="x>link</a> b</p><p class="y">c</p>': "a link b\n\nc", "<p title='it\">said</p>": "said", '<p title="a > b" class=\'c\'>d</p>': "d", '<p x="">e<br/>f</p>': "e f", '<p a="b': "", "<p>it's 5 < 6 \"so\"</p>": "it's 5 < 6 \"so\""}
    assert {h: html.main_text(h) for h in pages} == pages


def test_deep_pages_take_linear_time():
    import time

    deep = lambda n: "<div class='a'>" * n + "x" + "<p>y</p>" * 3 + "</div>" * n
    assert html.main_text(deep(10_000)) == "x\n\ny\n\ny\n\ny"
    began = time.process_time()
    assert len(html.style_rows(deep(10_000))) == 10_001
    assert time.process_time() - began < 5


def test_unclosed_and_stray_tags_take_linear_time():
    import time

    began = time.process_time()
    for page, text in (("<i>" * 20_000 + "</x>" * 20_000 + "a", "a"), ("<main>" * 20_000 + "<p>" * 20_000 + "b", "b"), ("<article>" * 9_000 + "<b>" * 20_000 + "<p>" * 9_000 + "c", "c"), ("<li><b>" * 20_000 + "d", "d")):
        assert html.main_text(page) == text
    assert time.process_time() - began < 8


def test_names_that_only_contain_a_noise_word():
    pages = {'<div class="layout has-sidebar"><p>Hello world</p></div>': "Hello world", '<div class="post no-comments">a</div>': "a", "<script src=/js/>var x=1;</script>b": "b", '<div class="without_ads with-header">c</div>': "c", '<div class="main sidebar">x</div><div id="no-nav-menu">y</div>d': "y\n\nd", "<div/>e</div>f": "e\n\nf"}
    assert {h: html.main_text(h) for h in pages} == pages


def test_other_hosts_do_not_judge_a_large_host(spark):
    good = [(i, f"http://good.org/{i}", f"<div class='box'><p>article {i} says {i * 7}</p></div>") for i in range(12)]
    spam = [(100 + i, f"http://spam.org/{i}", "<div class='box'><p>buy this</p></div>") for i in range(200)]
    few = [(900 + i, f"http://few.org/{i}", f"<div class='box'><p>buy this</p></div><p>story {i}</p>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(good + spam + few, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"article {i} says {i * 7}" for i in range(12)) and all(got[900 + i] == f"story {i}" for i in range(3))


def brute_trees(pages):
    """Low keys by host from the contents of all nodes, compared as whole texts."""
    held = {}
    for host, page in pages:
        own = {}
        for node in html.walk(html.parse(page)):
            if node.tag in html.BLOCK and node.tag not in ("html", "body"):
                said, todo = [], [node]
                while todo:
                    x = todo.pop()
                    if isinstance(x, str):
                        said += [" ".join(x.split())] if x.strip() else []
                    elif not x.noise:
                        todo += reversed(x.children)
                if said:
                    own.setdefault(node.key, []).append(tuple(said))
        for key, contents in own.items():
            for h in {host, ""}:
                held.setdefault((h, key), Counter())[tuple(contents)] += 1
    low = set()
    for at, contents in held.items():
        n = sum(contents.values())
        if n >= html.MIN_PAGES and -sum(c / n * np.log2(c / n) for c in contents.values()) / np.log2(n) < html.MIN_IMPORTANCE:
            low.add(at)
    return low


def test_style_trees_equal_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        host = f"h{min(rng.randrange(6), rng.randrange(6))}.net"
        parts = [f"<div class='k{k}'><p>{'same ' * k if rng.random() < k / 6 else rng.random()}</p><i>{rng.choice('ab')}</i></div>" for k in range(6)]
        rng.shuffle(parts)
        rows.append((i, f"http://{host}/{i}", f"<body>{''.join(parts)}<p>page {i}</p></body>"))
    low = brute_trees([(u.split("/")[2], h) for _, u, h in rows])
    want, pages = {}, Counter(u.split("/")[2] for _, u, _ in rows)
    for i, u, h in rows:
        host = u.split("/")[2]
        small = pages[host] < html.MIN_PAGES
        want[i] = html.main_text(h, frozenset(k for k in html.style_rows(h) if (host, k) in low or (small and ("", k) in low)))
    assert any(h != "" for h, _ in low) and any(t.count("\n\n") < 12 for t in want.values())
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in CLASHES})
    got = html.extract(df).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r[c] == "clash" for r in got for c in CLASHES)
