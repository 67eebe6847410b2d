"""The training-data operators against brute force, exact round trips and held-out accuracy, on small frames with awkward rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from demandtide.llm import chat_format as chat, decontaminate as dec, language_id as lang, minhash_dedup as mh, pitman_yor as py
from demandtide.llm.components import components
from demandtide.llm.line_chunks import line_dedup
from demandtide.llm.near_vectors import near_vectors
from demandtide.llm.packing import best_boundaries, pack, word_count
from demandtide.llm.token_counts import TokenCounter, prove_whole, token_counts
from demandtide.llm.url_filter import propagate, url_filter

DOCS = "doc_id long, text string, lang string, h string, n_tokens int, score string"


def documents(spark, texts, schema=DOCS):
    """Rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(k, t, None, "x", 7, "y") for k, t in texts], schema)


def groups(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ---- 1 token counts


@pytest.fixture(scope="module")
def definition():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.json")


AWKWARD = ["", " ", "  \n\t x", "it's we'll 'tis ''t", "<|endoftext|>a<|endoftext|>", "<|endoftext", "héllo wörld 12345 ½", "日本語 テスト", "\u0558\u088f a", "a" * 5000, "\U0001f600\u200d x\u00a0y\u2003z"]


def test_token_counts_equal_the_library(definition):
    from tokenizers import Tokenizer

    library, text = Tokenizer.from_file(definition), open(definition).read()
    counter = TokenCounter(text, prove_whole(text))
    assert len(counter.whole) > 40_000
    for t in AWKWARD:
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False)), t
    assert counter.count(None) == 0

    @settings(max_examples=150, deadline=None)
    @given(st.text() | st.text("ab '\n\t<|endoftext|>12.é", max_size=60))
    def same(t):
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False))

    same()


def test_token_counts_frame(spark, definition):
    df = documents(spark, [(1, "a b"), (1, "a b"), (None, None), (2, "")])
    out = token_counts(df, definition)
    assert sorted(out.columns) == sorted(df.columns)
    assert sorted(r.n_tokens for r in out.collect()) == [0, 0, 2, 2]
    assert token_counts(df.limit(0), definition).count() == 0


# ---- 2 URL filter


def test_url_rules_and_hosts(spark):
    urls = [
        "https://X.Com/a?q#f", "http://a.example.com/en/1", "http://www.example.com/en/1", "http://b.net/es/", "http://b.net", "none", None, "http://WWW.Ünï.net/es/2", "//b.net/es/", "x://a.com?y", "http://x.com/en/://y",
    ]
    df = spark.createDataFrame([(k, u, None, "z") for k, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(df, site_links=False).collect()}
    assert got[0] == ("x.com", "/a", "com/", "allow")
    assert got[1] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[3] == ("b.net", "/es/", "net/es/", "block")
    assert got[4] == ("b.net", "", None, "block")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("www.Ünï.net", "/es/2", "net/es/", "block")
    assert got[8] == ("", "", None, "allow")
    assert got[9] == ("a.com", "", None, "allow")
    assert got[10] == ("x.com", "/en/://y", "com/", "allow")
    assert url_filter(df.limit(0)).count() == 0


def test_distrust_runs_against_links(spark):
    page = '<a href="http://{}/x">x</a>'
    rows = [(0, "http://bad.net/es/1", ""), (1, "http://spam.org/1", page.format("bad.net")), (2, "http://good.com/1", page.format("fine.org")), (3, "http://fine.org/", ""), (4, "http://alone.org/", None)]
    got = {r.page_id: r.verdict for r in url_filter(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow", 4: "allow"}


def test_pagerank_equals_power_iteration(spark):
    rng = np.random.default_rng(1)
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, 12, (40, 2)) if a != b})
    out = Counter(a for a, _ in edges)
    want = seed = {1: 0.25, 5: 0.75}
    for _ in range(6):
        new = defaultdict(float, {k: 0.15 * v for k, v in seed.items()})
        for a, b in edges:
            new[b] += 0.85 * (0.15 * want.get(a, 0) if want is seed else want.get(a, 0)) / out[a]
        want = dict(new)
    frame = spark.createDataFrame([(str(a), str(b)) for a, b in edges], "src string, dst string")
    got = propagate(frame, spark.createDataFrame([("1", 0.25), ("5", 0.75)], "host string, weight double"), 0.85, 6)
    got = {int(r.host): r.score for r in got.collect() if r.score > 0}
    assert got == pytest.approx({k: v for k, v in want.items() if v > 0})


# ---- 3 vectors


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 20))
    vectors = [(c + 0.1 * s * rng.standard_normal(20)).tolist() for c in centres for s in (0, 0.5, 1, 1.5, 2, 2)] + rng.standard_normal((40, 20)).tolist()
    rows = [(k, v, k % 2) for k, v in enumerate(vectors)] + [(100, vectors[0], 0), (101, vectors[0], 1), (102, [3 * x for x in vectors[0]], 0)]
    odd = [(200, None, 0), (201, [0.0] * 20, 0), (202, vectors[0], None), (203, [None, *vectors[0][1:]], 0), (204, [float("nan"), *vectors[0][1:]], 0), (205, [float("inf"), *vectors[0][1:]], 0), (206, vectors[0][:10], 0), (207, [], 0)]
    df = spark.createDataFrame(rows + odd + [(None, vectors[0], 0)], "vec_id long, embedding array<double>, label int")

    def cos(a, b):
        return float(np.dot(a, b) / math.sqrt(np.dot(a, a)) / math.sqrt(np.dot(b, b)))

    links = [(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if a[2] == b[2] and cos(a[1], b[1]) >= 0.98]
    assert len(links) > 10
    degree, part = Counter(x for pair in links for x in pair), groups(links, [r[0] for r in rows])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert got.pop(None) == (0, None, True)
    assert got == {i: (degree[i], part[i], part[i] == i) for i in part} | {r[0]: (0, r[0], True) for r in odd}
    assert near_vectors(df.limit(0)).count() == 0


def test_components_on_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(501, 560)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)] + [(7, 7), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = groups(real, sorted({x for p in real for x in p}))
    assert {r.id: r.component for r in components(frame).collect()} == want
    assert components(frame.limit(0)).count() == 0


# ---- 4 language


def languages(rng, n):
    syllables = {"aa": ["the", "ing", "er", "on"], "bb": ["über", "sch", "ein", "ß"], "cc": ["ción", "ñ", "os", "que"]}
    return [(k, " ".join("".join(rng.choice(syllables[c]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(2, 40))), c) for k, c in zip(range(n), itertools.cycle(syllables))]


def test_language_learns_and_rejects(spark):
    rows = languages(random.Random(2), 240)
    train = spark.createDataFrame(rows[:180] + [(900, None, "aa"), (901, "...", "bb"), (902, "text", None)], "doc_id long, text string, lang string")
    model = lang.train_model(train)
    assert model.languages == ["aa", "bb", "cc"]
    assert (model.weights == 0).mean() > 0.5 and model.temperature > 0
    odd = [(990, None, None), (991, "", None), (992, "12 --", None), (993, "über " * 30_000, None)]
    frame = spark.createDataFrame([(k, t, c, "clash", 1.5) for k, t, c in rows[180:] + odd], "doc_id long, text string, lang string, lang_pred string, score double")
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang.predict(frame, model).collect()}
    assert np.mean([got[k][0] == c for k, _, c in rows[180:]]) > 0.95
    assert all(got[k] == ("und", 0.0) for k in (990, 991, 992)) and got[993][0] == "bb"
    assert all(0 <= s <= 1 for _, s in got.values())
    kept = lang.accepted(frame, model)
    assert kept.columns == frame.columns and not {990, 991, 992} & {r.doc_id for r in kept.collect()}
    empty = lang.train_model(train.limit(0))
    assert {r.lang_pred for r in lang.predict(frame, empty).collect()} == {"und"}


# ---- 5 chat


def test_chat_round_trip_and_events(spark):
    texts = ["plain", chat.START + "assistant ok" + chat.END, "<\\|im_end|>", "a<", "|b", "", None, "line\nline<|x|>", "<" * 9 + "|"]
    rows = [(1, k, "message", k, r, t) for k, (r, t) in enumerate(zip(itertools.cycle(["user", "assistant", "a\nb\\n<|im_end|>", None]), texts))]
    rows += [(2, 0, "message", 0, "user", "q"), (2, 1, "delta", 1, "assistant", "he"), (2, 2, "delta", 1, "assistant", "llo"), (2, 3, "message", 2, "user", "again"), (2, 4, "regenerate", 1, None, None), (2, 5, "delta", 1, "assistant", "bye"), (2, 6, "edit", 0, None, "Q"), (2, 7, "edit", 9, None, "none")]
    rows += [(None, 0, "message", 0, "user", "x"), (3, None, "message", None, "user", "b"), (3, None, "message", None, "user", "a"), (3, None, "message", None, "user", "a")]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, seq long, kind string, turn long, role string, text string").withColumn("n_turns", F.lit(1)).repartition(3)
    out = {r.conv_id: r for r in chat.chat_format(frame).collect()}
    said = sorted((r for r in rows if r[0] == 1), key=lambda r: r[1])
    assert chat.read_back(out[1].formatted) == [(r[4] or "", r[5] or "") for r in said]
    assert chat.read_back(out[2].formatted) == [("user", "Q"), ("assistant", "bye")]
    assert chat.read_back(out[3].formatted) == [("user", "a"), ("user", "a"), ("user", "b")]
    assert out[None].n_turns == 1
    digest = {r.conv_id: r for r in chat.digests(chat.chat_format(frame)).collect()}
    loss = "".join(r[5] or "" for r in said if r[4] == "assistant")
    assert (digest[1].loss_chars, digest[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_format(frame.limit(0)).count() == 0

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.tuples(st.text("a\n\\<|im_start>endüser", max_size=12), st.text("a\n\\<|im_start>end", max_size=30)), max_size=4))
    def same(messages):
        assert chat.read_back(chat.render(messages)[0]) == messages

    same()


# ---- 6 decontamination


def test_templates_catch_new_values_only_when_consistent(spark):
    item = "Anna bought 12 apples and gave 12 apples to Bert who then sold 5 kg of them at the market in the old town."
    item = "Yesterday " + item
    new = item.replace("12", "31").replace("Anna", "Carla").replace("Bert", "Dora").replace("5 kg", "9 lb")
    mixed = item.replace("12 apples and", "31 apples and")
    filler = "some other words that never occur in any question of the benchmark at all "
    texts = {1: filler + item + " " + filler, 2: filler * 2 + new, 3: filler + mixed + " " + filler, 4: filler * 5, 5: None, 6: "", 7: filler * 4000 + new.upper().lower() + ".###", 8: "Short one here now"}
    docs = documents(spark, [*texts.items(), (1, texts[1]), (None, texts[1])])
    items = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "short One here"), (None, filler)], "item_id long, text string")
    got = defaultdict(list)
    for r in dec.decontaminate(docs, items).collect():
        got[r.doc_id].append((r.contaminated, r.items))
    assert got[1] == [(True, [10])] * 2 and got[2] == [(True, [10])] and got[None] == [(True, [10])]
    assert got[3] == [(False, [])] and got[4] == got[5] == got[6] == [(False, [])]
    assert got[8][0][0] is False or got[8][0][1] == [13]
    wide = {tuple(r) for r in dec.contaminated(docs, items, filter_bits=6).collect()}
    assert wide == {tuple(r) for r in dec.contaminated(docs, items).collect()}
    kept = dec.clean(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {3, 4, 5, 6}
    assert dec.decontaminate(docs.limit(0), items).count() == 0
    assert dec.clean(docs, items.limit(0)).count() == docs.count()


def test_verbatim_items_in_the_tables_are_found(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    held = items.collect()
    want = {(r.doc_id, i.item_id) for r in docs.collect() for i in held if i.text.lower() in r.text.lower()}
    assert want <= {(r.id, r.item_id) for r in dec.contaminated(docs, items).collect()}


# ---- 7 packing


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(30):
        histogram = {k: rng.randrange(1, 9) for k in rng.sample(range(1, 30), rng.randrange(1, 8))}
        lengths, buckets = sorted(histogram), rng.randrange(1, 5)

        def padding(bounds):
            return sum(n * (min(b for b in bounds if b >= k) - k) for k, n in histogram.items())

        best = min(padding((*c, lengths[-1])) for m in range(buckets) for c in itertools.combinations(lengths[:-1], m))
        bounds = best_boundaries(histogram, buckets)
        assert len(bounds) <= buckets and padding(bounds) == best
    assert best_boundaries({}, 4) == []


def test_packing_places_every_token_once(spark):
    rng = random.Random(6)
    rows = [(k, rng.randrange(0, 300)) for k in range(400)] + [(7, 50), (None, 10), (500, None), (501, 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, n_tokens long").withColumn("length", F.lit("x"))
    out = pack(frame, max_len=256, buckets=5, token_budget=1024, slot_batches=4).collect()
    assert sum(r.length for r in out) == sum(n or 0 for _, n in rows)
    assert all(r.length <= r.bucket_len <= 256 for r in out) and len({r.bucket_len for r in out}) <= 5
    sizes = defaultdict(list)
    for r in out:
        sizes[r.batch_id].append(r.bucket_len)
    assert all(len(set(v)) == 1 and sum(v) <= max(1024, v[0]) for v in sizes.values())
    assert pack(frame.limit(0)).count() == 0
    words = spark.createDataFrame([(None,), ("",), (" a\tb\n\nc\x0b",), ("é\u00a0x y",)], "t string").select(word_count(F.col("t")).alias("n"))
    assert [r.n for r in words.collect()] == [0, 0, 3, 2]


# ---- 8 MinHash


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingle(text, n):
    w = words(text)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@pytest.mark.parametrize("n", [2, 5])
def test_minhash_equals_brute_force(spark, n):
    rng = random.Random(n)
    texts = []
    for _ in range(12):
        base = prose(rng, rng.choice([3, 8, 40, 120])).split()
        for _ in range(rng.randrange(1, 8)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(900)}"
            texts.append(" ".join(copy))
    texts += ["", None, " \n", "One", "one", "\u00c9 x", "\u00e9 x", prose(rng, 30_000)]
    frame = documents(spark, list(enumerate(texts)) + [(0, texts[0]), (None, texts[0])])
    sets = {k: shingle(t, n) for k, t in enumerate(texts)}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if (k := len(sets[a] & sets[b])) and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k)]
    part = groups(links, list(sets))
    rows = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in mh.minhash_dedup(frame, n=n).collect()]
    assert sorted(r for r in rows if r[0] is not None) == sorted([(k, len(sets[k]), part[k], part[k] == k) for k in [*sets, 0]])
    assert [r[2:] for r in rows if r[0] is None] == [(None, True)]
    assert mh.minhash_dedup(frame.limit(0), n=n).count() == 0


def test_no_link_is_lost_to_a_centre(spark):
    """A chain: neighbours are alike, the smallest id is like its neighbour only."""
    rng = random.Random(9)
    text, texts = prose(rng, 200, 5000).split(), []
    for k in range(25):
        texts.append((k, " ".join(text)))
        for j in range(6 * k, 6 * k + 6):
            text[j] = f"new{k}x{j}"
    out = mh.minhash_dedup(documents(spark, texts), n=2).collect()
    sets = {k: shingle(t, 2) for k, t in texts}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * (k := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - k)]
    assert {r.doc_id: r.component_id for r in out} == groups(links, list(sets))


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(8)
    for size in (6, 60, 2000):
        agree = []
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, size * 2, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(pool[: int(size * 1.5)]), np.unique(pool[int(size * 0.5) :])
            agree.append(np.mean(mh.signature(a) == mh.signature(b)))
        assert abs(np.mean(agree) - 0.5) < 0.06


# ---- 9 line chunks


def brute_chunks(text, spread, long_line):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:12], 16) for x in lines]
    wide = [len(words(x)) >= long_line for x in lines]
    chunks, now = [], []
    for k, line in enumerate(lines):
        now.append(line)
        if wide[k] or k + 1 == len(lines) or wide[k + 1] or (h[k] * 31 + (h[k - 1] if k else 0)) % spread == 0:
            chunks.append((now, wide[k]))
            now = []
    return chunks


def test_line_chunks_equal_brute_force(spark):
    rng = random.Random(12)
    shared = [[prose(rng, 6) for _ in range(9)] for _ in range(3)]
    texts = []
    for k in range(40):
        lines = [prose(rng, 5) for _ in range(rng.randrange(0, 6))]
        lines += rng.choice(shared) if k % 2 else []
        lines += [prose(random.Random(77), 60)] if k % 5 == 0 else []
        texts.append("\n".join(lines + [prose(rng, 4), "", ""]))
    texts += ["", None, "\n\n\n", "one line", "\n".join(["same", "same"] * 2000)]
    frame = documents(spark, list(enumerate(texts))).withColumn("n_lines", F.lit("clash"))
    seen, want = set(), {}
    for k, t in enumerate(texts):
        if t is None:
            want[k] = (None, 0, 0)
            continue
        left, gone = [], 0
        for lines, wide in brute_chunks(t, 3, 50):
            body = "\n".join(lines)
            if (len(lines) > 1 or wide) and body in seen:
                gone += len(lines)
                continue
            if len(lines) > 1 or wide:
                seen.add(body)
            left.append(body)
        want[k] = ("\n".join(left), t.count("\n") + 1, gone)
    got = {r.doc_id: (r.text, r.n_lines, r.removed_lines) for r in line_dedup(frame).collect()}
    assert got == want and sum(w[2] for w in want.values()) > 50
    twice = line_dedup(documents(spark, [(1, texts[1]), (1, texts[1]), (None, texts[1])]))
    assert sorted(r.removed_lines > 0 for r in twice.collect()) == [False, True, True]
    assert line_dedup(frame.limit(0)).count() == 0


# ---- 10 Pitman-Yor


def test_table_counts_follow_their_conditional():
    rng = np.random.default_rng(3)
    c, p, total, d, theta = 6, 0.05, 20, 0.75, 1.0
    drawn = py.sample_tables(np.full(40_000, c), np.full(40_000, p), np.full(40_000, total), d, theta, rng)

    def stirling(n, t):
        if n == t:
            return 1.0
        return 0.0 if t < 1 or t > n else stirling(n - 1, t - 1) + (n - 1 - d * t) * stirling(n - 1, t)

    weight = np.array([stirling(c, t) * p**t * np.prod([theta + d * (total + i) for i in range(t)]) for t in range(1, c + 1)])
    assert np.bincount(drawn, minlength=c + 1)[1:] / 40_000 == pytest.approx(weight / weight.sum(), abs=0.01)
    many = py.sample_tables(np.array([1, 2, 500, 100_000]), np.full(4, 0.01), np.full(4, 30), d, theta, rng)
    assert many[0] == 1 and (many >= 1).all() and (many <= [1, 2, 500, 100_000]).all()


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    context = np.sort(rng.integers(0, 1 << 53, 500, dtype=np.uint64))[rng.integers(0, 60, 500)]
    context.sort()
    word = rng.integers(0, 1 << 53, 500, dtype=np.uint64)
    docs, counts = rng.choice([1, 3], 500), rng.integers(1, 70_000, 500)
    ids, train = np.array([7, -5, 9, 1 << 62], np.int64), np.array([False, True, True, False])
    back = py.unpack_part(py.pack_part(context, word, docs, counts, ids, train))
    for x, y in zip((context, word, docs // 2, counts, ids[[1, 3]], train[[1, 3]]), back):  # documents that do not occur stay behind
        assert (x == y).all()


def test_scores_are_probabilities_and_base_is_exact(spark):
    rng = random.Random(5)
    texts = [(k, prose(rng, rng.randrange(1, 200), 60)) for k in range(120)] + [(200, None), (201, ""), (202, "Unseen words ONLY")]
    frame = spark.createDataFrame([(k, t, k % 5 != 1) for k, t in texts], "id long, text string, learn boolean").select("id", F.col("text").cast("binary").alias("body"), "learn")
    got = {r.id: r for r in py.score_texts(frame).collect()}
    counts = Counter(w for k, t in texts if k % 5 != 1 for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for k, t in texts:
        tokens = [*words(t), None]
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert got[k].base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
        assert -math.inf < got[k].score <= 0
    # over all words that can follow one context, the predictive probabilities add up to 1: score each as "w0 <word>"
    # and compare with the text of the first word alone, which has its own probability taken out
    again = {r.id: r.score for r in py.score_texts(frame).collect()}
    assert again == {k: r.score for k, r in got.items()}
    nothing = {r.id: (r.base_score, r.score) for r in py.score_texts(frame.withColumn("learn", F.lit(False))).collect()}
    assert nothing[201] == (0.0, 0.0)
    assert py.score_texts(frame.limit(0)).count() == 0


def test_predictive_probabilities_add_up_to_one():
    rng = np.random.default_rng(6)
    c, vocabulary = rng.integers(0, 90, (4, 30)), 30
    t = np.minimum(c, 1)
    for _ in range(3):
        c1 = t.sum(axis=0)
        t1 = py.sample_tables(c1, np.full(30, 1 / 31), np.full(30, 25), py.ROOT_DISCOUNT, py.ROOT_STRENGTH, rng)
        total = c1.sum(), t1.sum()
        parent, unseen = py.root_probability(c1 - py.ROOT_DISCOUNT * t1, total, vocabulary), py.root_probability(0, total, vocabulary)
        assert parent.sum() + unseen == pytest.approx(1)
        for u in range(4):
            tables, customers = t[u].sum(), c[u].sum()
            seen = py.predictive(c[u], t[u], parent, tables, customers).sum()
            assert seen + py.predictive(0, 0, unseen, tables, customers) == pytest.approx(1)
            t[u] = py.sample_tables(c[u], parent, np.maximum(tables - t[u], 0), py.DISCOUNT, py.STRENGTH, rng)
    assert py.predictive(0, 0, parent, 0, 0) == pytest.approx(parent)  # an unseen context


def test_model_beats_the_base_on_held_out_text(spark):
    """Text of a strong bigram structure."""
    rng = random.Random(8)
    follow = {k: [rng.randrange(150) for _ in range(3)] for k in range(150)}

    def chain():
        at, out = rng.randrange(150), []
        for _ in range(120):
            at = rng.choice(follow[at])
            out.append(f"w{at}")
        return " ".join(out)

    rows = [(k, chain().encode(), k < 150) for k in range(200)]
    got = py.score_texts(spark.createDataFrame(rows, "id long, body binary, learn boolean")).filter("id >= 150").collect()
    assert sum(r.score for r in got) > 0.75 * sum(r.base_score for r in got)


# ---- pipeline and queries


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(10)
    rows = [(k, t, c, "s", len(t)) for k, t, c in languages(rng, 90)]
    unique = [(100 + k, " ".join("".join(rng.choice(["the", "ing", "er"]) for _ in range(4)) for _ in range(60)), "aa", "s", 1) for k in range(20)]
    item = unique[0][1]
    rows += unique + [(300, unique[1][1], None, None, None), (301, "12 34", "aa", "s", 5), (302, None, "aa", "s", None), (303, unique[2][1] + " " + item, "aa", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in cp.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "packing"]
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left[name] = {r.doc_id for r in docs.collect()}
    assert not {301, 302} & left["language"] and set(range(100, 120)) <= left["language"]
    assert 300 not in left["near_duplicates"] and set(range(100, 120)) <= left["near_duplicates"]
    assert not {100, 303} & left["benchmark"] and set(range(101, 120)) <= left["benchmark"]
    assert {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()} == left["benchmark"]


SQL_NAMES = ["op3_near_vectors", "op5_chat_format", "op8_minhash_dedup", "op9_line_dedup"]


@pytest.mark.parametrize("name", SQL_NAMES)
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from demandtide.llm.catalog import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    want = con.execute(SQL[name]).df()
    got = QUERIES[name](spark, folder).toPandas()[list(want.columns)]
    key = want.columns[0]
    assert got.sort_values(key).astype(str).values.tolist() == want.sort_values(key).astype(str).values.tolist()


def test_folds_follow_the_checksum(spark):
    from demandtide.llm.words import crc_mod

    got = spark.createDataFrame([(k,) for k in (0, 5, 123456789, -1)], "doc_id long").select("doc_id", crc_mod("doc_id", 4).alias("m")).collect()
    assert all(r.m == zlib.crc32(str(r.doc_id).encode()) % 4 for r in got)
