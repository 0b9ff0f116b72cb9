"""Each method against brute force, an exact round trip, or accuracy on rows it hasn't learned from."""

import html
import re
import time
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelspark.llm import _common, components, decontam, docstats, entries, labelled, lang_svm, pfair_mix, quality_gbt, quality_qda, simhash_pivot, site_style, token_prefix, warc
from reelspark.llm._common import remainder

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules


def brute_counts(text):
    w = WORDS.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(grams)
    covered = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\té|# \x0b", max_size=60))
def test_counts_equal_brute_force(text):
    assert docstats.counts(text.encode())[:5] == brute_counts(text)


def test_forest_walk_and_monotone():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) - x[:, 1] + rng.normal(0, 0.1, 3000)) > 0).astype(float)
    p = quality_gbt.GbtParams(trees=30, monotone={"a": 1, "b": -1})
    f = quality_gbt.fit_forest(x, y, ("a", "b", "c"), p)

    def walk(row):
        total = f.base
        for n in f.roots:
            while f.left[n] != n:
                n = f.left[n] if row[f.feature[n]] <= f.threshold[n] else f.right[n]
            total += f.value[n]
        return total

    assert np.allclose(f.margin(x[:200]), [walk(r) for r in x[:200]])
    assert ((f.score(x) > 0.5) == (y > 0)).mean() > 0.9
    for column, sign in ((0, 1), (1, -1)):
        grid = np.repeat(x[:50, None], 40, axis=1)
        grid[:, :, column] = np.linspace(0, 1, 40)
        m = f.margin(grid.reshape(-1, 3)).reshape(50, 40)
        assert (sign * np.diff(m, axis=1) >= -1e-9).all()


def test_rules_on_the_tables(spark, smallest):
    docs, labels = (spark.read.parquet(f"{smallest}/{n}.parquet") for n in ("documents", "labels"))
    forest = quality_gbt.train(docs, labels)
    rows = {r["doc_id"]: r for r in entries.op1_quality_rules(spark, smallest).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        want = brute_counts(t)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        score = forest.score(docstats.ratios(np.array([docstats.counts(t.encode())])))[0]
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == failed and r["kept"] == (not failed and score >= 0.5)


def test_rules_on_rows_they_have_not_learned_from(spark, smallest):
    docs, labels = (spark.read.parquet(f"{smallest.replace('sf0.001', 'sf0.01')}/{n}.parquet") for n in ("documents", "labels"))
    x, y = labelled.training_rows(docs, labels, lambda i: remainder(i, 4) != 2)
    unseen, truth = labelled.training_rows(docs, labels, lambda i: remainder(i, 4) == 2)
    forest = quality_gbt.fit_forest(docstats.ratios(x), y)
    assert len(truth) > 50 and ((forest.score(docstats.ratios(unseen)) >= 0.5) == (truth > 0)).mean() > 0.95


# --- quality classifier


def test_discriminant_equals_gaussian_densities():
    rng = np.random.default_rng(2)
    c = rng.integers(0, 50, (400, len(docstats.COUNTS))).astype(float)
    c[:, 0] += 50
    y = (rng.random(400) < 0.6).astype(float)
    p = quality_qda.QdaParams()
    m = quality_qda.fit(c, y, p)
    z = (quality_qda.transform(c) - m.center) / m.scale
    own = [np.cov(z[y == k].T) for k in (0, 1)]
    pooled = sum(s * (y == k).sum() for k, s in enumerate(own)) / len(y)
    logs = []
    for k, s in enumerate(own):
        s = (1 - p.pooled) * s + p.pooled * pooled
        s = (1 - p.diagonal) * s + p.diagonal * np.diag(np.diag(s)) + p.floor * np.eye(len(s))
        d = z - z[y == k].mean(axis=0)
        logs.append(-0.5 * (np.sum(d @ np.linalg.inv(s) * d, axis=1) + np.linalg.slogdet(s)[1]))
    assert np.allclose(m.difference(c), logs[1] - logs[0])


def test_classifier_on_held_out_rows(spark, smallest):
    rows = entries.op6_quality_classifier(spark, smallest).join(spark.read.parquet(f"{smallest}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 10 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9


# --- near-duplicates


def brute_fingerprint(text):
    w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in WORDS.findall(text or "")]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abAÉ \n", max_size=40))
def test_fingerprint(text):
    assert simhash_pivot.fingerprint(text.encode()) == brute_fingerprint(text)


def brute_links(fps, radius=2):
    return {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}


@pytest.mark.parametrize("crowd", [64, 0, 3])
def test_links_equal_brute_force(spark, crowd):
    rng = np.random.default_rng(3)
    fps = set()
    for base in rng.integers(-(1 << 63), 1 << 63, 12):
        for _ in range(12):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            fps.add(simhash_pivot._signed((int(base) & (1 << 64) - 1) ^ sum(1 << int(f) for f in flips)))
    got = simhash_pivot.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, crowd).collect()
    assert {(r["a"], r["b"]) for r in got} == brute_links(fps) and len(got) == len({(r["a"], r["b"]) for r in got})


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(40, 90)] + [tuple(map(int, rng.integers(100, 160, 2))) for _ in range(45)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_near_duplicates_on_the_tables(spark, smallest):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    near = {i: {j for j in fps if j != i and bin(fps[i] ^ fps[j]).count("1") <= 2} for i in fps}

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        return min(seen)

    rows = entries.op3_simhash(spark, smallest).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["n_near"], r["component_id"]) for r in rows} == {i: (f"{fps[i]:016x}", len(near[i]), reach(i)) for i in fps}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_segments():
    cut = simhash_pivot.Segmenter()
    words = [f"w{i}" for i in range(200)]
    own = set(cut(" ".join(words).encode()))
    changed = set(cut(" ".join([*words[:90], "other", *words[91:]]).upper().replace("W", "w").encode()))
    assert 35 < len(own) < 70 and 1 <= len(own - changed) <= 2 and len(changed - own) <= 3
    assert cut(None) == cut(b" \n") == [] and len(cut(b"one")) == 1 and cut(b"w1 w2 w3 w4 w5 w6 w7 w8 " * 9)[0] in cut(b"w1 w2 w3 w4 w5 w6 w7 w8 " * 900) and cut(b"A x") == cut(b"a x")


def test_changed_copies_are_linked_and_others_are_not(spark):
    rng = np.random.default_rng(21)
    word = lambda: f"w{rng.integers(0, 4000)}"
    passage = " ".join(word() for _ in range(60))
    rows, group = [], {}
    for g in range(25):
        base = [word() for _ in range(int(rng.integers(80, 300)))]
        for k in range(int(rng.integers(2, 7))):
            copy = [word() if k and rng.random() < 0.04 else w for w in base]
            group[len(rows)] = g
            rows.append((len(rows), " ".join(copy)))
    for g in range(60):  # others, which share a passage
        group[len(rows)] = 100 + g
        rows.append((len(rows), " ".join(word() for _ in range(90)) + " " + passage))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = simhash_pivot.Segmenter()
    segments = {simhash_pivot._signed(simhash_pivot.fingerprint(t.encode())): set(cut(t.encode())) for _, t in rows}
    read = simhash_pivot.sketches(docs)
    pairs = {(r["a"], r["b"]) for r in simhash_pivot.alike(read.select("fp", "segments").distinct()).collect()}
    assert pairs and all(a < b and jaccard(segments[a], segments[b]) >= simhash_pivot.SIMILAR for a, b in pairs)
    kept = {r["doc_id"] for r in simhash_pivot.keep_representatives(docs, similar=simhash_pivot.SIMILAR).collect()}
    assert {i for i, g in group.items() if g >= 100} <= kept  # a shared passage is no copy
    gone = [i for i, g in group.items() if g < 100 and min(j for j, h in group.items() if h == g) != i]
    assert sum(i not in kept for i in gone) >= 0.95 * len(gone) and {group[i] for i in kept} == set(group.values())
    narrow = {r["doc_id"] for r in simhash_pivot.keep_representatives(docs).collect()}
    assert sum(i not in narrow for i in gone) < 0.5 * len(gone)


@pytest.mark.parametrize("block", [2048, 7])
def test_segments_connect_as_brute_force(spark, block):
    """Many classes around the threshold share few segments, so that leaders alone miss links; equal fingerprints of different texts."""
    rng = np.random.default_rng(8)
    rows = []
    for g in range(6):
        pool = rng.integers(-(1 << 62), 1 << 62, 26).tolist()
        for _ in range(40):
            own = rng.choice(26, int(rng.integers(8, 18)), replace=False)
            rows.append((len(rows) // 2 * 2 if len(rows) % 9 == 1 else len(rows), sorted(pool[i] for i in own)))
    sets, parent = [(f, set(x)) for f, x in rows], {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    def join(pairs):
        parent.clear()
        for a, b in pairs:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        return {f: find(f) for f, _ in rows}

    every = {(min(f, g), max(f, g)) for f, x in sets for g, y in sets if f != g and jaccard(x, y) >= simhash_pivot.SIMILAR}
    got = {(r["a"], r["b"]) for r in simhash_pivot.alike(spark.createDataFrame(rows, "fp long, segments array<long>"), block=block).collect()}
    assert got <= every and join(got) == join(every) and 6 < len(set(join(every).values())) < len(rows)


def test_texts_of_a_batch_are_not_held_at_once():
    texts = [b"some words of text %d " % i * 150 for i in range(6000)] + [None, b"", b"long " * 600_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], ["doc_id", "_text"])
    ids, most = [], 0
    for out in simhash_pivot._sketch([batch.slice(0, 6002)]):
        ids += out.column("doc_id").to_pylist()
        most = max(most, out.num_rows)
    assert ids == list(range(6002)) and most < 1500
    parts = list(_common.slices([batch, batch.slice(0, 0)], "_text"))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and parts[-1].num_rows == 1
    assert all(sum(len(x or b"") for x in p.column(1).to_pylist()) <= _common.SLICE_BYTES for p in parts[:-1])


# --- token counts


@pytest.fixture(scope="module")
def tokenizer():
    path = token_prefix.default_path()
    return token_prefix.PrefixCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet="the ionsad \n▁é<>/0x", max_size=60))
def test_token_totals(tokenizer, text):
    text = text.encode("utf-8", "ignore").decode()
    assert tokenizer[0].total(text) == len(tokenizer[1].encode(text))


def test_token_prefixes(spark, smallest, tokenizer):
    rows = spark.read.parquet(f"{smallest}/documents.parquet").orderBy("doc_id").limit(8).collect()
    for t in [r["text"][:250] for r in rows] + ["  a  b", "x\n\n\ty ", "日本 ▁▁ z"]:
        table = tokenizer[0].table(t)
        assert table.tolist() == [len(tokenizer[1].encode(t[:i])) for i in range(len(t) + 1)]
        for budget in (0, 1, 7, 10**6):
            end = tokenizer[0].fit(t, budget)
            assert table[: end + 1].max() <= budget and (end == len(t) or table[end + 1] > budget)


def test_token_counts_on_the_tables(spark, smallest, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in entries.op5_token_counts(spark, smallest).collect()}
    assert {i: (len(t.encode()), len(tokenizer[1].encode(t))) for i, t in texts.items()} == {i: (r["n_bytes"], r["n_tokens"]) for i, r in rows.items()}
    cut = token_prefix.truncate_to_budget(spark.read.parquet(f"{smallest}/documents.parquet"), 100).collect()
    assert all(r["n_tokens"] <= 100 and texts[r["doc_id"]].startswith(r["text"]) and r["truncated"] == (r["text"] != texts[r["doc_id"]]) for r in cut)


# --- languages


def test_language_of_held_out_rows(spark, smallest):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    rows = entries.op8_language_id(spark, smallest).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(rows) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95


def test_votes_equal_brute_force():
    """Every classifier by its definition: trigram by trigram, then the best family, then each pair of its languages."""
    rng = np.random.default_rng(8)
    langs = ["en", "de", "nl", "fr", "es", "ru"]
    alphabets = {lang: rng.choice(list("abcdefghijklmnop"), 9) for lang in langs}
    made = [(lang, "".join(rng.choice([*alphabets[lang], " "], 60))) for lang in langs for _ in range(25)]
    rows = []
    for lang, t in made:
        n = lang_svm.histogram(t.encode())
        k = np.flatnonzero(n)
        rows.append((lang, k, n[k] / n.sum()))
    model = lang_svm.fit(rows)
    assert model.members == {"germanic": ["de", "en", "nl"], "romance": ["es", "fr"], "slavic": ["ru"]} and len(model.pairs) == 4

    def value(text, column):
        b = b" " + text.encode() + b" "
        codes = [int(lang_svm.codes(b[i : i + 3])[0]) for i in range(len(b) - 2)]
        return sum(model.weights[c, column] for c in codes) / len(codes) + model.weights[-1, column]

    texts = [t for _, t in made] + ["".join(rng.choice(list("abcdefghijklmnop "), 40)) for _ in range(60)]
    want = []
    for t in texts:
        family = max(range(3), key=lambda j: value(t, j))
        members = model.members[model.families[family]]
        votes, sums = Counter(), Counter()
        for j, (a, b) in enumerate(model.pairs, 3):
            if a in members:
                v = value(t, j)
                votes[a if v > 0 else b] += 1
                sums[a] += v
                sums[b] -= v
        want.append(max(members, key=lambda m: (votes[m], sums[m], m)))
    got, scores = lang_svm.decide(texts, model)
    assert got == want and all(0 <= s <= 1 for s in scores)
    assert np.mean([g == lang for g, (lang, _) in zip(got, made)]) > 0.95


# --- decontamination


def test_index_guarantees_the_radius():
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 999, 30))) for i in range(40)]
    index = decontam.build(items)
    for _ in range(200):
        k = rng.integers(0, 40)
        flips = rng.choice(64, rng.integers(0, 24), replace=False)
        bits = np.unpackbits(index.prints[k], bitorder="little")
        bits[flips] ^= 1
        query = np.packbits(bits, bitorder="little")
        brute = [i for i in range(40) if np.bitwise_count(index.prints[i] ^ query).sum() <= 23]
        assert index.candidates(query, 23).tolist() == brute and k in brute


def brute_matches(text, index, threshold, radius):
    """All windows of all items' lengths."""
    words, out = decontam.words_of(text), {}
    for at, item in enumerate(index.words):
        n = min(len(item), len(words))
        for s in range(len(words) - n + 1):
            bag = decontam.shingles(words[s : s + n])
            if np.bitwise_count(index.simhash(bag) ^ index.prints[at]).sum() <= radius:
                out[at] = max(out.get(at, 0), index.similarity(bag, index.bags[at]))
    return {index.ids[at] for at, s in out.items() if s >= threshold}


def test_decontamination_on_the_tables(spark, smallest):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{smallest}/benchmark.parquet").collect()]
    index = decontam.build(items)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    found = {r["doc_id"]: set(r["item_ids"]) for r in entries.op7_decontamination(spark, smallest).collect()}
    short = {i: t for i, t in texts.items() if len(t) < 900}
    few = decontam.build(items[:10])
    for t in list(short.values())[:40]:
        assert {h[0] for h in decontam.find(t, few)} == brute_matches(t, few, decontam.THRESHOLD, decontam.RADIUS)
    exact = {i: {k for k, b in items if b" ".join(decontam.words_of(b)) in b" ".join(decontam.words_of(t))} for i, t in texts.items()}
    assert {i for i, k in exact.items() if k} == found.keys() and all(exact[i] <= found[i] for i in found)
    for k, b in items:
        words = b.split()
        words[len(words) // 2] = "changed"
        text = f"before it {' '.join(words).upper()}; and after it"
        hits = decontam.find(text, index)
        assert k in {h[0] for h in hits} and all(h[3] >= decontam.THRESHOLD for h in hits)


# --- mixing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.integers(1, 40), min_size=1))
def test_schedule_deviates_by_less_than_a_block(weights):
    total, done = sum(weights.values()), Counter()
    for t, s in enumerate(pfair_mix.earliest_deadline_first(weights), 1):
        done[s] += 1
        assert all(abs(done[k] * total - w * t) < total for k, w in weights.items())
    assert done == Counter(weights)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcd"), st.tuples(st.integers(0, 60), st.integers(1, 9)), min_size=1))
def test_plan_is_whole(given_):
    blocks, weights = {s: n for s, (n, _) in given_.items()}, {s: w for s, (_, w) in given_.items()}
    slots = {}
    for ph in pfair_mix.plan(blocks, weights):
        for s, own in ph.orders.items():
            last = next((q.first[s] for q in pfair_mix.plan(blocks, weights) if q.start >= ph.end), blocks[s])
            for j in range(ph.first[s], last):
                k = j - ph.first[s]
                slots.setdefault(ph.start + k // len(own) * ph.period + own[k % len(own)], []).append((s, j))
    assert sorted(slots) == list(range(sum(blocks.values()))) and all(len(v) == 1 for v in slots.values())
    assert {v[0] for v in slots.values()} == {(s, j) for s, n in blocks.items() for j in range(n)}


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.7, "b": 0.2999, "c": "0.0001"}, {"a": 3, "b": 2, "c": Fraction(1, 7)}, {"a": 0.1, "b": 1 / 3, "c": 0.25, "d": 1}])
def test_a_million_slots_deviate_by_less_than_a_block_from_the_given_weights(weights):
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    n, whole = 1_000_000, pfair_mix.whole_weights(weights)
    assert {s: Fraction(w, sum(whole.values())) for s, w in whole.items()} == {s: w / sum(exact.values()) for s, w in exact.items()}
    if max(whole.values()) > 10**9:  # the period is longer than any run; as far as the blocks go
        order = pfair_mix.earliest_deadline_first(whole, dict.fromkeys(whole, 40_000))
        assert len(order) > 60_000
    else:
        phase = pfair_mix.plan(dict.fromkeys(weights, n), whole)[0]
        order = [""] * phase.period
        for s, own in phase.orders.items():
            for i in own:
                order[i] = s
        order = (order * (n // len(order) + 1))[:n]
    names = np.array(order)
    for s, w in whole.items():
        got = np.cumsum(names == s)
        off = [abs(int(g) * sum(whole.values()) - w * t) for t, g in zip(range(1, len(got) + 1), got.tolist())]
        assert max(off) < sum(whole.values())


def test_schedules_too_long_to_send_are_refused(monkeypatch):
    monkeypatch.setattr(pfair_mix, "MOST_NUMBERS", 1000)
    blocks = {"a": 10**6, "b": 10**6}
    assert len(pfair_mix.plan(blocks, pfair_mix.whole_weights({"a": 1, "b": 400}))) == 2
    with pytest.raises(ValueError, match="denominator"):
        pfair_mix.plan(blocks, pfair_mix.whole_weights({"a": 1, "b": "1.00001"}))


def test_mix_on_the_tables(spark, smallest):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    weights = {"src0": "0.3", "src1": 0.2, "src2": 7}
    rows = sorted(pfair_mix.mix(docs, weights, block=2, bucket_rows=4).collect(), key=lambda r: r["position"])
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
    assert len({r["position"] for r in rows}) == len(rows) and all(r["position"] // 2 == r["slot"] for r in rows)
    exact = {r["source"]: Fraction(str(weights.get(r["source"], 1))) for r in rows}
    left, done = Counter({s: -(-n // 2) for s, n in Counter(r["source"] for r in rows).items()}), Counter()
    order = {}
    for r in rows:
        order.setdefault(r["slot"], (r["source"], r["block"]))
    for t, (s, _) in enumerate((order[k] for k in sorted(order)), 1):  # until the first source ends
        done[s] += 1
        assert all(abs(done[k] - exact[k] / sum(exact.values()) * t) < 1 for k in left)
        if done[s] == left[s]:
            break


def test_rows_without_ids_are_spread_and_ties_are_settled(spark):
    rows = [(None, "a", f"text {i}", i) for i in range(400)] + [(7, "a", "tie one", 1), (7, "a", "tie two", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars int")
    placed, _ = pfair_mix.numbered(docs, ["doc_id", "source", "text"], bucket_rows=20)
    assert sorted(r["place"] for r in placed.collect()) == list(range(402))
    one, two = ({r["position"]: r["text"] for r in pfair_mix.mix(d, block=4, bucket_rows=20, columns=("doc_id", "source", "text")).collect()} for d in (docs, docs.repartition(7).orderBy(F.desc("text"))))
    assert one == two and len(one) == 402


# --- archives


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300), st.integers(1, 40), st.integers(30, 90))
def test_records_round_trip(text, chunk, segment):
    body = text.encode("utf-8", "ignore")
    raw = b"\r\n\r\n".join([*warc.records("<urn:page:1:x>", "http://x/\n", body, warc.digest_of(body), None, segment, chunk), b""])
    read = list(warc.parse(raw))
    parts = [(int(h["warc-segment-number"]), int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, b) for h, b in read if "warc-segment-number" in h]
    whole = warc.reassemble(parts[::-1])[0] if parts else read[0][1]
    assert warc.payload_of(whole) == body and all(len(b) <= segment for _, b in read)


def test_false_archives():
    ok = [(1, None, b"ab"), (2, 4, b"cd")]
    assert warc.reassemble(ok) == (b"abcd", 1) and warc.reassemble(ok * 2) == (b"abcd", 2)
    for bad in ([(2, 4, b"cd")], [(1, None, b"ab"), (2, 5, b"cd")], [(1, None, b"ab"), (1, None, b"xx"), (2, 4, b"cd")], [(1, None, b"ab"), (3, 4, b"cd")]):
        with pytest.raises(ValueError):
            warc.reassemble(bad)
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_archives_on_the_tables(spark, smallest):
    pages = spark.read.parquet(f"{smallest}/pages.parquet")
    twice = pages.union(pages.withColumn("page_id", F.col("page_id") + 1_000_000))
    rows = {r["page_id"]: r for r in warc.archive_round_trip(twice, segment=1500, chunk=400, file_bytes=40_000, pack_bytes=10_000).collect()}
    for p in pages.collect():
        body = p["html"].encode()
        a, b = rows[p["page_id"]], rows[p["page_id"] + 1_000_000]
        assert (a["record_type"], a["refers_to"], b["record_type"], b["refers_to"]) == ("revisit", p["page_id"] + 1_000_000, "response", None)
        assert a["payload_digest"] == b["payload_digest"] == warc.digest_of(body) and a["payload_bytes"] == b["payload_bytes"] == len(body)
    assert {r["record_type"] for r in warc.archive_round_trip(twice, least_bytes=10**9).collect()} == {"response"}


# --- HTML


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inside))).split())


def test_html_on_the_tables(spark, smallest):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{smallest}/pages.parquet").collect()}
    rows = {r["page_id"]: r for r in entries.op2_html_extraction(spark, smallest).collect()}
    assert {i: article(h) for i, h in pages.items()} == {i: r["text"] for i, r in rows.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())


def bare(pages):
    """The pages without any element or name that tells what is the article."""
    html_ = F.regexp_replace("html", r"<(/?)(article|nav|footer)\b[^>]*>", "<$1div>")
    return pages.withColumn("html", F.regexp_replace(html_, '<div class="ad">', "<div>"))


def test_the_tree_alone_finds_the_article_of_a_large_host(spark, smallest):
    pages = spark.read.parquet(smallest.replace("sf0.001", "sf0.1") + "/pages.parquet")
    host = pages.groupBy(site_style.host_of(F.col("url")).alias("h")).count().orderBy(F.desc("count")).first()["h"]
    pages = pages.where(site_style.host_of(F.col("url")) == host)
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    rows = {r["page_id"]: r["text"] for r in site_style.extract(bare(pages)).collect()}
    assert len(want) > 300 and rows == want
    alone = {r["page_id"]: site_style.main_text(r["html"]) for r in bare(pages).collect()}
    assert all(alone[i] != t for i, t in want.items())  # without the tree no page is right


def test_entropies_equal_brute_force(spark):
    rng = np.random.default_rng(12)
    made = []
    for i in range(60):
        items = "".join(f"<li>item {x}</li>" for x in rng.integers(0, 5, rng.integers(1, 4)))
        paragraphs = "".join(f"<p>words {x}</p>" for x in rng.integers(0, 200, rng.integers(1, 5)))
        made.append((i, f"http://h.example/{i}", f"<body><div class='a'><ul>{items}</ul></div><div class='b'>{paragraphs}</div><div class='c'>Call {i % 3}</div></body>"))
    made += [(100 + i, *made[i][1:]) for i in range(20)]  # copies count once
    pages = spark.createDataFrame(made, "page_id long, url string, html string")
    read = [site_style.read_page(h) for _, _, h in made]
    different = {site_style.page_features(p): p for p in read}.values()
    on, texts, styles, parent = Counter(), {}, {}, {}
    for p in different:
        on.update(set(p.nodes))
        for node, up, text in set(zip(p.nodes, p.parents, p.texts)):
            texts.setdefault(node, Counter())[text] += 1
            parent[node] = up
        for up in set(p.parents):
            styles.setdefault(up, Counter()).update(p.styles.get(up, {}))
    want = {}
    for node, counts in texts.items():
        m, own = on[node], styles[parent[node]]
        content = sum(n * np.log(n) / np.log(m) for n in counts.values()) / sum(counts.values())
        total = sum(own.values())
        presentation = -sum(n / total * np.log(n / total) for n in own.values()) / np.log(total)
        want[node] = (m, presentation, content)
    tree, common = site_style.style_tree(site_style.read_pages(pages))
    got = {r["node"]: (r["pages"], r["presentation"], r["content"]) for r in tree.collect()}
    assert got.keys() == want.keys() and len(want) == 3 and all(np.allclose(got[k], want[k]) for k in want)
    assert {r["host_pages"] for r in tree.collect()} == {len(different)}
    known = {x["node"]: x["importance"] for x in site_style.judged(tree, common).first()["known"]}
    assert all(np.isclose(known[k], 0.1 * p + 0.9 * (1 - c)) for k, (_, p, c) in want.items())
    rows = {r["page_id"]: r["text"] for r in site_style.extract(pages).collect()}
    low = {k for k in known if known[k] < site_style.LEAST_IMPORTANCE}
    assert low and rows == {made[i][0]: " ".join(t for t, k in zip(p.texts, p.nodes) if k not in low) for i, p in enumerate(read)}


def test_names_within_an_article(spark):
    inside = "<h1>T</h1><p class='related-work'>Earlier work {0}</p><p id='discussion'>We discuss {0}</p><p class='notice'>Note {0}</p><p><a href='x'>A linked line {0}</a></p>"
    assert html_texts(spark, [f"<article class='post'>{inside.format(i)}</article>" for i in range(3)]) == {i: f"T Earlier work {i} We discuss {i} Note {i} A linked line {i}" for i in range(3)}
    clear = "<div class='comments'><p>First!</p></div><div class='share-bar'>Share</div><div class='ad'>Buy</div><aside>Side</aside><form>Send</form><div class='related'><ul><li><a href='x'>Other</a></li></ul></div>"
    assert site_style.main_text(f"<article>{inside.format(1)}{clear}</article>") == "T Earlier work 1 We discuss 1 Note 1 A linked line 1"
    # the tree agrees that such a branch is the same everywhere, or doesn't
    bodies = [f"<article><p>Own {i}</p><div class='notice'><p>We use this and that</p></div><div class='discussion'><p>Ours {i * 7}</p></div></article>" for i in range(30)]
    assert html_texts(spark, bodies) == {i: f"Own {i} Ours {i * 7}" for i in range(30)}
    assert site_style.main_text("<h1><a href=x>My headline</a></h1><p>Body</p><ul><li><a href=x>Menu</a></li></ul>") == "My headline Body"


def test_broken_tags_are_read_in_linear_time():
    for piece in ('<a "', "<a ", "<!", "<a '\"", "<b x='", "<script>"):
        began = time.perf_counter()
        text = site_style.main_text(f"<p>one</p>{piece * 200_000}")
        assert text.startswith("one") and time.perf_counter() - began < 5, piece
    assert site_style.main_text('<p title="a>b">end <i x="') == 'end <i x="'
    assert site_style.main_text("<p title='a>b' class=\"x\">one</p><p t='>two <b>three</b>") == "one <p t='>two three"


def test_style_tree_removes_what_every_page_has(spark):
    """No article element and no telling names: only the tree can know."""
    made = [(i, f"http://h.example/{i}", f"<html><body><div class='a'><p>Our company news since 1999</p></div><div class='b'><h2>Title {i}</h2><p>Text of page {i} &amp; more</p><p>Only here {i * 7}</p></div><div class='c'><span>Call us today</span></div></body></html>") for i in range(20)]
    rows = site_style.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {i: f"Title {i} Text of page {i} & more Only here {i * 7}" for i in range(20)}


def html_texts(spark, bodies):
    made = [(i, f"http://h.example/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    rows = site_style.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in rows}


def test_near_copies_of_an_article_stay_whole(spark):
    bodies = [f"<p>Call us</p><article><h1>One title</h1><p>A passage that all copies share.</p><p>Copy {i}.</p><p>All rights reserved.</p></article>" for i in range(40)]
    assert html_texts(spark, bodies) == {i: f"One title A passage that all copies share. Copy {i}. All rights reserved." for i in range(40)}


def test_copies_count_once_and_texts_belong_to_nodes(spark):
    own = [f"<div class='t'><p>Call us</p></div><div class='b'><p>Only on {i}</p><p>As well {i}</p></div>" for i in range(20)]
    copies = ["<div class='b'><p>Copied passage</p><p>Call us</p></div>"] * 30
    bare = ["<div class='t'><p>Call us</p></div>"]
    got = html_texts(spark, own + copies + bare)
    assert got == {i: f"Only on {i} As well {i}" for i in range(20)} | {i: "Copied passage Call us" for i in range(20, 50)} | {50: ""}


def test_markup():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><header>Top</header><nav><a href=x>Menu</a></nav><div class="cookie-notice">We use</div>
    <main><h1>A &lt;b&gt;</h1><p>One<b>two</b>  three<br>four<p>Five <script>var a="</p>";</script>six<ul><li>x<li>y</ul><aside>Side</aside><form><input value=1>Send</form><table><tr><td>1<td>2</table></main>
    <div id="comments"><p>First!</p></div><div hidden>Ghost</div><footer>&copy;</footer></body></html>"""
    assert site_style.main_text(page) == "A <b> Onetwo three four Five six x y 1 2"
    assert site_style.main_text("plain text &amp; more") == "plain text & more"
    assert site_style.main_text("<p>a <!-- b > --> c < d") == "a c < d"


def test_deep_pages():
    n = 5_000
    page = "<div><article><p>First</p>" + "<div>" * n + "<nav>Menu</nav><p>Deep</p><aside>Ad</aside>" + "</div>" * n + "<p>Last</p></article><p>Outside</p></div>"
    assert site_style.main_text(page) == "First Deep Last"
    assert site_style.main_text("<p>One<div>" + "<b>" * n + "</p><br>x" * n) == " ".join(["One"] + ["x"] * n)


def test_very_long_texts():
    words = [f"w{i % 700}-{i % 901}".encode() for i in range(docstats.LONG_WORDS + 50_000)] + [b"x"] * 9
    assert docstats._repeated_in_long(words[:5000] + words[100:900]) == docstats.repeated_words(words[:5000] + words[100:900])
    text = b" ".join(words)
    assert docstats.counts(text)[0] == len(words)
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)], dtype="<u8")
    bits = 2 * np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) > len(hashes)
    assert simhash_pivot.fingerprint(text) == int(np.packbits(bits, bitorder="little").view("<u8")[0])
    assert (lang_svm.histogram(text, 1000) == lang_svm.histogram(text)).all()
    assert site_style.main_text("<b>" * 20_000 + "deep" + "</b>" * 20_000 + '<p title="a>b">end <i x="') == 'deep end <i x="'


def test_templated_items():
    """A phrase that all items share anchors none of them, and what an item has of its own is found."""
    rng = np.random.default_rng(6)
    items = [(i, "which of the following is the best description of " + " ".join(f"w{x}" for x in rng.integers(0, 5000, 12))) for i in range(4000)]
    index = decontam.build(items)
    assert max(len(v) for v in index.anchors.values()) < 10
    began = time.perf_counter()
    assert decontam.find("which of the following is the best description of nothing " * 25, index) == []
    assert time.perf_counter() - began < 0.5
    assert 77 in {h[0] for h in decontam.find(f"before {items[77][1]} after", index)}


def test_every_similar_window_has_an_anchor():
    """Brute force over all windows, with items of shared and repeated phrases."""
    rng = np.random.default_rng(9)
    phrase = "the quick answer to all of these questions"
    items = [(i, f"{phrase} " * (i % 3) + " ".join(f"v{x}" for x in rng.integers(0, 60, 6 + i % 5))) for i in range(30)] + [(50, "again " * 9)]
    index = decontam.build(items)
    for _ in range(60):
        i = int(rng.integers(0, 31))
        words = items[i][1].split()
        for k in rng.integers(0, len(words), rng.integers(0, 3)):
            words[k] = f"v{rng.integers(0, 60)}"
        text = " ".join([*(f"v{x}" for x in rng.integers(0, 60, 8)), *words, phrase, "again again"])
        assert {h[0] for h in decontam.find(text, index)} == brute_matches(text, index, decontam.THRESHOLD, decontam.RADIUS)


def test_repetitive_texts():
    index = decontam.build([(1, "again " * 30), (2, "again and again " * 10)])
    began = time.perf_counter()
    hits = decontam.find("again and again " * 70_000, index)
    assert 2 in {h[0] for h in hits} and decontam.find("again " * 200_000, index)[0][:3] == (1, 0, 30)
    assert time.perf_counter() - began < 20


def test_an_index_too_large_to_send_is_refused(spark, monkeypatch):
    bench = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i}") for i in range(50)], "item_id long, text string")
    assert len(decontam.index_of(bench).ids) == 50
    monkeypatch.setattr(decontam, "MOST_INDEX_BYTES", 1000)
    with pytest.raises(ValueError, match="index"):
        decontam.contaminated(bench.withColumnRenamed("item_id", "doc_id"), bench)
    monkeypatch.setattr(decontam, "MOST_BYTES", 100)
    with pytest.raises(ValueError, match="benchmark"):
        decontam.index_of(bench)
