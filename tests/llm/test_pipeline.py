"""The pipeline's stages against brute force, and on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelspark.llm import decontam, docstats, pfair_mix, quality_gbt, quality_qda, simhash_pivot

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, smallest, tmp_path_factory):
    """Input and output rows of every stage, each written and reread as the driver does."""
    docs, out, root = spark.read.parquet(f"{smallest}/documents.parquet"), {}, tmp_path_factory.mktemp("stages")
    for name, f in corpus_pipeline.STAGES:
        before = docs
        f(spark, docs, smallest).write.parquet(f"file://{root}/{name}")
        docs = spark.read.parquet(f"file://{root}/{name}")
        out[name] = before, docs
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def counts(t):
    return np.array([docstats.counts((t or "").encode())], dtype=np.float64)


def test_names_and_columns(stages, spark, smallest):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_dedup", "decontamination", "source_mix"]
    columns = spark.read.parquet(f"{smallest}/documents.parquet").columns
    assert all(stages[n][1].columns == columns for n in list(STAGES)[:-1]) and stages["source_mix"][1].columns == [*columns, "block", "slot", "position"]
    assert all(0 < out.count() <= before.count() for before, out in stages.values())


def test_quality_stages(stages, spark, smallest):
    docs, labels = (spark.read.parquet(f"{smallest}/{n}.parquet") for n in ("documents", "labels"))
    model = quality_qda.train(docs, labels)
    before, out = stages["quality_classifier"]
    assert ids(out) == sorted(i for i, t in texts(before).items() if model.score(counts(t))[0] >= 0.7)
    forest = quality_gbt.train(docs, labels)
    before, out = stages["quality_rules"]
    c = {i: counts(t) for i, t in texts(before).items()}
    assert ids(out) == sorted(i for i, x in c.items() if x[0, 0] >= 50 and 100 * x[0, 4] <= 50 * x[0, 0] and forest.score(docstats.ratios(x))[0] >= 0.5)


def test_near_dedup(stages):
    before, out = stages["near_dedup"]
    cut, t = simhash_pivot.Segmenter(), texts(before)
    fp = {i: simhash_pivot.fingerprint(x.encode()) for i, x in t.items()}
    own = {i: set(cut(x.encode())) for i, x in t.items()}

    def linked(i, j):
        few = min(len(own[i]), len(own[j])) < simhash_pivot.LEAST_SEGMENTS
        return bin(fp[i] ^ fp[j]).count("1") <= 2 or (not few and len(own[i] & own[j]) >= simhash_pivot.SIMILAR * len(own[i] | own[j]))

    seen, kept = set(), []
    for i in sorted(t):
        if i in seen:
            continue
        kept.append(i)
        todo = [i]
        seen.add(i)
        while todo:
            k = todo.pop()
            new = {j for j in t if j not in seen and linked(k, j)}
            seen |= new
            todo += new
    assert ids(out) == kept and len(kept) < len(t)


def test_decontamination(stages, spark, smallest):
    before, out = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{smallest}/benchmark.parquet").collect()]
    index = decontam.build(items)
    bare = [b" ".join(decontam.words_of(b)) for _, b in items]
    kept = set(ids(out))
    for i, t in texts(before).items():
        assert (i in kept) == (not decontam.find(t, index))
        if any(b in b" ".join(decontam.words_of(t)) for b in bare):
            assert i not in kept


def test_source_mix(stages):
    before, out = stages["source_mix"]
    rows = sorted(out.collect(), key=lambda r: r["position"])
    assert ids(before) == sorted(r["doc_id"] for r in rows) and len({r["position"] for r in rows}) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + 1
    phases = pfair_mix.plan({s: -(-n // pfair_mix.BLOCK) for s, n in sizes.items()}, pfair_mix.whole_weights({s: pfair_mix.WEIGHTS.get(s, 1) for s in sizes}))
    want = {}
    for k, ph in enumerate(phases):
        for s, own in ph.orders.items():
            stop = phases[k + 1].first[s] if k + 1 < len(phases) else -(-sizes[s] // pfair_mix.BLOCK)
            want |= {(s, j): ph.start + (j - ph.first[s]) // len(own) * ph.period + own[(j - ph.first[s]) % len(own)] for j in range(ph.first[s], stop)}
    assert {(r["source"], r["block"]): r["slot"] for r in rows} == want


def test_run_is_the_stages(stages, spark, smallest):
    out = corpus_pipeline.run(spark, smallest)
    assert sorted(map(tuple, out.select("doc_id", "source", "slot", "position").collect())) == sorted(map(tuple, stages["source_mix"][1].select("doc_id", "source", "slot", "position").collect()))


ODD = "doc_id long, text string, lang string, source string, n_chars int, fp long, segments string, _row string, kept boolean, slot int"


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_rows(spark, smallest, name):
    """Nulls in every column, empty and long texts, repeated rows, clashing names, and no rows at all."""
    good = spark.read.parquet(f"{smallest}/documents.parquet").orderBy(F.desc("n_chars")).first()["text"]
    rows = [(1, good, "en", "a", 1, 1, "x", "y", True, 1), (1, good, "en", "a", 1, 1, "x", "y", True, 1), (2, "", "en", "a", 0, None, None, None, None, None), (3, None, None, None, None, None, None, None, None, None)]
    rows += [(None, good + " more", "en", "b", 1, 1, "x", "y", True, 1), (4, "word " * 200_000, "en", "b", 1, 1, "x", "y", True, 1), (None, None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, ODD)
    out = STAGES[name](spark, docs, smallest)
    got = out.collect()
    if name == "source_mix":
        assert len(got) == len(rows) and set(docs.columns) - {"slot"} <= set(out.columns)
    else:
        assert out.columns == docs.columns and len(got) <= len(rows)
        assert {(r["doc_id"], r["text"]) for r in got} <= {r[:2] for r in rows}
    if name == "near_dedup":
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, 1), (False, 2), (False, 4)]
    assert STAGES[name](spark, docs.where(F.lit(False)), smallest).count() == 0
