"""Benchmark decontamination over SimHash windows.

Texts are lower-cased word sequences, without punctuation. A window can only be similar to an item if their common
3-word shingles have THRESHOLD times the item's weight. So each item is anchored by its rarest shingles: the commonest
ones that together weigh less than that are left out, and a window without an anchor is passed over without loss.
Wherever a document has an anchor, the window of the item's own length that puts the two shingles on each other is
weighed, and fingerprinted if its common shingles suffice. Fingerprints are looked up in a multi-index: with eight blocks
of eight bits, two fingerprints within RADIUS = 23 bits differ by two bits at most in some block, so the buckets of all
block values within two bits guarantee every item in the radius. Candidates are verified by the exact weighted Jaccard
similarity of the two multisets of shingles. The benchmark is small; what is sent to all executors is measured and
bounded. Documents are read once and never shuffled."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RADIUS = 23
THRESHOLD = 0.4
#: Most bytes of benchmark text that the driver gathers, and of the index made of it, as it is sent to every executor.
MOST_BYTES = 32 << 20
MOST_INDEX_BYTES = 256 << 20
OUT = "doc_id long, item_ids array<long>, similarity double, matches array<struct<item_id: long, start: long, words: long, similarity: double>>"
#: Punctuation beyond ASCII, and a table that turns all other ASCII but letters, digits and _ into spaces.
_ODD = re.compile("[\u00a0-\u00bf\u00d7\u00f7\u2000-\u206f\u2190-\u2bff\u3000-\u303f\uff00-\uff0f\uff1a-\uff20]")
_TABLE = bytes(i if i >= 128 or chr(i).isalnum() or chr(i) == "_" else 32 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    if not text:
        return []
    t = text.lower()
    return (t if t.isascii() else _ODD.sub(" ", t)).encode("utf-8", "replace").translate(_TABLE).split()


def shingles(words: list[bytes]) -> Counter:
    """Multiset of 3-word shingles; of fewer words the whole sequence."""
    return Counter(zip(words, words[1:], words[2:])) if len(words) > 2 else Counter([tuple(words)] if words else [])


#: The block values within RADIUS // 8 bits of each.
_NEAR = [np.flatnonzero(row) for row in np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= RADIUS // 8]


@dataclass
class Index:
    """Everything that is known of the items. order[b]: items by the value of block b; those of value v are at
    starts[b][v]..starts[b][v + 1] - 1."""

    ids: list[int]
    words: list[list[bytes]]
    idf: dict[tuple, float]
    rare: float
    bags: list[Counter] = field(default_factory=list)
    anchors: dict[tuple, list[tuple[int, int]]] = field(default_factory=dict)
    masses: list[float] = field(default_factory=list)
    prints: np.ndarray | None = None
    order: np.ndarray | None = None
    starts: np.ndarray | None = None
    sizes: list[int] = field(default_factory=list)
    hashes: dict[tuple, np.ndarray] = field(default_factory=dict)

    def weight(self, shingle: tuple) -> float:
        """Shingles that many items share weigh little."""
        return self.idf.get(shingle, self.rare)

    def bits(self, shingle: tuple) -> np.ndarray:
        found = self.hashes.get(shingle)
        if found is None:
            if len(self.hashes) > 200_000:
                self.hashes.clear()
            h = np.array([xxhash.xxh64_intdigest(b" ".join(shingle), 11)], dtype="<u8")
            found = self.hashes[shingle] = (2.0 * np.unpackbits(h.view(np.uint8), bitorder="little") - 1) * self.weight(shingle)
        return found

    def simhash(self, bag: Counter) -> np.ndarray:
        """The fingerprint of a bag as eight bytes."""
        total = np.zeros(64)
        for s, n in bag.items():
            total += n * self.bits(s)
        return np.packbits(total > 0, bitorder="little")

    def similarity(self, a: Counter, b: Counter) -> float:
        common = sum(min(n, b[s]) * self.weight(s) for s, n in a.items() if s in b)
        both = sum(n * self.weight(s) for s, n in a.items()) + sum(n * self.weight(s) for s, n in b.items()) - common
        return common / both if both else 0.0

    def candidates(self, print_: np.ndarray, radius: int) -> np.ndarray:
        """Items within the radius (RADIUS at most): those in a bucket near some block, then by the distance itself."""
        some = [self.order[b][self.starts[b][v] : self.starts[b][v + 1]] for b in range(8) for v in _NEAR[print_[b]].tolist()]
        some = np.unique(np.concatenate(some)) if len(self.ids) else np.zeros(0, dtype=np.int64)
        distance = np.bitwise_count(self.prints[some] ^ print_).sum(axis=1)
        return some[distance <= radius]


def anchored(bag: Counter, index: Index, mass: float, threshold: float) -> set[tuple]:
    """The shingles of an item without the lightest ones that together weigh less than ``threshold`` of it."""
    spare, out = threshold * mass - 1e-9, set(bag)
    for s in sorted(bag, key=lambda s: (index.weight(s), s)):
        spare -= bag[s] * index.weight(s)
        if spare <= 0:
            break
        out.discard(s)
    return out


def build(items: list[tuple[int, str]], threshold: float = THRESHOLD) -> Index:
    """The index of all items. Items without a word are never found; those of one or two words are found by their whole
    text."""
    kept = [(i, w) for i, t in items if (w := words_of(t))]
    bags = [shingles(w) for _, w in kept]
    seen = Counter(s for bag in bags for s in bag)
    n = len(bags) + 1
    index = Index([i for i, _ in kept], [w for _, w in kept], {s: float(np.log1p(n / k)) for s, k in seen.items()}, float(np.log1p(n)), bags)
    index.masses = [sum(k * index.weight(s) for s, k in b.items()) for b in bags]
    for at, (_, w) in enumerate(kept):
        size, own = min(3, len(w)), anchored(bags[at], index, index.masses[at], threshold)
        for q in range(len(w) - size + 1):
            if (gram := tuple(w[q : q + size])) in own:
                index.anchors.setdefault(gram, []).append((at, q))
    index.sizes = sorted({len(k) for k in index.anchors})
    index.prints = np.stack([index.simhash(b) for b in bags]) if bags else np.zeros((0, 8), dtype=np.uint8)
    index.order = np.stack([np.argsort(index.prints[:, b], kind="stable") for b in range(8)]).astype(np.int32)
    index.starts = np.stack([np.searchsorted(np.sort(index.prints[:, b]), np.arange(257)) for b in range(8)]).astype(np.int32)
    index.hashes.clear()
    return index


def _windows(words: list[bytes], index: Index, threshold: float) -> set[tuple[int, int]]:
    """(first word, words) of the windows whose shingles in common with an item can reach the threshold."""
    anchors, hits, out = index.anchors, {}, set()
    for size in index.sizes:
        for p, gram in [x for x in enumerate(zip(*(words[k:] for k in range(size)))) if x[1] in anchors]:
            for at, q in anchors[gram]:
                hits.setdefault(at, set()).add(p - q)
    for at, found in hits.items():
        bag, n = index.bags[at], min(len(index.words[at]), len(words))
        size = min(3, len(index.words[at]))
        weigh = lambda part: [index.weight(g) if g in bag else 0.0 for g in zip(*(part[k:] for k in range(size)))]
        least = threshold * index.masses[at] - 1e-9
        starts = {max(min(s, len(words) - n), 0) for s in found}
        if len(starts) * n < len(words):
            out |= {(s, n) for s in starts if sum(weigh(words[s : s + n])) >= least}
        else:
            sums = [0.0, *accumulate(weigh(words))]
            out |= {(s, n) for s in starts if sums[max(s, min(s + n - size + 1, len(sums) - 1))] - sums[min(s, len(sums) - 1)] >= least}
    return out


def find(text: str | None, index: Index, radius: int = RADIUS, threshold: float = THRESHOLD) -> list[tuple[int, int, int, float]]:
    """(item_id, first word, words, similarity): for each item its most similar window in the text, if verified."""
    words = words_of(text)
    best: dict[int, tuple[float, int, int]] = {}
    known: dict[tuple, list[tuple[int, float]]] = {}  # windows of the same words are verified once
    for start, n in sorted(_windows(words, index, threshold)):
        part = tuple(words[start : start + n])
        verified = known.get(part)
        if verified is None:
            bag = shingles(list(part))
            near = [(at, index.similarity(bag, index.bags[at])) for at in index.candidates(index.simhash(bag), radius).tolist()]
            verified = known[part] = [(at, s) for at, s in near if s >= threshold]
        for at, s in verified:
            if at not in best or (s, -start) > (best[at][0], -best[at][1]):
                best[at] = (s, start, n)
    return [(index.ids[at], start, n, s) for at, (s, start, n) in sorted(best.items())]


def index_of(benchmark: DataFrame, threshold: float = THRESHOLD) -> Index:
    """The index of a benchmark, with both its text and itself of a checked size; its items in the order of ids."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    if size > MOST_BYTES:
        raise ValueError(f"a benchmark of {size} bytes is too large to be gathered")
    rows = sorted(((r["item_id"], r["text"]) for r in items.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return build(rows, threshold)


def shipped_index(benchmark: DataFrame, threshold: float):
    """The index as a broadcast of checked size."""
    index = index_of(benchmark, threshold)
    if (size := len(pickle.dumps(index, pickle.HIGHEST_PROTOCOL))) > MOST_INDEX_BYTES:
        raise ValueError(f"an index of {size} bytes is too large to be sent to all executors")
    return benchmark.sparkSession.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document that holds a benchmark item: doc_id, item_ids, the highest similarity, and the matches
    (for each item its most similar window: first word, words, similarity).

    Null, empty and wordless texts and items match nothing. A null doc_id stays null; repeated rows are judged each;
    equal items are all reported; other columns are ignored; empty tables give an empty result."""
    shipped = shipped_index(benchmark, threshold)

    def run(batches):
        for batch in batches:
            ids, found = [], []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist()):
                hits = find(t, shipped.value, radius, threshold)
                if hits:
                    ids.append(i)
                    found.append(hits)
            keys = ("item_id", "start", "words", "similarity")
            match = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("words", pa.int64()), ("similarity", pa.float64())]))
            arrays = [pa.array(ids, pa.int64()), pa.array([[x[0] for x in h] for h in found], pa.list_(pa.int64())), pa.array([max(x[3] for x in h) for h in found], pa.float64()), pa.array([[dict(zip(keys, x)) for x in h] for h in found], match)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_ids", "similarity", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text")).mapInArrow(run, OUT)


def keep_clean(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no benchmark item, with all columns of ``docs``."""
    shipped = shipped_index(benchmark, threshold)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            yield batch.filter(pa.array([not find(t, shipped.value, radius, threshold) for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
