"""SimHash near-duplicates with pivot distance tables.

Equal fingerprints are one class from the start, so copies never meet in a join. For each class the table holds its
Hamming distances to reference fingerprints (pivots). By the triangle inequality a pair within the radius differs by no
more than the radius in every coordinate; a pair that differs by more in one is discarded, and the rest are verified
on the fingerprints. Pairs come from an equi-join on 4 of 6 blocks of the bits (two differing bits touch two blocks at
most), so that no link is missed and no pair of strangers is formed. Blocks that very many classes share are not
paired at all: their classes meet on the points at distance one instead, of which no more than 65 classes ever share
one.

A radius of two is narrow: a copy with one word in twenty changed lies eight bits away. Where only one document of each
group is to stay, classes can be linked by their segments as well (``alike``): a text is cut behind words whose hash says
so, so that a changed word changes one segment or two, and classes are linked that have a share of their segments in
common. Segments are ordered by rarity; of two such classes both have a common segment in their prefix (prefix filtering),
where each class is compared with a few leaders of the segment, so that the copies of a text are connected without all
their pairs. Only classes that are in different components after that are compared with each other, and then all of them."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ._common import discard, materialize, slices
from .components import components

RADIUS = 2
SEED = 42
#: Bit ranges of the six blocks; a key has four of them.
BLOCKS = ((0, 11), (11, 22), (22, 33), (33, 44), (44, 54), (54, 64))
#: More classes than this in a block key, and they are linked over the points at distance one.
CROWD = 64
#: A segment ends behind a word of this share (1 / SEGMENT_WORDS); classes of fewer segments have no links of this kind;
#: leaders of a segment, by the order of fingerprints under these masks.
SEGMENT_WORDS, LEAST_SEGMENTS = 4, 6
LEADERS = (0, 0x5555555555555555, -0x5555555555555556)
#: Share of segments in common from which the pipeline takes documents for copies.
SIMILAR = 0.45
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Sixteen pivots, spread over the space: rows of a Hadamard code, so that any two differ in 32 bits.
PIVOTS = tuple(sum((bin(i & r).count("1") & 1) << i for i in range(64)) for r in (0, 1, 2, 4, 8, 16, 32, 63, 3, 12, 48, 21, 42, 7, 56, 27))


def fingerprint(text: bytes | None) -> int:
    """The 64 bits of a text: 3-word shingles with repeats, each bit set in over half of their hashes. 0 if no words."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < 3:
        words = [b" ".join(words), b"", b""]  # a single shingle
        joined = lambda a, b, c: a
    else:
        joined = lambda a, b, c: b"%b %b %b" % (a, b, c)
    total, n, h = np.zeros(64, dtype=np.int64), len(words) - 2, xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        part = words[at : at + (1 << 16) + 2]
        hashes = np.array([h(joined(*s), SEED) for s in zip(part, part[1:], part[2:])], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""

    def run(batches):
        for batch in slices(batches, "_text"):
            fp = np.array([fingerprint(x) for x in batch.column("_text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("_text")).mapInArrow(run, "doc_id long, fp long")


class Segmenter:
    """Hashes of the segments of texts; which words end one is kept for the last words met."""

    def __init__(self):
        self.ends: dict[bytes, bool] = {}

    def __call__(self, text: bytes | None) -> list[int]:
        """The different segments of a text, sorted."""
        words, ends, h = (text or b"").translate(_LOWER).split(), self.ends, xxhash.xxh64_intdigest
        if len(ends) > 500_000:
            ends.clear()
        for w in set(words).difference(ends):
            ends[w] = h(w, 7) % SEGMENT_WORDS == 0
        out, at = set(), 0
        for i, w in enumerate(words, 1):
            if ends[w]:
                out.add(h(b" ".join(words[at:i]), SEED))
                at = i
        if at < len(words):
            out.add(h(b" ".join(words[at:]), SEED))
        return sorted(out)


def _sketch(batches):
    segments = Segmenter()
    for batch in slices(batches, "_text"):
        texts = batch.column("_text").to_pylist()
        fp = np.array([fingerprint(x) for x in texts], dtype=np.uint64).view(np.int64)
        own = [np.array(segments(x), dtype=np.uint64).view(np.int64) for x in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp), pa.array(own, pa.list_(pa.int64()))], ["doc_id", "fp", "segments"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, fp and segments (hashes) of every row, in one pass over the texts."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("_text")).mapInArrow(_sketch, "doc_id long, fp long, segments array<long>")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(blocks) -> int:
    return _signed(sum(((1 << b) - 1) ^ ((1 << a) - 1) for a, b in blocks))


def pivot_table(fp) -> list[F.Column]:
    """Distances to the pivots, one byte each, in longs t0, t1, ... of eight."""
    out = []
    for at in range(0, len(PIVOTS), 8):
        parts = [F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long"), 8 * i) for i, p in enumerate(PIVOTS[at : at + 8])]
        out.append(reduce(lambda a, b: a.bitwiseOR(b), parts).alias(f"t{at // 8}"))
    return out


def _close(a: str, b: str, radius: int):
    """The pivot test, coordinate by coordinate, then the distance itself."""
    byte = lambda side, i: F.shiftrightunsigned(F.col(f"{side}.t{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(255))
    tests = [F.abs(byte(a, i) - byte(b, i)) <= radius for i in range(len(PIVOTS))]
    return reduce(lambda x, y: x & y, tests) & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= radius)


def links(classes: DataFrame, radius: int = RADIUS, crowd: int = CROWD, used: list | None = None) -> DataFrame:
    """All pairs (a, b), a < b, of distinct fingerprints within the radius (0, 1 or 2). classes: a column fp. used: gets the
    written tables that the pairs are read from."""
    if not 0 <= radius <= 2:
        raise ValueError("the blocks guarantee a radius of 2 at most")
    masks = [_mask(c) for c in combinations(BLOCKS, 4)]
    # a key is 64 hashed bits of (which blocks, their bits); a chance collision only adds a pair that is then tested
    keys = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)]))
    keyed = classes.select("fp", keys.alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = materialize(sizes, "block-sizes")
    shared = keyed.join(sizes, "key").select("key", "fp", "n")
    shared = materialize(shared, "block-members")
    if used is not None:
        used += [sizes, shared]
    few = shared.where(F.col("n") <= crowd).select("key", "fp", *pivot_table(F.col("fp")))
    pairs = few.alias("a").join(few.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & _close("a", "b", radius))
    pairs = pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    if not sizes.where(F.col("n") > crowd).isEmpty():
        many = shared.where(F.col("n") > crowd).select("fp").distinct()
        flips = F.explode(F.concat(F.array(F.col("fp")), F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])))
        points = many.select("fp", *pivot_table(F.col("fp")), flips.alias("point"))
        met = points.alias("a").join(points.alias("b"), (F.col("a.point") == F.col("b.point")) & (F.col("a.fp") < F.col("b.fp")) & _close("a", "b", radius))
        pairs = pairs.union(met.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
    return pairs.distinct()


def _verified(pairs: DataFrame, full: DataFrame, similar: float) -> DataFrame:
    """Of pairs (x, y) of ids the different fingerprints (a, b), a < b, of those that have the share in common. The segments of
    x are shuffled for each pair, those of y only once, so that y may be in very many pairs."""
    one = pairs.join(full.select(F.col("id").alias("x"), F.col("fp").alias("fx"), F.col("segments").alias("sx")), "x")
    both = one.join(full.select(F.col("id").alias("y"), F.col("fp").alias("fy"), F.col("segments").alias("sy")), "y")
    common = F.size(F.array_intersect("sx", "sy"))
    found = both.where((F.col("fx") != F.col("fy")) & (common >= F.lit(similar) * (F.size("sx") + F.size("sy") - common)))
    return found.select(F.least("fx", "fy").alias("a"), F.greatest("fx", "fy").alias("b")).distinct()


def _named(ids: DataFrame, linked: DataFrame) -> DataFrame:
    """id and root, a fingerprint of the component that the id's fingerprint has by these links."""
    roots = components(linked.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "fp")
    return materialize(ids.join(roots, "fp", "left").select("id", F.coalesce("root", "fp").alias("root")), "named")


def _unmet(rare: DataFrame, named: DataFrame, similar: float, block: int, used: list) -> DataFrame:
    """All pairs (x, y) of a common segment that aren't in one component and aren't ruled out by their sizes, nor by how many
    segments they have from their first common one on. A segment of many is spread over tasks, a block of members against a block."""
    rooted = rare.join(named, "id").select("id", "n", "rest", "s", "root")
    several = rooted.groupBy("s").agg(F.count("*").alias("members"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1")
    left = rooted.join(several.select("s", F.ceil(F.col("members") / block).cast("int").alias("parts")), "s")
    left = materialize(left.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "open-segments")
    used.append(left)
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    x = left.select("s", F.col("part").alias("p"), every.alias("q"), "id", "n", "rest", "root").alias("x")
    y = left.select("s", every.alias("p"), F.col("part").alias("q"), "id", "n", "rest", "root").alias("y")
    total = F.col("x.n") + F.col("y.n")
    near = (F.least("x.n", "y.n") >= similar * F.greatest("x.n", "y.n") - 1e-9) & (F.least("x.rest", "y.rest") >= similar / (1 + similar) * total - 1e-9)
    same = reduce(lambda a, b: a & b, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("s", "p", "q")])
    pairs = x.join(y, same & (F.col("x.id") < F.col("y.id")) & (F.col("x.root") != F.col("y.root")) & near)
    return pairs.select(F.col("x.id").alias("x"), F.col("y.id").alias("y")).distinct()


def alike(classes: DataFrame, similar: float = SIMILAR, used: list | None = None, linked: DataFrame | None = None, block: int = 2048) -> DataFrame:
    """Pairs (a, b), a < b, of fingerprints whose classes have ``similar`` of their segments in common: enough of them that,
    with the pairs ``linked``, all such classes are connected. classes: fp, segments, different rows. used: as for ``links``.

    Only classes of which so many segments are shared with any other can be in such a pair, and both have a common segment in
    their prefix. Each class first meets the leader that it has most of these in common with, then the other leaders that
    aren't in its component yet. What is still in several components meets pair by pair (``_unmet``)."""
    used = [] if used is None else used
    # a chance collision of ids only mixes two prefixes
    full = classes.where(F.size("segments") >= LEAST_SEGMENTS).select(F.xxhash64("fp", "segments").alias("id"), "fp", F.size("segments").alias("n"), "segments")
    ids = full.select("id", "fp")
    postings = full.select("id", "n", F.explode("segments").alias("s"))
    shared = postings.withColumn("df", F.count("*").over(Window.partitionBy("s"))).where("df > 1")
    by_id = Window.partitionBy("id")
    # in the order of rarity the unshared segments come first
    placed = shared.withColumn("at", F.row_number().over(by_id.orderBy("df", "s"))).withColumn("own", F.count("*").over(by_id))
    rare = placed.where(F.col("at") <= F.floor((1 - similar) * F.col("n") + 1e-9) + 1 - (F.col("n") - F.col("own")))
    rare = materialize(rare.select("id", "n", (F.col("own") - F.col("at") + 1).alias("rest"), "s"), "rare-segments")
    # the least id under a mask leads; masks are undone by themselves
    heads = rare.groupBy("s").agg(F.count("*").alias("members"), *[F.min(F.col("id").bitwiseXOR(F.lit(m))).bitwiseXOR(F.lit(m)).alias(f"h{i}") for i, m in enumerate(LEADERS)]).where("members > 1")
    met = rare.join(heads, "s").select(F.col("id").alias("x"), F.explode(F.array_distinct(F.array(*[f"h{i}" for i in range(len(LEADERS))]))).alias("y")).where("x <> y")
    pairs = materialize(met.groupBy("x", "y").agg(F.count("*").alias("times")), "segment-pairs")
    best = pairs.groupBy("x").agg(F.max(F.struct("times", "y")).alias("m")).select("x", "m.y")
    found = materialize(_verified(best, full, similar), "best-links")
    used += [rare, pairs, found]
    known = found if linked is None else linked.union(found)
    named = _named(ids, known)
    apart = pairs.join(named.select(F.col("id").alias("x"), F.col("root").alias("rx")), "x").join(named.select(F.col("id").alias("y"), F.col("root").alias("ry")), "y")
    more = materialize(_verified(apart.where("rx <> ry").select("x", "y"), full, similar), "leader-links")
    again = _named(ids, known.union(more))
    candidates = materialize(_unmet(rare, again, similar, block, used), "unmet")
    used += [named, more, again, candidates]
    return found.union(more).union(_verified(candidates, full, similar))


def _classes(docs: DataFrame, radius: int, crowd: int, similar: float | None = None) -> tuple[DataFrame, DataFrame]:
    """doc_id and fp of every row; and for every fp its n_near, its component_id, and root, one fp of its component.
    similar: components are also of classes linked by their segments (n_near isn't)."""
    read = materialize(fingerprints(docs) if similar is None else sketches(docs), "fingerprints")
    fps = read.select("doc_id", "fp")
    classes = materialize(fps.groupBy("fp").agg(F.count("*").alias("size"), F.min("doc_id").alias("first")), "classes")
    used = [classes]
    pairs = materialize(links(classes.select("fp"), radius, crowd, used), "links")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(classes.select(F.col("fp").alias("b"), "size"), "b").groupBy("a").agg(F.sum("size").alias("more"))
    linked = pairs
    if similar is not None:  # equal fingerprints can be of different texts, each of which has links
        own = materialize(read.select("fp", "segments").distinct(), "class-segments")
        linked = materialize(pairs.union(alike(own, similar, used, pairs)), "all-links")
        used += [own, linked]
    roots = components(linked.select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = roots.join(classes.select(F.col("fp").alias("node"), "first"), "node")
    heads = named.groupBy("root").agg(F.min("first").alias("head"))
    of = named.join(heads, "root").select(F.col("node").alias("fp"), "head", "root")
    full = classes.join(near.withColumnRenamed("a", "fp"), "fp", "left").join(of, "fp", "left").select(
        "fp", (F.col("size") - 1 + F.coalesce(F.col("more"), F.lit(0))).alias("n_near"), F.when(F.col("root").isNotNull(), F.col("head")).otherwise(F.col("first")).alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    full = materialize(full, "class-rows")
    for table in [*used, pairs]:
        discard(table)
    return fps, full


def near_duplicates(docs: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), n_near, component_id.

    n_near counts the other rows linked directly, those of the same fingerprint included; component_id is the smallest
    doc_id that is reachable. Null and empty texts have fingerprint 0 and are linked like any other. Rows with a null
    doc_id take part, but never name a component (null if no member has an id). Repeated rows count as rows; other
    columns of ``docs`` are ignored; an empty table gives an empty result."""
    fps, full = _classes(docs, radius, crowd)  # one row per class; AQE splits the documents of a hot one
    return fps.join(full, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "n_near", "component_id")


def keep_representatives(docs: DataFrame, radius: int = RADIUS, crowd: int = CROWD, similar: float | None = None) -> DataFrame:
    """One row of each component, of its smallest doc_id, with all columns of ``docs``. similar: also link documents that
    have this share of their segments in common (``alike``).

    Of a component whose rows all lack an id, or that has rows repeated with its smallest id, one of those stays."""
    fps, full = _classes(docs, radius, crowd, similar)
    found = fps.join(full, "fp")
    n = fps.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if n["rows"] == n["ids"]:
        gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "gone")
        return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")

    def run(batches):
        for batch in slices(batches, "_text"):
            fp = np.array([fingerprint(x) for x in batch.column("_text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(fp)], ["_row", "fp"])

    # ids don't tell the rows apart, so each is found by its fingerprint
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    carried = docs.select(row, F.col("text").cast("binary").alias("_text"))
    schema = StructType([carried.schema["_row"], StructField("fp", LongType())])
    kept = carried.mapInArrow(run, schema).join(full, "fp").where(F.col("_row.doc_id").eqNullSafe(F.col("component_id")))
    return kept.dropDuplicates(["root"]).select("_row.*")
