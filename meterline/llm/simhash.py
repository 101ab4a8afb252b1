"""Near copies by SimHash: 64-bit fingerprints that differ in few bits, found with vantage-point trees.

1. Every three words of a text, repeats included, are hashed; a bit of the fingerprint is set if it is set in
   over half of the hashes. Equal fingerprints are one *point*.
2. Points are dealt to shards by vantage-point trees, grown from a bounded sample: those within a radius of
   the vantage point go inside, the others outside. A point at most ``RADIUS`` beyond the radius also goes
   inside, so by the triangle inequality two points that are linked meet in one shard at least. Shards
   that turn out too large are split again, until all fit in a task.
3. A task prunes its shard by trees in the same way, down to few points, and compares those. Only a star for
   each group of linked points leaves the task, not all of its pairs.
4. Points too close to each other for any radius to part them are linked by what they have in common:
   two points differ in at most two bits if one point lies within one bit of both.
5. Stars of all shards are joined to components by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.batches import bound_batches, over_batches
from meterline.llm.graph import components
from meterline.operators.lookup import attach_rows
from meterline.sources.scratch import stored

SHINGLE = 3
SEED = 42
RADIUS = 2
#: a shard that is not split any more has a 256th of the points, within these bounds
SHARES, LEAST_SHARD, MOST_SHARD = 256, 4_096, 262_144
#: trees are grown from an eighth of the points of each large shard at most, and from so many over all shards of a round
SAMPLED, SAMPLE = 1 / 8, 65_536
#: ... and for one shard from so many at least, if it has them
LEAST_SAMPLE = 256
#: vantage points tried for a split, and points of a leaf whose pairs are all compared
TRIED = 4
LEAF = 128
#: a split that leaves more than this share of the points on one side parts nothing
PARTED = 0.9
#: hashes whose bits are added up at once: the sums fit in a byte
ADDED = 255


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text, an unsigned number. A text of fewer words is one shingle; of none, zero."""
    words = text.lower().split()  # ASCII letters and white space only, as these are bytes
    if not words:
        return 0
    joined, one = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return one(joined, seed)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1]
    pairs = zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist())
    hashes = np.array([one(joined[a:b], seed) for a, b in pairs], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), ADDED * 256):
        bits = np.unpackbits(hashes[first : first + ADDED * 256].view(np.uint8), bitorder="little")
        lanes = np.add.reduceat(bits.view(np.uint64).reshape(-1, 8), np.arange(0, len(bits) // 64, ADDED), axis=0)
        counts += lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text) to doc_id and the fingerprint's 64 bits as a long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint((text or "").encode(), shingle, seed) for text in batch["text"].to_pylist()]
        points = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch["doc_id"], points], ["doc_id", "point"])

    return over_batches(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, point long")


# --- vantage-point trees ----------------------------------------------------------------------------


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int64)


def best_split(points: np.ndarray, radius: int, tried: int = TRIED) -> tuple[np.uint64, int, int] | None:
    """Vantage point, the farthest distance that is inside, and the larger side's points with the overlap;
    None where nothing is parted. Evenly spaced points are tried; the smallest sum of squares wins."""
    best = None
    for vantage in points[:: max(1, len(points) // tried)][:tried]:
        below = np.cumsum(np.bincount(distances(points, vantage), minlength=65 + radius))
        inside, outside = below[radius : 65 + radius].astype(np.float64), (len(points) - below[:65]).astype(np.float64)
        cost = inside**2 + outside**2
        at = int(np.argmin(cost))
        if best is None or cost[at] < best[0]:
            best = cost[at], vantage, at, int(max(inside[at], outside[at]))
    return best[1:] if best is not None and best[3] <= PARTED * len(points) else None


def grow(points: np.ndarray, radius: int, most: float) -> list | int:
    """A tree over a sample: [vantage, distance, inside, outside], or a leaf, the number of sampled points
    there, negative where it is still above ``most`` but not to be parted."""
    if len(points) <= most:
        return len(points)
    split = best_split(points, radius)
    if split is None:
        return -len(points)
    vantage, within, _ = split
    d = distances(points, vantage)
    return [vantage, within, grow(points[d <= within + radius], radius, most), grow(points[d > within], radius, most)]


def route(tree: list | int, points: np.ndarray, rows: np.ndarray, radius: int, out: list, dense: bool = False) -> None:
    """Put (rows of points, whether the leaf is dense) of each leaf into ``out``, in the order of leaves."""
    if isinstance(tree, int):
        out.append((rows, tree < 0))
        return
    vantage, within, inside, outside = tree
    d = distances(points[rows], vantage)
    route(inside, points, rows[d <= within + radius], radius, out)
    route(outside, points, rows[d > within], radius, out)


def midpoint_links(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links by common points within one bit: each holder of such a point with the first of its holders."""
    masks = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)))
    keys = (points[:, None] ^ masks).reshape(-1)
    holder = np.repeat(np.arange(len(points)), 65)
    order = np.lexsort((holder, keys))
    keys, holder = keys[order], holder[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    first = holder[new][np.cumsum(new) - 1]
    linked = first != holder
    return first[linked], holder[linked]


def links_within(points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct points that join all pairs at most ``radius`` bits apart, as places in ``points``."""
    found, todo = [(np.zeros(0, np.int64),) * 2], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        split = best_split(points[rows], radius) if len(rows) > LEAF else None
        if split is not None:
            d = distances(points[rows], split[0])
            todo += [rows[d <= split[1] + radius], rows[d > split[1]]]
        elif len(rows) > 16 * LEAF and radius == 2:
            a, b = midpoint_links(points[rows])
            found.append((rows[a], rows[b]))
        else:
            for first in range(0, len(rows), LEAF):
                near = np.bitwise_count(points[rows[first : first + LEAF], None] ^ points[rows]) <= radius
                a, b = np.nonzero(near)
                later = a + first < b
                found.append((rows[a[later] + first], rows[b[later]]))
    return tuple(np.concatenate(side) for side in zip(*found))


def stars(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place of each place's component."""
    least = np.arange(count)
    while True:
        low = np.minimum(least[a], least[b])
        before = least.copy()
        np.minimum.at(least, least[a], low)
        np.minimum.at(least, least[b], low)
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        least = least[least]
        if (least == before).all():
            return least


def _dealt(points: DataFrame, radius: int, shard_size: int, sample_size: int) -> tuple[DataFrame, DataFrame]:
    """(shard, point) of shards that fit in a task, and of dense ones that do not but cannot be parted."""
    spark = points.sparkSession
    open_ = points.select(F.lit(0).cast("long").alias("shard"), "point")
    done, dense = None, None
    while True:
        open_ = stored(open_, "open-shards")
        sizes = stored(open_.groupBy("shard").agg(F.count(F.lit(1)).alias("points")), "shard-sizes")
        small = open_.join(sizes.where(F.col("points") <= shard_size), "shard", "left_semi")
        done = small if done is None else done.unionByName(small)
        large = sizes.where(F.col("points") > shard_size)
        shards = large.count()
        if not shards:
            return done, dense if dense is not None else done.limit(0)
        # a sample of each large shard, evenly by a hash, of bounded size over all; what has no turn is split later
        shards = min(shards, max(1, sample_size // LEAST_SAMPLE))
        turn = large.orderBy("shard").limit(shards)
        most = F.least(F.lit(SAMPLED) * F.col("points"), F.lit(sample_size / shards))
        share = F.greatest(most, F.lit(float(LEAST_SAMPLE))) / F.col("points")
        unit = F.pmod(F.xxhash64("point", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = open_.join(turn, "shard").where(unit < share).select("shard", "points", "point").orderBy("point").toArrow()
        trees, numbers = {}, drawn["shard"].to_numpy()
        sampled, totals = drawn["point"].to_numpy().view(np.uint64), drawn["points"].to_numpy()
        for shard in np.unique(numbers):
            own = sampled[numbers == shard]
            total = int(totals[numbers == shard][0])
            # leaves are aimed at two thirds of what fits, so that most are not split again
            trees[int(shard)] = grow(np.random.default_rng(len(own)).permutation(own), radius, max(16, len(own) * shard_size / total / 1.5))
        held = spark.sparkContext.broadcast(trees)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            shard, point = batch["shard"].to_numpy(), batch["point"].to_numpy()
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
            for number in np.unique(shard):
                rows = np.flatnonzero(shard == number)
                if int(number) not in held.value:
                    out.append((rows, np.full(len(rows), number), np.zeros(len(rows), bool)))
                    continue
                leaves: list = []
                route(held.value[int(number)], point.view(np.uint64), rows, radius, leaves)
                for leaf, (own, close) in enumerate(leaves):
                    name = _shard_name(int(number), leaf)
                    out.append((own, np.full(len(own), name), np.full(len(own), close)))
            rows, names, close = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(point[rows]), pa.array(close)], ["shard", "point", "close"])

        rest = open_.join(large, "shard", "left_semi").select("shard", "point")
        routed = stored(over_batches(rest, run, "shard long, point long, close boolean"), "routed")
        close = routed.where("close").select("shard", "point")
        dense = close if dense is None else dense.unionByName(close)
        open_ = routed.where("NOT close").select("shard", "point")


def _shard_name(parent: int, leaf: int) -> int:
    """A number for a leaf of a shard's tree, by hash; shards that shared one would only be compared together."""
    return xxhash.xxh3_64_intdigest(f"{parent}/{leaf}".encode()) >> 1


def _links_of_shards(shards: DataFrame, radius: int) -> DataFrame:
    """(a, b) points: a star for each group of linked points of each shard."""

    def run(key, table):
        points = np.unique(table["point"].to_numpy().view(np.uint64))
        least = stars(len(points), *links_within(points, radius))
        tips = np.flatnonzero(least != np.arange(len(points)))
        signed = points.view(np.int64)
        return pa.table([pa.array(signed[tips]), pa.array(signed[least[tips]])], names=["a", "b"])

    return shards.groupBy("shard").applyInArrow(run, "a long, b long")


def _links_of_dense(dense: DataFrame) -> DataFrame:
    """(a, b) points at most two bits apart, in aggregates of any size: by the points within one bit of both."""
    masks = F.array(F.lit(0).cast("long"), *[F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("long") for k in range(64)])
    keyed = dense.select("point").distinct().withColumn("mask", F.explode(masks))
    keyed = keyed.select("point", F.col("point").bitwiseXOR(F.col("mask")).alias("key"))
    first = keyed.groupBy("key").agg(F.min("point").alias("b"), F.count(F.lit(1)).alias("times")).where("times > 1")
    return keyed.join(first, "key").where("point <> b").select(F.col("point").alias("a"), "b").distinct()


def linked_points(points: DataFrame, radius: int = RADIUS, shard_size: int | None = None, sample_size: int = SAMPLE) -> DataFrame:
    """Distinct ``point`` to stars (a, b): each point of a component but its least, with that least one."""
    count = points.count()
    if shard_size is None:
        shard_size = min(MOST_SHARD, max(LEAST_SHARD, count // SHARES))
    if radius != 2 and count > shard_size:
        raise ValueError("dense shards are linked at a radius of 2 only")
    shards, dense = _dealt(points, radius, shard_size, sample_size)
    links = stored(_links_of_shards(shards, radius).unionByName(_links_of_dense(dense)), "point-links")
    return components(links)


def near_copies(df: DataFrame, shard_size: int | None = None, sample_size: int = SAMPLE) -> DataFrame:
    """(doc_id, text) to doc_id, point (the fingerprint) and component_id, one row per row.

    ``component_id`` is the least doc_id that links lead to, the row's own included. Null, empty and wordless texts
    have the fingerprint zero and are linked like others; so are rows that repeat an id. Null ids take part
    in links but name no component, unless all ids of it are null. An empty table gives no rows; other columns
    are not read. Texts are read whole, of any length.
    """
    found = stored(fingerprints(df), "fingerprints")
    points = found.groupBy("point").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("times"))
    points = stored(points, "points")
    star = linked_points(points.select("point"), RADIUS, shard_size, sample_size)
    member = points.join(star.select(F.col("a").alias("point"), F.col("b").alias("star")), "point", "left")
    member = stored(member.withColumn("star", F.coalesce("star", "point")), "members")
    least = member.groupBy("star").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("times"))
    named = attach_rows(member.select("point", "star"), least.drop("times"), ["star"], least.select("star", "times"))
    return attach_rows(found, stored(named.drop("star"), "named"), ["point"], points.select("point", "times"))


def op12_simhash(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id")
