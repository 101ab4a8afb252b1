"""Near duplicates: five-word shingles, a Jaccard similarity of 0.8 or more, DartMinHash banding.

1. Texts with the same words in the same order are one *node*, so copies are compared once.
2. A node's shingles are a set in which all weigh the same, as in the comparison, so that the similarity
   that draws candidates is the one that is checked. DartMinHash takes ``COORDINATES`` coordinates of it
   in time linear in the text.
3. ``BANDS`` bands of ``BAND_ROWS`` coordinates put nodes into buckets: two texts of similarity 0.8 miss
   each other in all of them once in 150,000 times, more similar ones hardly ever.
4. Inside buckets candidates are compared exactly, by their sets of shingles. A bucket of up to
   ``SMALL`` nodes compares all of them. In a larger one every node is compared with leaders: one that all
   its buckets share and, where that does not take it in, ``LEADERS - 1`` random members of the leading
   class and the first of those left. Nodes known to be of one class are not compared again.
   Leaders only save work. What larger buckets still hold of several classes is joined exactly: two sets
   of similarity ``SIMILAR`` share one of their rarest shingles (prefix filter), are of like size,
   have enough shingles left behind the first they share, and differ in few shingles. Of the last a
   parity sketch tells: each of its bits says whether an even or odd number of the set's shingles fall there, so two
   sketches differ in no more bits than the sets do in shingles. All pairs that this does not rule out are
   compared. Shingles that many nodes have among their rarest are dealt out to several tasks.
5. Links are joined to classes by alternating stars.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from meterline.llm.batches import bound_batches, over_batches
from meterline.llm.darts import signatures
from meterline.llm.graph import components
from meterline.llm.shingles import grams, hashed, words
from meterline.sources.scratch import stored

SHINGLE = 5
SIMILAR = 0.8
BAND_ROWS = 5
BANDS = 30
COORDINATES = BAND_ROWS * BANDS
SMALL = 8
LEADERS = 4
#: nodes of one shingle that a task pairs with the others
SPLIT = 500
#: shingles are counted by their first bits; counts only order them, so those that share a slot do no harm
SLOT_BITS = 20
#: bits of a set's parity sketch, in words of 64
PARITY_WORDS = 16
ROUNDING = 1e-6


def _word_digest(listed: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(listed))


def weighted_shingles(texts: list[list[str]], n: int = SHINGLE):
    """Distinct shingles of each text (hash, weight, text number), ordered by text and hash.

    A shingle weighs 1 however often it recurs: two texts have one similarity, that of their sets.
    """
    flat, offsets = hashed(texts)
    value, text, _ = grams(flat, offsets, n)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return value[first], np.ones(len(first)), text[first]


def sketch(df: DataFrame) -> DataFrame:
    """(doc_id, text_key, text) to the first two, digest of the words, and 16 bits of each coordinate."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [words(text) for text in batch["text"].to_pylist()]
        drawn = signatures(*weighted_shingles(texts), len(texts), COORDINATES).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["text_key"],
                pa.array([_word_digest(ws) for ws in texts], pa.binary()),
                pa.array([row.tobytes() for row in drawn], pa.binary()),
            ],
            ["doc_id", "text_key", "digest", "sketch"],
        )

    return over_batches(df, run, "doc_id long, text_key long, digest binary, sketch binary")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, text) to node and the sorted set of shingles, 32 bits each."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        listed = [words(text) for text in batch["text"].to_pylist()]
        value, _, text = weighted_shingles(listed)
        short = (value >> np.uint64(32)).astype("<u4")
        ends = np.searchsorted(text, np.arange(len(listed) + 1))
        sets = [short[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        return pa.RecordBatch.from_arrays([batch["node"], pa.array(sets, pa.binary())], ["node", "shingles"])

    return over_batches(texts.select("node", "text"), run, "node long, shingles binary")


@F.pandas_udf(DoubleType())
def jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
    """Similarity of two sorted sets of shingles; two empty ones are not alike, as they share nothing."""
    out = []
    for a, b in zip(left, right):
        x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
        common = len(np.intersect1d(x, y, assume_unique=True))
        out.append(common / max(1, len(x) + len(y) - common))
    return pd.Series(out, dtype=float)


def make_nodes(sketches: DataFrame) -> DataFrame:
    """One row per word sequence: node, digest, sketch, least id and number of rows."""
    grouped = sketches.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"),
        F.min_by("text_key", F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("text_key"),
        F.count(F.lit(1)).alias("copies"),
        F.any_value("sketch").alias("sketch"),
    )
    return stored(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node): a bucket is the hash of a band's number and coordinates."""
    bands = [
        F.xxhash64(F.lit(i), F.substring("sketch", 2 * BAND_ROWS * i + 1, 2 * BAND_ROWS)) for i in range(BANDS)
    ]
    filled = nodes.where(F.col("sketch") != F.lit(bytes(2 * COORDINATES)))
    return filled.select(F.explode(F.array(*bands)).alias("bucket"), "node")


def _shared(members: DataFrame) -> DataFrame:
    """Members (bucket, node) of buckets with several, with the number of these."""
    counts = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(counts, "bucket")


def _all_pairs(members: DataFrame) -> DataFrame:
    """Pairs of nodes of different classes in buckets whose size the caller has bounded."""
    other = members.select("bucket", F.col("node").alias("b"), F.col("label").alias("other_label"))
    met = members.join(other, "bucket").where("node < b AND label <> other_label")
    return met.select(F.col("node").alias("a"), "b")


def _leader_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Each member outside the leading class of its bucket with a leader of that class: the least
    node at first, one drawn for the bucket in later turns. A node whose buckets have the same leading
    class is compared once a turn."""
    order = F.col("node") if turn == 0 else F.xxhash64("bucket", "node", F.lit(turn))
    leaders = members.groupBy("bucket").agg(
        F.min(F.struct(F.col("label"), order.alias("order"), F.col("node"))).alias("lead"), F.max("label").alias("top")
    )
    leaders = leaders.where("top > lead.label").select(
        "bucket", F.col("lead.label").alias("lead_label"), F.col("lead.node").alias("leader")
    )
    met = members.join(leaders, "bucket").where("label <> lead_label")
    met = met.groupBy("node", "lead_label").agg(F.min("leader").alias("leader"))
    return met.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))


def _labelled(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Members with the class each is of so far."""
    joined = members.join(stars.select(F.col("a").alias("node"), F.col("b").alias("least")), "node", "left")
    return joined.withColumn("label", F.coalesce("least", "node")).drop("least")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs whose sets of shingles are alike."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    compared = pairs.distinct().join(left, "a").join(right, "b")
    return stored(compared.where(jaccard("left", "right") >= SIMILAR).select("a", "b"), "links")


def _sets_of(members: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Shingle sets of the nodes in shared buckets; a node's rows have equal sets, any of them will do."""
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("doc_id").alias("node_id"), F.col("text_key").alias("node_key")
    )
    same = docs["doc_id"].eqNullSafe(wanted["node_id"]) & (docs["text_key"] == wanted["node_key"])
    # the same join at every size: what is wanted grows with the corpus
    sets = stored(shingle_sets(docs.join(wanted.hint("merge"), same)), "shingle-sets")
    # one set for each node, also where its row is there several times
    return stored(sets.dropDuplicates(["node"]), "shingle-sets") if sets.count() > wanted.count() else sets


def _slot(shingles: np.ndarray) -> np.ndarray:
    return shingles >> np.uint32(32 - SLOT_BITS)


def _slot_counts(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each slot occur in ``sets``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = np.frombuffer(b"".join(batch["shingles"].to_pylist()), "<u4")
        slot, times = np.unique(_slot(flat), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(times)], ["slot", "times"])

    counted = over_batches(sets.select("shingles"), run, "slot int, times long").groupBy("slot").agg(F.sum("times").alias("times"))
    table, out = counted.toArrow(), np.zeros(1 << SLOT_BITS, dtype=np.int64)
    out[table["slot"].to_numpy()] = table["times"].to_numpy()
    return out


def parity(shingles: np.ndarray) -> np.ndarray:
    """Sketch of a set: for each of its bits, whether an odd number of shingles fall there."""
    odd = np.bincount(shingles % np.uint32(64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(bool)).view("<u8")


def _prefixes(sets: DataFrame, often: np.ndarray) -> DataFrame:
    """(node, label, shingles) to node, label, size and parity sketch of the set, and each of its rarest shingles
    with its place from the rarest on: so many that a set of similarity ``SIMILAR`` shares one of them."""
    held = sets.sparkSession.sparkContext.broadcast(often)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, rarest, sketches = [], [], []
        for packed in batch["shingles"].to_pylist():
            shingles = np.frombuffer(packed, "<u4")
            order = np.lexsort((shingles, held.value[_slot(shingles)]))
            sizes.append(len(shingles))
            sketches.append(parity(shingles).view("<i8"))
            rarest.append(shingles[order[: int(len(shingles) * (1 - SIMILAR) + ROUNDING) + 1]].view("<i4"))
        listed, odd = pa.array(rarest, pa.list_(pa.int32())), pa.array(sketches, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [batch["node"], batch["label"], pa.array(sizes, pa.int32()), odd, listed], ["node", "label", "size", "odd", "rarest"]
        )

    schema = "node long, label long, size int, odd array<long>, rarest array<int>"
    found = over_batches(sets.select("node", "label", "shingles"), run, schema)
    return found.select("node", "label", "size", "odd", F.posexplode("rarest").alias("place", "shingle"))


def _filtered_pairs(labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of nodes (node, label) of different classes that may be alike; none that is alike is missing.

    Alike sets of sizes m and n have at least SIMILAR / (1 + SIMILAR) * (m + n) shingles in common, none of
    which stands before the first they share, and (1 - SIMILAR) / (1 + SIMILAR) * (m + n) at most that only one has.
    """
    open_sets = sets.join(labelled, "node")
    prefixes = stored(_prefixes(open_sets, _slot_counts(open_sets)), "prefixes")
    shared = prefixes.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("times"), F.min("label").alias("first"), F.max("label").alias("last")
    )
    shared = shared.where("first < last").select("shingle", F.ceil(F.col("times") / SPLIT).alias("parts"))
    met = prefixes.join(shared, "shingle")
    one = met.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).drop("parts")
    left = F.col("size") - F.col("place")
    # the smaller of two sets has one of fewer shingles in common with the other
    other = met.where(left * (1 + SIMILAR) + ROUNDING >= 2 * SIMILAR * F.col("size")).select(
        "shingle",
        F.col("node").alias("b"),
        F.col("label").alias("other_label"),
        F.col("size").alias("other_size"),
        F.col("odd").alias("other_odd"),
        left.alias("other_left"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
    )
    pairs = one.withColumn("left", left).join(other, ["shingle", "part"])
    smaller = (F.col("other_size") < F.col("size")) | (F.col("other_size") == F.col("size")) & (F.col("b") < F.col("node"))
    enough = F.least("left", "other_left") * (1 + SIMILAR) + ROUNDING >= SIMILAR * (F.col("size") + F.col("other_size"))
    like = F.col("other_size") + ROUNDING >= SIMILAR * F.col("size")
    differ = sum(F.bit_count(F.col("odd")[k].bitwiseXOR(F.col("other_odd")[k])) for k in range(PARITY_WORDS))
    few = differ * (1 + SIMILAR) <= (1 - SIMILAR) * (F.col("size") + F.col("other_size")) + ROUNDING
    pairs = pairs.where((F.col("label") != F.col("other_label")) & smaller & like & enough & few)
    return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))


def link_buckets(nodes: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Stars (a, b) of the classes of several nodes; None where no bucket has two."""
    buckets = _buckets(nodes)
    members = stored(_shared(buckets), "members")
    if members.isEmpty():
        return None
    sets = _sets_of(members, nodes, docs)
    alone = members.withColumn("label", F.col("node"))
    large = alone.where(F.col("size") > SMALL)
    pairs = _all_pairs(alone.where(F.col("size") <= SMALL)).unionByName(_leader_pairs(large, 0))
    stars = components(_verified(pairs, sets))
    # those that the leading class of a larger bucket has not taken in get a second round
    large = stored(_labelled(large.select("bucket", "node"), stars), "members")
    leading = large.groupBy("bucket").agg(F.min("label").alias("first"), F.max("label").alias("last"))
    leading = leading.where("last > first")
    if leading.isEmpty():
        return stars
    apart = large.join(leading, "bucket").where("label > first").select("bucket", "node", "label")
    rest = stored(_shared(apart), "members-apart")
    pairs = _all_pairs(rest.where(F.col("size") <= SMALL)).unionByName(_leader_pairs(rest, 0))
    for turn in range(1, LEADERS):
        pairs = pairs.unionByName(_leader_pairs(large, turn))
    links = _verified(pairs, sets)
    if not links.isEmpty():
        stars = components(links.unionByName(stars))
    # and all that larger buckets still hold of several classes is compared, unless it cannot be alike
    large = _labelled(large.select("bucket", "node"), stars)
    several = large.groupBy("bucket").agg(F.min("label").alias("first"), F.max("label").alias("last")).where("last > first")
    apart = stored(large.join(several, "bucket").select("node", "label").distinct(), "nodes-apart")
    if apart.isEmpty():
        return stars
    links = _verified(_filtered_pairs(apart, sets), sets)
    return stars if links.isEmpty() else components(links.unionByName(stars))


def near_duplicates(df: DataFrame) -> DataFrame:
    """(doc_id, text) to doc_id, text_key (a hash of the text), class_id, class_size, kept: one row per row.

    ``class_id`` is the least id of the class and its row is the one kept. Texts with the same words in the
    same order are of one class, so null, empty and wordless texts are one. A text of fewer than five
    words is a single shingle. A null id gets a negative number made from the words, for its class only;
    rows that repeat id and text of the one kept are all marked. An empty table gives no rows; other
    columns are not read.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    sketches = stored(sketch(docs), "sketches")
    nodes = make_nodes(sketches)
    made_up = -(F.pmod(F.xxhash64("digest"), F.lit(2**61)) + 1)
    named = nodes.select("node", "digest", "copies", "text_key", F.coalesce("doc_id", made_up).alias("least_id"))
    stars = link_buckets(nodes, docs)
    if stars is not None:
        named = named.join(stars.select(F.col("a").alias("node"), F.col("b").alias("star")), "node", "left")
        named = named.withColumn("class", F.coalesce("star", "node"))
    else:
        named = named.withColumn("class", F.col("node"))
    classes = named.groupBy("class").agg(
        F.min(F.struct("least_id", "text_key")).alias("first"), F.sum("copies").alias("class_size")
    )
    of_digest = named.select("digest", "class").join(classes, "class")
    is_first = F.coalesce("doc_id", made_up) == F.col("first.least_id")
    return sketches.drop("sketch").join(of_digest, "digest").select(
        "doc_id",
        "text_key",
        F.col("first.least_id").alias("class_id"),
        "class_size",
        (is_first & (F.col("text_key") == F.col("first.text_key"))).alias("kept"),
    )


def without_near_duplicates(df: DataFrame) -> DataFrame:
    """One row of ``df`` for each class, columns unchanged."""
    kept = near_duplicates(df).where("kept").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("times"))
    kept = stored(kept.withColumnsRenamed({"doc_id": "kept_id", "text_key": "kept_key"}), "kept")
    rows = df.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    repeated = kept.where("times > 1")
    if repeated.isEmpty():
        return rows.join(kept, same, "left_semi").select("row.*")
    single = rows.join(kept.where("times = 1"), same, "left_semi")
    first = rows.join(repeated, same, "left_semi").dropDuplicates(["id", "key"])
    return single.unionByName(first).select("row.*")


def op3_near_duplicates(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")
