"""Collocations: phrases whose words occur together more often than their parts would, by best-first growth.

Counts are of one language each; ``n`` is the number of its words and ``f`` counts contiguous occurrences.
A phrase scores 1000 f(phrase) n / (f(first part) f(rest)) at its weakest cut. A phrase that starts with w
scores 1000 n / f(w) at most, as its rest is at least as frequent as the phrase itself: the count of a prefix
bounds all that grows from it.

1. The words are counted. Words with ``least`` occurrences are the roots, those of low counts the best.
2. Each round expands, of every open language, the roots up to a higher count: pairs, triples, and longer
   phrases of frequent parts are counted, a scan each. Scans skip what cannot be frequent by bit tables
   of fixed size; false hits cost rows, no results.
3. Parts and longer phrases that start with a word not yet expanded, and that the scores or the dropping of the
   candidates need, are counted in one more scan.
4. A language is settled when its last rank scores more than any word not yet expanded allows, ties included,
   or when all its words are expanded.

Words stand for 64-bit hashes in the scans; if two words share one, another seed is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.batches import bound_batches, mixed, over_batches
from meterline.llm.chunks import tiles
from meterline.sources.scratch import stored

LEAST = 100
LONGEST = 5
KEPT = 2000
ABSORBED_PERCENT = 100
NO_LANGUAGE = "und"
#: the first round expands words of up to so many times the least count, each further one so many times more
FIRST, STEP = 4, 64
#: bits of a table that scans look phrases up in
TABLE_BITS = 24
#: bytes of text that a task counts together
TOGETHER = 8 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
WORDS = ["w1", "w2", "w3", "w4", "w5"]

#: upper case to lower, separators of pieces to a line end, and the other white space that parts words to a space
_TRANSLATED = bytes(
    10 if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


# --- words of texts ---------------------------------------------------------------------------------


class Words:
    """The words of some texts of one language: codes into ``distinct``, their hashes, and whether the next
    word follows in the same piece."""

    def __init__(self, language: str, texts: Sequence[bytes], seed: int):
        data = np.frombuffer(b"\n".join(texts).translate(_TRANSLATED), np.uint8)
        ends_piece = data == 10
        apart = ends_piece | (data == 32)
        edges = np.flatnonzero(np.diff(np.concatenate(([True], apart, [True])).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        letters = data[~apart].tobytes()
        lengths = ends - starts
        coded = tiles(letters, np.cumsum(lengths) - lengths).dictionary_encode()
        self.language = language
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.distinct = coded.dictionary
        begin = xxhash.xxh3_64(language.encode() + b"\x00", seed)
        hashes = np.zeros(len(self.distinct), np.uint64)
        for n, word in enumerate(self.distinct.to_pylist()):
            one = begin.copy()
            one.update(word)
            hashes[n] = one.intdigest()
        self.hashes = hashes
        lines = np.cumsum(ends_piece, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
        self.piece = lines

    def runs(self, length: int) -> np.ndarray:
        """Where ``length`` words in a row are of one piece."""
        last = len(self.codes) - length + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[length - 1 :])


def _texts_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language at a time, ``TOGETHER`` bytes in all or one text."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for language, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            if not text:
                continue
            for part in _parts(text.encode()):
                if size + len(part) > TOGETHER:
                    yield from held.items()
                    held, size = {}, 0
                held.setdefault(language, []).append(part)
                size += len(part)
    yield from held.items()


def _parts(text: bytes) -> Iterator[bytes]:
    """A very long text cut behind ends of pieces, which no phrase spans."""
    while len(text) > TOGETHER:
        at = max(text.rfind(mark, 0, TOGETHER) for mark in (b".", b",", b";", b":", b"!", b"?", b"\n", b"\r", b"\v", b"\f"))
        if at < 0:
            break
        yield text[: at + 1]
        text = text[at + 1 :]
    yield text


def _scan(docs: DataFrame, seed: int, count: Callable[[Words], dict[str, pa.Array]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, texts in _texts_by_language(batches):
            columns = count(Words(language, texts, seed))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, schema)


# --- bit tables -------------------------------------------------------------------------------------


def slots(columns: Sequence[np.ndarray]) -> np.ndarray:
    """The place of phrases in a bit table, from the hashes of their words."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    with np.errstate(over="ignore"):
        for column in columns:
            out = out * BASE + column
        return (mixed(out) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def bit_table(phrases: DataFrame | None, length: int) -> np.ndarray:
    """Bits of the phrases (w1, w2, ...) of so many words. Of a fixed size, whatever their number."""
    bits = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    if phrases is not None:

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = slots([batch[name].to_numpy().view(np.uint64) for name in WORDS[:length]])
            return pa.RecordBatch.from_arrays([pa.array(found)], ["slot"])

        found = over_batches(phrases.select(*WORDS[:length]), run, "slot long")
        one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
        table = found.groupBy(F.expr("slot >> 6").alias("part")).agg(F.bit_or(one).alias("bits")).toArrow()
        bits[table["part"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return bits


def is_in(bits: np.ndarray, columns: Sequence[np.ndarray]) -> np.ndarray:
    slot = slots(columns)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


# --- scans ------------------------------------------------------------------------------------------


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """lang, word, w1 (its hash) and f."""

    def count(words: Words) -> dict[str, pa.Array]:
        return {
            "lang": pa.array([words.language] * len(words.distinct)),
            "word": words.distinct.cast(pa.string()),
            "w1": pa.array(words.hashes.view(np.int64)),
            "f": pa.array(np.bincount(words.codes, minlength=len(words.distinct))),
        }

    found = _scan(docs, seed, count, "lang string, word string, w1 long, f long")
    return found.groupBy("lang", "word").agg(F.any_value("w1").alias("w1"), F.sum("f").alias("f"))


def _counted(words: Words, at: np.ndarray, length: int, most: int) -> dict[str, pa.Array]:
    """The distinct phrases of ``length`` words that start at ``at``, with how often they do.

    They are numbered word by word: the number so far and the next word's code make the next number.
    """
    numbers, size = words.codes[at], len(words.distinct)
    for k in range(1, length):
        _, numbers = np.unique(numbers * size + words.codes[at + k], return_inverse=True)
    distinct, first, times = np.unique(numbers, return_index=True, return_counts=True)
    columns = {}
    for k, name in enumerate(WORDS[:most]):
        if k < length:
            columns[name] = pa.array(words.hashes[words.codes[at[first] + k]].view(np.int64))
        else:
            columns[name] = pa.nulls(len(distinct), pa.int64())
    return columns | {"f": pa.array(times)}


def count_phrases(docs: DataFrame, seed: int, lengths: Sequence[int], keep: Callable[[Words, np.ndarray, int], np.ndarray], least: int) -> DataFrame:
    """Phrases of the given numbers of words that occur ``least`` times or more.

    ``keep`` chooses among the places where they start; it must decide by the words of the phrase alone.
    """
    most = max(lengths)

    def count(words: Words) -> dict[str, pa.Array]:
        found = []
        for length in lengths:
            at = words.runs(length)
            found.append(_counted(words, at[keep(words, at, length)], length, most))
        return {name: pa.concat_arrays([columns[name] for columns in found]) for name in found[0]}

    names = WORDS[:most]
    schema = ", ".join(f"{name} long" for name in [*names, "f"])
    counted = _scan(docs, seed, count, schema).groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return counted.select(*names, *[F.lit(None).cast("long").alias(name) for name in WORDS[most:]], "f")


def _hashes_at(words: Words, at: np.ndarray, first: int, last: int) -> list[np.ndarray]:
    """Hashes of the words from number ``first`` to before ``last`` of phrases that start at ``at``."""
    return [words.hashes[words.codes[at + k]] for k in range(first, last)]


def _of_length(phrases: DataFrame, length: int) -> DataFrame:
    out = phrases.where(F.col(WORDS[length - 1]).isNotNull())
    return out if length == LONGEST else out.where(F.col(WORDS[length]).isNull())


def _expanded(docs: DataFrame, seed: int, least: int, longest: int, frequent, band, later, known) -> DataFrame:
    """All frequent phrases of two words or more that start with a word of ``band``.

    ``frequent``, ``band`` and ``later`` are bit tables of words: all frequent ones, those expanded now, and those not
    expanded yet. ``known`` are the frequent phrases of earlier rounds.
    """
    context = docs.sparkSession.sparkContext
    word_bits = context.broadcast((frequent, band, later))

    def pairs(words: Words, at: np.ndarray, length: int) -> np.ndarray:
        frequent, band, _ = word_bits.value
        often, root = is_in(frequent, [words.hashes]), is_in(band, [words.hashes])
        return (often & root)[words.codes[at]] & often[words.codes[at + 1]]

    found = [stored(count_phrases(docs, seed, [2], pairs, least), "pairs")]
    for base, lengths in ((2, [3]), (3, [4, 5])):  # phrases of ``base`` words are known
        lengths = [length for length in lengths if length <= longest]
        if not lengths:
            break
        here = context.broadcast(bit_table(_of_length(reduce(DataFrame.unionByName, found), base), base))
        ever = context.broadcast(bit_table(_of_length(reduce(DataFrame.unionByName, [known, *found]), base), base))

        def longer(words: Words, at: np.ndarray, length: int) -> np.ndarray:
            frequent, band, later = word_bits.value
            often, root = is_in(frequent, [words.hashes]), is_in(band, [words.hashes])
            open_ = is_in(later, [words.hashes])
            keep = (often & root)[words.codes[at]]
            for k in range(1, length):
                keep &= often[words.codes[at + k]]
            left = np.flatnonzero(keep)
            left = left[is_in(here.value, _hashes_at(words, at[left], 0, base))] if len(left) else left
            for first in range(1, length - base + 1):
                inside = is_in(ever.value, _hashes_at(words, at[left], first, first + base))
                left = left[inside | open_[words.codes[at[left] + first]]]
            out = np.zeros(len(at), bool)
            out[left] = True
            return out

        found.append(stored(count_phrases(docs, seed, lengths, longer, least), "phrases"))
    return reduce(DataFrame.unionByName, found)


def _missing(docs: DataFrame, seed: int, least: int, longest: int, candidates: DataFrame, later: np.ndarray) -> DataFrame:
    """Frequent phrases that start with a word not yet expanded and are the rest of a candidate behind a cut, or
    a word before a candidate."""
    context = docs.sparkSession.sparkContext
    rests, wholes = {}, {}
    for length in range(2, longest):
        tails = [
            candidates.where(F.col(WORDS[first + length - 1]).isNotNull() & (F.lit(True) if first + length == LONGEST else F.col(WORDS[first + length]).isNull()))
            .select(*[F.col(WORDS[first + k]).alias(WORDS[k]) for k in range(length)])
            for first in range(1, longest - length + 1)
        ]
        rests[length] = bit_table(reduce(DataFrame.unionByName, tails), length) if tails else bit_table(None, length)
        wholes[length] = bit_table(_of_length(candidates, length), length)
    held = context.broadcast((later, rests, wholes))

    def keep(words: Words, at: np.ndarray, length: int) -> np.ndarray:
        later, rests, wholes = held.value
        open_ = is_in(later, [words.hashes])
        left = np.flatnonzero(open_[words.codes[at]])
        wanted = np.zeros(len(left), bool)
        if length in rests:
            wanted |= is_in(rests[length], _hashes_at(words, at[left], 0, length))
        if length - 1 in wholes:
            wanted |= is_in(wholes[length - 1], _hashes_at(words, at[left], 1, length))
        out = np.zeros(len(at), bool)
        out[left[wanted]] = True
        return out

    return count_phrases(docs, seed, list(range(2, longest + 1)), keep, least)


# --- scores -----------------------------------------------------------------------------------------


def _listed() -> F.Column:
    """The words of a phrase as one key."""
    return F.array_compact(F.array(*WORDS))


def scored(candidates: DataFrame, counted: DataFrame, words: DataFrame, languages: DataFrame) -> DataFrame:
    """Candidates (ws, f) with lang, l, r, n, score at their weakest cut. ``counted`` has f of phrases, and of words.

    Products are decimals of up to 38 digits, exact for counts of up to 10 ** 17.
    """
    exact = "decimal(38,0)"
    with_language = candidates.join(words.select(F.array("w1").alias("root"), "lang"), F.slice("ws", 1, 1) == F.col("root")).drop("root")
    cuts = with_language.join(languages.select("lang", "n"), "lang").withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)))
    cuts = cuts.withColumns({"left": F.slice("ws", F.lit(1), F.col("k")), "right": F.slice("ws", F.col("k") + 1, F.size("ws") - F.col("k"))})
    met = cuts.join(counted.select(F.col("ws").alias("left"), F.col("f").alias("l")), "left")
    met = met.join(counted.select(F.col("ws").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr(f"cast(1000 * cast(f as {exact}) * cast(n as {exact}) as {exact}) div cast(cast(l as {exact}) * cast(r as {exact}) as {exact})")
    weakest = met.groupBy("ws", "lang").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.first("f").alias("f"), F.first("n").alias("n")
    )
    return weakest.select("lang", "ws", "f", "cut.l", "cut.r", "n", "cut.score")


def surviving(found: DataFrame, counted: DataFrame, absorbed_percent: int) -> DataFrame:
    """Those that no longer phrase takes the place of.

    If any longer phrase has enough of a phrase's occurrences, so has one that is longer by one word.
    """
    size = F.size("ws")
    longer = counted.where(size > 2)
    ends = [longer.select(F.slice("ws", F.lit(first), size - 1).alias("ws"), F.col("f").alias("longer")) for first in (1, 2)]
    most = ends[0].unionByName(ends[1]).groupBy("ws").agg(F.max("longer").alias("longer"))
    kept = F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(absorbed_percent) * F.col("f"))
    return found.join(most, "ws", "left").where(kept).drop("longer")


def _words_of(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """Frequent words, all languages with n, and the seed under which no two words share a hash."""
    for seed in range(8):
        counted = stored(count_words(docs, seed), "words")
        if counted.groupBy("w1").agg(F.count(F.lit(1)).alias("words")).where("words > 1").isEmpty():
            languages = counted.groupBy("lang").agg(F.sum("f").alias("n"), F.max("f").alias("highest"))
            return stored(counted.where(F.col("f") >= least), "frequent-words"), stored(languages, "languages"), seed
    raise RuntimeError("words share hashes under eight seeds")


def collocations(
    df: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    kept: int = KEPT,
    absorbed_percent: int = ABSORBED_PERCENT,
    first: int = FIRST,
    step: int = STEP,
) -> DataFrame:
    """(text, lang) to the ``kept`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null language is ``und``. Null, empty and wordless texts have no phrases; repeated rows count as often as they
    occur. Ties go by a, then by the phrase's bytes. A language without phrases, and an empty table, gives no rows;
    other columns are not read. Whole texts are read; very long ones in parts that end with a piece.
    """
    docs = df.select("text", F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"))
    words, languages, seed = _words_of(docs, least)
    frequent = bit_table(words, 1)
    # below: the highest count that is not expanded yet; words up to ``upto`` are expanded this round
    state = languages.withColumns({"below": F.lit(0).cast("long"), "upto": F.lit(least * first).cast("long")})
    state = stored(state, "state")
    known = stored(words.limit(0).select(*[F.lit(None).cast("long").alias(name) for name in WORDS], "f"), "phrases")
    while True:
        placed = words.join(state.select("lang", "below", "upto"), "lang")
        band = placed.where("f > below AND f <= upto")
        later = bit_table(placed.where("f > upto"), 1)
        grown = _expanded(docs, seed, least, longest, frequent, bit_table(band, 1), later, known)
        # bit tables may also have let other words through as roots
        known = stored(known.unionByName(grown.join(band.select("w1"), "w1", "left_semi").select(known.columns)), "phrases")
        counted = known
        if later.any():
            missing = _missing(docs, seed, least, longest, known, later)
            roots = placed.where("f > upto").select("w1")
            counted = known.unionByName(missing.join(roots, "w1", "left_semi").select(known.columns))
        counted = stored(counted.select(_listed().alias("ws"), "f"), "counted")
        everything = counted.unionByName(words.select(F.array("w1").alias("ws"), "f"))
        candidates = known.select(_listed().alias("ws"), "f")
        found = surviving(scored(candidates, everything, words, languages), counted, absorbed_percent)
        best = stored(_best(found, words, kept), "best")
        last = best.where(F.col("rank") == kept).select("lang", F.col("score").alias("last"))
        # a word that is not expanded allows floor(1000 n / f); what may reach the last rank must be expanded
        exact = "decimal(38,0)"
        needed = F.expr(f"cast(1000 * cast(n as {exact}) as {exact}) div cast(last as {exact})")
        after = state.join(last, "lang", "left").withColumn("needed", needed)
        settled = (F.col("upto") >= F.col("highest")) | (F.col("needed").isNotNull() & (F.col("upto") >= F.col("needed")))
        following = F.when(settled, F.col("upto")).when(F.col("needed").isNotNull(), F.col("needed")).otherwise(F.col("upto") * step)
        after = after.select("lang", "n", "highest", F.col("upto").alias("below"), following.alias("upto"))
        state = stored(after, "state")
        if state.where("upto > below").isEmpty():
            return best


def _best(found: DataFrame, words: DataFrame, kept: int) -> DataFrame:
    """The first ``kept`` of each language in full order, with their text.

    Texts decide among equals only, so they are looked up for what is not below the last place's score and count.
    """
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"))
    top = found.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= kept)
    spelled = top.select("*", F.posexplode("ws").alias("at", "w1")).join(words.select("w1", "word"), "w1")
    texts = spelled.groupBy("ws").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    named = top.join(texts.select("ws", F.array_join("spelled.word", " ").alias("phrase")), "ws")
    full = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(full).cast("long")).where(F.col("rank") <= kept)
    return ranked.select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), listed AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), starts AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS place FROM listed
), counts AS MATERIALIZED (
    SELECT lang, array_to_string(ws[place:place + m - 1], ' ') AS phrase, m, count(*) AS f
    FROM starts, range(1, 6) AS lengths(m) WHERE place + m - 1 <= len(ws) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM counts WHERE m = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT lang, phrase, m, f, string_split(phrase, ' ') AS ws FROM counts WHERE m >= 2 AND f >= 100
), halves AS MATERIALIZED (
    SELECT *, array_to_string(ws[1:k], ' ') AS left_part, array_to_string(ws[k + 1:m], ' ') AS right_part
    FROM candidates, range(1, 5) AS places(k) WHERE k < m
), parts AS (
    SELECT lang, phrase, f, k, unnest([left_part, right_part]) AS part, unnest(['l', 'r']) AS side FROM halves
), met AS MATERIALIZED (
    SELECT p.lang, p.phrase, p.f, p.k, max(c.f) FILTER (side = 'l') AS l, max(c.f) FILTER (side = 'r') AS r
    FROM parts p JOIN counts c ON c.lang = p.lang AND c.phrase = p.part
    GROUP BY p.lang, p.phrase, p.f, p.k
), cuts AS (
    SELECT met.*, n, (1000::HUGEINT * f * n) // (l::HUGEINT * r) AS score FROM met JOIN totals USING (lang)
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, array_to_string(ws[place:place + size - 1], ' ') AS phrase, max(f) AS longer
    FROM candidates, range(1, 5) AS places(place), range(2, 5) AS sizes(size)
    WHERE size < m AND place + size - 1 <= m
    GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank,
       phrase, f AS a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM weakest LEFT JOIN inside USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 100 * f
QUALIFY rank <= 2000
"""
