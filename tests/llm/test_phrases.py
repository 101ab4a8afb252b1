import random
import re
from collections import Counter, defaultdict

import pytest

from meterline.llm import phrases
from tests.comparing import differences, duck

UPPER = {n: n + 32 for n in range(65, 91)}


def by_force(rows, least, longest=5, kept=2000, percent=100):
    """All counts of all phrases, every cut, every longer phrase."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[k : k + m]) for k in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {
            g[k : k + m] for g, a in candidates.items() for m in range(2, len(g)) for k in range(len(g) - m + 1)
            if 100 * a >= percent * f[g[k : k + m]]
        }
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:kept], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(df, **options):
    return sorted(map(tuple, phrases.collocations(df, **options).collect()))


def test_query_equals_sql(spark):
    connection = duck("/root/testdata/sf0.01")
    assert differences(phrases.op13_collocations(spark, "/root/testdata/sf0.01"), phrases.OP13_SQL, connection) == []


def texts(seed, count):
    """Words of all frequencies, planted phrases that always or mostly stand together, and repeated pieces."""
    draw = random.Random(seed)
    planted = [" ".join(f"{draw.choice('pqrs')}{draw.randrange(30)}" for _ in range(draw.randint(2, 7))) for _ in range(40)]
    rows = []
    for _ in range(count):
        words = []
        for _ in range(draw.randrange(2, 50)):
            words.append(draw.choice(planted) if draw.random() < 0.2 else f"W{int(draw.paretovariate(0.7)) % 300}")
            words.append(draw.choice([" ", " ", " ", "\t ", ", ", "\n", ". "]))
        rows.append(("".join(words), draw.choice(["en", "fr", None, "en"])))
    return rows


@pytest.mark.parametrize(
    "options",
    [
        {"least": 4, "kept": 25, "first": 1, "step": 2},
        {"least": 3, "kept": 60, "first": 2, "step": 3, "longest": 4},
        {"least": 5, "kept": 2000},
        {"least": 4, "kept": 30, "first": 1, "step": 4, "absorbed_percent": 60},
        {"least": 6, "kept": 10, "first": 1, "step": 2, "longest": 2},
        {"least": 4, "kept": 1, "longest": 3},
    ],
)
def test_rounds_give_what_all_counts_give(spark, options):
    rows = texts(len(options), 500)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    plain = {name: options[name] for name in ("least", "longest", "kept") if name in options}
    assert found(df, **options) == by_force(rows, percent=options.get("absorbed_percent", 100), **plain)


def test_expansion_stops_early(spark, monkeypatch):
    """Where rare words make the best phrases, frequent ones are never expanded."""
    rows = [(f"rare{n} pair{n}. " * 5 + "the of and in to the a " * 20, "en") for n in range(60)]
    rounds, expanded = [], phrases._expanded
    monkeypatch.setattr(phrases, "_expanded", lambda docs, seed, least, longest, frequent, band, *rest: rounds.append(band) or expanded(docs, seed, least, longest, frequent, band, *rest))
    df = spark.createDataFrame(rows, "text string, lang string")
    assert found(df, least=4, kept=40, first=2, step=2) == by_force(rows, 4, kept=40)
    assert len(rounds) == 1


def test_products_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "x", 1, 10**13), ("en", "y", 2, 10**13)], "lang string, word string, w1 long, f long")
    counted = spark.createDataFrame([([1], 10**13), ([2], 10**13), ([1, 2], 9 * 10**12 + 7)], "ws array<long>, f long")
    languages = spark.createDataFrame([("en", 3 * 10**15)], "lang string, n long")
    row = phrases.scored(counted.where("size(ws) > 1"), counted, words, languages).first()
    assert row.score == 1000 * (9 * 10**12 + 7) * 3 * 10**15 // 10**26


def test_long_texts_in_parts(spark, monkeypatch):
    rows = texts(11, 60)
    rows = [(". ".join(text for text, _ in rows), "en"), ("no end of piece " * 50, "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(phrases, "TOGETHER", 500)
    held = [part for _, parts in [("en", phrases._parts(rows[0][0].encode()))] for part in parts]
    assert len(held) > 10 and b"".join(held).decode() == rows[0][0]
    assert found(df, least=3) == by_force(rows, 3)


def test_odd_rows(odd_documents, no_documents):
    rows = [(row.text, row.lang) for row in odd_documents.collect()]
    assert found(odd_documents, least=3) == by_force(rows, 3) != []
    assert found(no_documents) == []
