"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score.

Base kinds are kept whatever their score: e-mail addresses, IPv4 addresses, card numbers that pass
Luhn, and international phone numbers. Further kinds need a score of ``ACCEPTED``: bank accounts
(IBAN, mod-97) and, on the strength of nearby words, social security numbers and local phone numbers.

Each pattern is matched from left to right without overlaps, in time linear in the text: no match can
start inside a run of its own characters that has already failed. Offsets count code points.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.batches import bound_batches, over_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")
ACCEPTED = 0.5
CONTEXT = 40

LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?=\x20?[A-Z0-9])")
# --- fixed values: lengths of account numbers by country, as registered under ISO 13616 -----------
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18,
    "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31,
    "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
# --- end of fixed values ----------------------------------------------------------------------------
IBAN_REST = {n: re.compile(rf"(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in sorted(set(IBAN_LENGTHS.values()))}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
NOT_DIGIT = re.compile(r"[^0-9]")

#: score before context, words that raise it and words that lower it
RULES = {
    "email": (0.8, r"e-?mail|mail|contact|write|address", r"example|noreply|test"),
    "ip": (0.6, r"ip|host|server|address|login", r"version|release|section|chapter"),
    "card": (0.8, r"card|visa|mastercard|amex|credit|debit|payment", r"order|invoice|serial|isbn|tracking"),
    "phone": (0.7, r"phone|call|tel|mobile|cell|fax|contact", r"order|invoice|serial|version"),
    "iban": (0.8, r"iban|bank|account|transfer|konto|cuenta|compte", r"serial|order|version"),
    "ssn": (0.3, r"ssn|social|security|taxpayer", r"serial|order|part|version"),
    "local_phone": (0.3, r"phone|call|tel|mobile|cell|fax", r"serial|order|part|version"),
}
CONTEXT_WORDS = {
    kind: (re.compile(rf"(?<!\w)(?:{more})(?!\w)", re.I), re.compile(rf"(?<!\w)(?:{less})(?!\w)", re.I))
    for kind, (_, more, less) in RULES.items()
}
RAISED, LOWERED = 0.3, 0.3


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str):
    """From each @ to both sides: characters before it back to the last match, and a domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL_PART))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Base spans by kind; what fails its check is dropped and not tried again in part."""
    out = [(a, b, "email") for a, b in emails(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(_byte(part) for part in m[0].split("."))]
    for m in CARD.finditer(text):
        if len(m[0]) >= 14 and 14 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def _byte(part: str) -> bool:
    """At most 255, whatever zeros lead."""
    return len(short := part.lstrip("0")) <= 3 and int(short or "0") <= 255


def accounts(text: str):
    """Account numbers of their country's length; what follows one, in capitals or not, is not part of it."""
    free = 0
    for start in IBAN_START.finditer(text):
        length = IBAN_LENGTHS.get(start[1])
        if length is None or start.start() < free:
            continue
        rest = IBAN_REST[length].match(text, start.start() + 4)
        if rest and mod97(text[start.start() : rest.end()].replace(" ", "")):
            yield start.start(), rest.end()
            free = rest.end()


def further_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(a, b, "iban") for a, b in accounts(text)]
    out += [(*m.span(), "ssn") for m in SSN.finditer(text)]
    return out + [(*m.span(), "local_phone") for m in LOCAL_PHONE.finditer(text)]


def score(text: str, start: int, end: int, kind: str) -> float:
    near = f"{text[max(0, start - CONTEXT) : start]} \n {text[end : end + CONTEXT]}"
    more, less = CONTEXT_WORDS[kind]
    out = RULES[kind][0] + RAISED * bool(more.search(near)) - LOWERED * bool(less.search(near))
    return round(min(1.0, max(0.0, out)), 2)


def find_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind; further spans that overlap a base span are left out."""
    base = base_spans(text)
    found = [(*span, score(text, *span)) for span in base]
    taken = sorted(span[:2] for span in base)
    for span in further_spans(text):
        value = score(text, *span)
        if value >= ACCEPTED and not any(a < span[1] and span[0] < b for a, b in taken):
            found.append((*span, value))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
SPANS_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def detect(df: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, spans). Null counts as empty; every row, repeated or not, gives a row.

    Null ids are kept. Texts of any length are searched whole, in time linear in them. Columns other than doc_id and text are not read; an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            [{"kind": k, "start": a, "end": b, "score": s} for a, b, k, s in find_spans(text or "")]
            for text in batch["text"].to_pylist()
        ]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, SPANS_TYPE)], ["doc_id", "spans"])

    return over_batches(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, spans {SPANS}")


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op1_pii(spark, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = detect(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_min(F.transform("spans", lambda s: s["score"])).alias("lowest_score"),
    )
