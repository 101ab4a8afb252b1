"""Queries of the subpackage, one per operator, with their SQL where SQL can express them."""

from __future__ import annotations

from meterline.llm import (
    align,
    chat,
    decontaminate,
    exact,
    mixing,
    neardup,
    phrases,
    pii,
    quality,
    sharding,
    simhash,
    suffixes,
    tokens,
)
from meterline.suite.frames import Entry

ENTRIES = {
    "op1_pii": Entry(pii.op1_pii),
    "op2_decontamination": Entry(decontaminate.op2_decontamination),
    "op3_near_duplicates": Entry(neardup.op3_near_duplicates),
    "op4_sharding": Entry(sharding.op4_sharding),
    "op5_quality": Entry(quality.op5_quality),
    "op6_exact": Entry(exact.op6_exact, exact.OP6_SQL),
    "op7_mixing": Entry(mixing.op7_mixing, mixing.OP7_SQL),
    "op8_tokens": Entry(tokens.op8_tokens),
    "op9_chat": Entry(chat.op9_chat, chat.OP9_SQL),
    "op10_suffixes": Entry(suffixes.op10_suffixes),
    "op11_token_alignment": Entry(align.op11_token_alignment),
    "op12_simhash": Entry(simhash.op12_simhash),
    "op13_collocations": Entry(phrases.op13_collocations, phrases.OP13_SQL),
}
