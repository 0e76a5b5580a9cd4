"""Every query of this subpackage and the SQL to compare with."""

from __future__ import annotations

from tallyspan.llm import (
    automaton_dedup,
    bpe,
    chat_format,
    collocations,
    decontaminate,
    hard_negatives,
    html_text,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from tallyspan.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
