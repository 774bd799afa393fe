"""Queries of this subpackage, added to the catalog by the repository's entry module."""

from __future__ import annotations

from spanweave.llm import (
    chat_format,
    decontamination,
    id_output,
    importance,
    language_id,
    line_dedup,
    lm_scoring,
    packing,
    periodic_runs,
    quality_rules,
    simhash,
    substring_dedup,
    token_counts,
)

_MODULES = (
    packing,
    simhash,
    token_counts,
    line_dedup,
    id_output,
    language_id,
    lm_scoring,
    chat_format,
    decontamination,
    quality_rules,
    periodic_runs,
    substring_dedup,
    importance,
)


def queries():
    return {module.QUERY: module.query for module in _MODULES}


def oracle_sql():
    return {module.QUERY: module.ORACLE_SQL for module in _MODULES if module.ORACLE_SQL}
