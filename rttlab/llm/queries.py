"""The operators' queries and the SQL that some of them equal."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, exact, fmindex, html, importance, merkle, mixing, packing, quality, simhash, suffix, urls, warc

QUERIES = {f.__name__: f for f in (
    quality.op1_quality_rules, packing.op2_best_fit_packing, urls.op3_url_filter, bpe.op4_bpe, warc.op5_warc,
    suffix.op6_suffix_array_dedup, fmindex.op7_substring_dedup, simhash.op8_simhash, exact.op9_exact_dedup,
    html.op10_html_text, importance.op11_importance_resampling, mixing.op12_source_mixing,
    merkle.op13_merkle_manifest)} | {"pipeline": corpus_pipeline.run}

ORACLE: dict[str, str] = {**quality.ORACLE, **suffix.ORACLE, **fmindex.ORACLE, **exact.ORACLE, **urls.ORACLE, **warc.ORACLE, **importance.ORACLE,
                          **mixing.ORACLE, **merkle.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
