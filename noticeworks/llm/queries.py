"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from noticeworks.llm import bpe, html_text, license_scan, metric_join, ngram_join, periodic_runs, quality_rules, sharding, source_mix, token_align, token_counts, topk, url_filter


def queries():
    return {
        "op1_url_filter": url_filter.op1_url_filter,
        "op2_license_scan": license_scan.op2_license_scan,
        "op3_token_counts": token_counts.op3_token_counts,
        "op4_bpe_round_trip": bpe.op4_bpe_round_trip,
        "op5_quality_rules": quality_rules.op5_quality_rules,
        "op6_exact_topk": topk.op6_exact_topk,
        "op7_html_extraction": html_text.op7_html_extraction,
        "op8_source_mix": source_mix.op8_source_mix,
        "op9_kd_shards": sharding.op9_kd_shards,
        "op10_ngram_jaccard_join": ngram_join.op10_ngram_jaccard_join,
        "op11_token_alignment": token_align.op11_token_alignment,
        "op12_metric_dedup": metric_join.op12_metric_dedup,
        "op13_periodic_runs": periodic_runs.op13_periodic_runs,
    }


def oracle_sql():
    return {"op1_url_filter": url_filter.OP1_SQL, "op2_license_scan": license_scan.OP2_SQL, "op6_exact_topk": topk.OP6_SQL, "op10_ngram_jaccard_join": ngram_join.OP10_SQL, "op12_metric_dedup": metric_join.OP12_SQL}
