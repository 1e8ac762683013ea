"""The registered queries: each dealt operator over its whole table, and the pipeline."""

from __future__ import annotations

from starweave.llm import config_packing, decontaminate, extract, language_id, packing, periodic_runs, quality, secrets, simhash, spelling, suffix_dedup, token_counts, topk
from starweave.llm.common import table

QUERIES = {
    "op1_main_text": lambda spark, sf_dir: extract.query(table(spark, sf_dir, "pages")),
    "op2_exact_top_k": lambda spark, sf_dir: topk.query(table(spark, sf_dir, "embeddings")),
    "op3_length_buckets": lambda spark, sf_dir: packing.query(table(spark, sf_dir, "documents")),
    "op4_token_counts": lambda spark, sf_dir: token_counts.query(table(spark, sf_dir, "documents")),
    "op5_language_id": lambda spark, sf_dir: language_id.query(table(spark, sf_dir, "documents")),
    "op6_decontamination": lambda spark, sf_dir: decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op7_quality": lambda spark, sf_dir: quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op8_simhash": lambda spark, sf_dir: simhash.query(table(spark, sf_dir, "documents")),
    "op10_suffix_dedup": lambda spark, sf_dir: suffix_dedup.query(table(spark, sf_dir, "documents")),
    "op9_secrets": lambda spark, sf_dir: secrets.query(table(spark, sf_dir, "documents")),
    "op11_periodic_runs": lambda spark, sf_dir: periodic_runs.query(table(spark, sf_dir, "documents")),
    "op12_config_packing": lambda spark, sf_dir: config_packing.query(table(spark, sf_dir, "documents")),
    "op13_spelling_variants": lambda spark, sf_dir: spelling.query(table(spark, sf_dir, "documents")),
}
