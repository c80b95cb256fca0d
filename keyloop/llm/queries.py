"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from keyloop.llm.byte_bpe import load_ranks, tokens_digest
from keyloop.llm.decontaminate import ORACLE as DECONTAMINATE_SQL
from keyloop.llm.decontaminate import contamination_digest
from keyloop.llm.html_extract import pages_digest
from keyloop.llm.line_dedup import ORACLE as LINE_SQL
from keyloop.llm.line_dedup import dedup_digest
from keyloop.llm.lm_scoring import lm_scores
from keyloop.llm.ngram_jaccard import ORACLE as JACCARD_SQL
from keyloop.llm.ngram_jaccard import jaccard_digest
from keyloop.llm.periodic_runs import runs_digest
from keyloop.llm.prefix_trie import ORACLE as TRIE_SQL
from keyloop.llm.prefix_trie import prefix_trie
from keyloop.llm.quality_classifier import quality_scores
from keyloop.llm.quality_rules import rules_digest
from keyloop.llm.source_mix import ORACLE as MIX_SQL
from keyloop.llm.source_mix import mix_digest
from keyloop.llm.substring_dedup import ORACLE as SUBSTRING_SQL
from keyloop.llm.substring_dedup import substring_digest
from keyloop.llm.text import tables
from keyloop.llm.toxicity import toxicity_scores


def op1_line_dedup(spark, sf_dir):
    return dedup_digest(tables(spark, sf_dir, "documents"))


def op2_decontaminate(spark, sf_dir):
    return contamination_digest(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"))


def op3_html_extract(spark, sf_dir):
    return pages_digest(tables(spark, sf_dir, "pages"))


def op4_byte_bpe(spark, sf_dir, name="byte_bpe_multi_50k.tiktoken"):
    import public_tokenizers  # needed here alone: the other queries register without it

    ranks = load_ranks(public_tokenizers.path(name))
    return tokens_digest(tables(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_quality_rules(spark, sf_dir):
    return rules_digest(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))


def op6_ngram_jaccard(spark, sf_dir):
    return jaccard_digest(tables(spark, sf_dir, "documents"))


def op7_quality_classifier(spark, sf_dir):
    return quality_scores(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))


def op8_lm_scoring(spark, sf_dir):
    return lm_scores(tables(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    return toxicity_scores(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))


def op10_substring_dedup(spark, sf_dir):
    return substring_digest(tables(spark, sf_dir, "documents"))


def op11_source_mix(spark, sf_dir):
    return mix_digest(tables(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(tables(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark, sf_dir):
    return runs_digest(tables(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_decontaminate, op3_html_extract, op4_byte_bpe,
    op5_quality_rules, op6_ngram_jaccard,
    op7_quality_classifier, op8_lm_scoring, op9_toxicity, op10_substring_dedup,
    op11_source_mix, op12_prefix_trie, op13_periodic_runs)}
ORACLE = {"op1_line_dedup": LINE_SQL, "op2_decontaminate": DECONTAMINATE_SQL,
          "op6_ngram_jaccard": JACCARD_SQL, "op10_substring_dedup": SUBSTRING_SQL,
          "op11_source_mix": MIX_SQL, "op12_prefix_trie": TRIE_SQL}
