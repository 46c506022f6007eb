"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from macrotide.llm.decontamination import op7_decontamination
from macrotide.llm.filter_audit import op12_filter_audit
from macrotide.llm.lm_score import op8_lm_score
from macrotide.llm.mixing import op6_mixing
from macrotide.llm.oracle import ORACLE
from macrotide.llm.periodic_runs import op11_periodic_runs
from macrotide.llm.personal_data import op13_personal_data
from macrotide.llm.quality_classifier import op5_quality_classifier
from macrotide.llm.quality_rules import op4_quality_rules
from macrotide.llm.secret_scan import op3_secret_scan
from macrotide.llm.simhash import op1_simhash
from macrotide.llm.suffix_dedup import op9_suffix_dedup
from macrotide.llm.toxicity import op2_toxicity
from macrotide.llm.warc import op10_warc

QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_simhash, op2_toxicity, op3_secret_scan, op4_quality_rules, op5_quality_classifier, op6_mixing, op7_decontamination,
    op8_lm_score, op9_suffix_dedup, op10_warc, op11_periodic_runs, op12_filter_audit, op13_personal_data)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
