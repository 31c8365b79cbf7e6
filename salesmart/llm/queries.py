"""The queries of this subpackage, by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from salesmart.llm.host_reputation import OP9_SQL, op9_host_reputation
from salesmart.llm.katz import op3_katz_scores
from salesmart.llm.language_profiles import op11_language_profiles
from salesmart.llm.longest_match import op10_token_counts
from salesmart.llm.mixing import op5_source_mixing
from salesmart.llm.packing import op1_best_fit_packing
from salesmart.llm.periodic_runs import op13_periodic_runs
from salesmart.llm.quality import OP6_SQL, op6_quality_rules
from salesmart.llm.secret_scan import OP4_SQL, op4_secret_scan
from salesmart.llm.spherical_caps import OP8_SQL, op8_spherical_caps
from salesmart.llm.superminhash import OP7_SQL, op7_superminhash
from salesmart.llm.token_files import op2_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_token_files": op2_token_files,
    "op3_katz_scores": op3_katz_scores,
    "op4_secret_scan": op4_secret_scan,
    "op5_source_mixing": op5_source_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_superminhash": op7_superminhash,
    "op8_spherical_caps": op8_spherical_caps,
    "op9_host_reputation": op9_host_reputation,
    "op10_token_counts": op10_token_counts,
    "op11_language_profiles": op11_language_profiles,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op4_secret_scan": OP4_SQL,
    "op6_quality_rules": OP6_SQL,
    "op7_superminhash": OP7_SQL,
    "op8_spherical_caps": OP8_SQL,
    "op9_host_reputation": OP9_SQL,
    "op12_hard_negatives": OP12_SQL,
}
