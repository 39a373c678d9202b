"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import audit, dominance, exact, linededup
from .audit import op12_audit_filters
from .dominance import op13_count_dominance
from .exact import op11_search_exact
from .langid import op1_identify_language
from .leaks import op4_find_leaks
from .linededup import op3_drop_recurring_lines
from .mixing import op10_mix_sources
from .neardup import op2_near_duplicates
from .secrets import op5_find_secrets
from .tokens import op9_count_tokens
from .toxicity import op7_score_toxicity
from .urls import op6_judge_urls
from .vectors import op8_nearest_vectors

QUERIES = {
    "op1_identify_language": op1_identify_language,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_drop_recurring_lines": op3_drop_recurring_lines,
    "op4_find_leaks": op4_find_leaks,
    "op5_find_secrets": op5_find_secrets,
    "op6_judge_urls": op6_judge_urls,
    "op7_score_toxicity": op7_score_toxicity,
    "op8_nearest_vectors": op8_nearest_vectors,
    "op9_count_tokens": op9_count_tokens,
    "op10_mix_sources": op10_mix_sources,
    "op11_search_exact": op11_search_exact,
    "op12_audit_filters": op12_audit_filters,
    "op13_count_dominance": op13_count_dominance,
}

ORACLES: dict[str, str] = {
    "op3_drop_recurring_lines": linededup.ORACLE,
    "op11_search_exact": exact.ORACLE,
    "op12_audit_filters": audit.ORACLE,
    "op13_count_dominance": dominance.ORACLE,
}
