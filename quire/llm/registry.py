"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from . import byte_bpe as o3
from . import embedding_dedup as o5
from . import exact_dedup as o7
from . import jaccard_join as o8
from . import language_id as o4
from . import lm_scoring as o6
from . import packing as o10
from . import periodic_runs as o12
from . import secret_scan as o13
from . import suffix_dedup as o9
from . import toxicity as o2
from . import vector_codes as o11
from . import warc_audit as o1

QUERIES = {
    "op11_vector_codes": o11.op11_vector_codes,
    "op12_periodic_runs": o12.op12_periodic_runs,
    "op13_secret_scan": o13.op13_secret_scan,
    "op1_warc_audit": o1.op1_warc_audit,
    "op6_lm_scoring": o6.op6_lm_scoring,
    "op8_ngram_jaccard": o8.op8_ngram_jaccard,
    "op5_embedding_dedup": o5.op5_embedding_dedup,
    "op2_toxicity": o2.op2_toxicity,
    "op9_suffix_dedup": o9.op9_suffix_dedup,
    "op4_language_id": o4.op4_language_id,
    "op3_byte_bpe": o3.op3_byte_bpe,
    "op7_exact_dedup": o7.op7_exact_dedup,
    "op10_best_fit_packing": o10.op10_best_fit_packing,
}
SQL = {
    "op11_vector_codes": o11.SQL,
    "op13_secret_scan": o13.SQL,
    "op1_warc_audit": o1.SQL,
    "op6_lm_scoring": o6.SQL,
    "op7_exact_dedup": o7.SQL,
}
