"""The named queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from .centroid_clusters import ORACLE_OP11, op11_centroid_clusters
from .common import prepared
from .contextual_pii import op12_contextual_pii
from .decontaminate import ORACLE_OP10, op10_benchmark_decontamination
from .html_text import op5_html_extraction
from .jaccard_join import ORACLE_OP2, op2_ngram_jaccard_join
from .language_id import op6_language_id
from .one_bit_search import ORACLE_OP9, op9_one_bit_neighbours
from .sentence_piece import op3_sentencepiece
from .sentence_spans import op1_substring_dedup
from .source_divergence import ORACLE_OP13, op13_source_divergence
from .suffix_dedup import ORACLE_OP7, op7_suffix_array_dedup
from .token_files import op8_token_files
from .url_rank import op4_url_trust

REGISTRY = {f.__name__: prepared(f) for f in (
    op1_substring_dedup,
    op2_ngram_jaccard_join,
    op3_sentencepiece,
    op4_url_trust,
    op5_html_extraction,
    op6_language_id,
    op7_suffix_array_dedup,
    op8_token_files,
    op9_one_bit_neighbours,
    op10_benchmark_decontamination,
    op11_centroid_clusters,
    op12_contextual_pii,
    op13_source_divergence,
)}

#: DuckDB SQL by query, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": ORACLE_OP2,
    "op7_suffix_array_dedup": ORACLE_OP7,
    "op9_one_bit_neighbours": ORACLE_OP9,
    "op10_benchmark_decontamination": ORACLE_OP10,
    "op11_centroid_clusters": ORACLE_OP11,
    "op13_source_divergence": ORACLE_OP13,
}
