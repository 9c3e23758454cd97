"""One query for each operator of this subpackage, and the DuckDB statements
of those that SQL can express."""

from __future__ import annotations

from .audit import OP12_SQL, op12_min_plus_filter_audit
from .bpe import op13_rank_array_bpe
from .jaccard import op9_size_aware_jaccard
from .langid import op4_string_kernel_language
from .neardup import op3_sorted_projection_neardup
from .packing import op10_linear_grouping_packing
from .pieces import op6_suffix_array_pieces
from .planes import op8_plane_files
from .quality import op7_subword_quality
from .repetition import op5_suffix_repetition
from .runs import op11_maximal_pair_runs
from .sharding import op1_histogram_sort_sharding
from .toxicity import op2_convolutional_toxicity

QUERIES = {f.__name__: f for f in (
    op1_histogram_sort_sharding, op2_convolutional_toxicity, op3_sorted_projection_neardup,
    op4_string_kernel_language, op5_suffix_repetition, op6_suffix_array_pieces, op7_subword_quality,
    op8_plane_files, op9_size_aware_jaccard, op10_linear_grouping_packing,
    op11_maximal_pair_runs, op12_min_plus_filter_audit, op13_rank_array_bpe)}

SQL: dict[str, str] = {"op12_min_plus_filter_audit": OP12_SQL}
