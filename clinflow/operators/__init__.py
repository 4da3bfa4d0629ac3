from clinflow.operators.combine import merge_groups, slice_rows, star_join
from clinflow.operators.dedup import dedup_first, explode_entries
from clinflow.operators.quantiles import percentile_at, value_counts, with_ranks
from clinflow.operators.ranking import top_k
from clinflow.operators.sequence import add_history
from clinflow.operators.skew import cut
from clinflow.operators.storage import materialize, scratch_path

__all__ = [
    "add_history", "cut", "dedup_first", "explode_entries", "materialize", "merge_groups",
    "percentile_at", "scratch_path", "slice_rows", "star_join", "top_k", "value_counts",
    "with_ranks",
]
