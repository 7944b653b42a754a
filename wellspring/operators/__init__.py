"""Table operators the survey jobs are composed of."""

from wellspring.operators.heavy import combine_summaries, heavy_keys, heavy_of, key_summary
from wellspring.operators.joins import (hot_keys, hot_keys_by, not_in, salt_counts, semi_join, skew_join,
                                       skew_join_chain)
from wellspring.operators.layout import bucketed_join, drop_bucketed, layout_for, layout_of, store_dim, store_fact
from wellspring.operators.ranking import row_number_within, running_totals, top_n_within
from wellspring.operators.scans import (append_batch, drop_table, drop_temporaries, materialize, preview,
                                        publish_folder, snapshot)

__all__ = [
    "append_batch", "bucketed_join", "combine_summaries", "drop_bucketed", "drop_table", "drop_temporaries", "heavy_keys",
    "heavy_of", "hot_keys", "hot_keys_by", "key_summary", "layout_for", "layout_of", "materialize", "not_in", "preview",
    "publish_folder",
    "row_number_within", "running_totals", "salt_counts", "semi_join", "skew_join", "skew_join_chain", "snapshot",
    "store_dim", "store_fact", "top_n_within",
]
