"""DataFrame-in, DataFrame-out operators."""

from tableflow.operators.aggregates import aggregate, distinct_values, top_n
from tableflow.operators.cells import (
    append_cell_writes,
    bulk_layout,
    compact_cells,
    latest_cells,
    read_latest_cells,
    cells_long,
    cells_prefix_filter,
    cells_to_rows,
    create_cell_table,
    indexed_prefix_filter,
    key_ranges,
    prefix_filter,
    read_bulk,
    row_keys,
    rows_to_cells,
    salt_cells,
    scan_columns,
    upsert_cells,
    write_cells,
    write_bulk,
    write_indexed_cells,
)
from tableflow.operators.charsets import byte_pairs, charset_advice, charset_scores, fit_charsets
from tableflow.operators.columns import (
    cast_schema,
    drop_cols,
    parse_amount,
    rename_cols,
    round_cols,
    safe_names,
    select_rename,
    with_case,
)
from tableflow.operators.features import assemble, fit_labels, index_labels, label_index, one_hot, read_labels, string_index
from tableflow.operators.joins import join_alias, join_mapped, join_on, split_skew_join
from tableflow.operators.quality import (
    data_profile,
    encoding_profile,
    explode_lines,
    line_profile,
    merge_profiles,
    null_count,
    null_rows,
    profile_parts,
    schema_conformance,
)

__all__ = [name for name in dir() if not name.startswith("_")]
