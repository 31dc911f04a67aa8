"""Frame-level operators: mapping, nesting, ids, quality checks, content
fingerprints, joins along time and mergeable profiles."""

from lakewash.operators import ids, mapping, nested, quality  # noqa: F401
from lakewash.operators.ids import (
    audit_timestamp, random_uuid, source_file_stem, stable_uuid, with_surrogate_key,
)
from lakewash.operators.mapping import (
    apply_mapping, conform_to_schema, derive_columns, keep_original, normalize_columns,
    require_columns, to_zoneless,
)
from lakewash.operators.nested import explode_scalars, explode_structs, flatten_struct, nested_to_relational
from lakewash.operators.quality import (
    cascade_delete, cleaning_failure_report, contract_flags, duplicate_keys, foreign_key_orphans,
    latest_per_key, not_null_violations, null_counts, primary_key_violations, profile, quality_report,
    quality_rollup,
    require_non_empty,
    require_not_null, require_unique, row_cap, row_count, split_by_contract, split_rejects,
    unparsed_rows, uuid_format_violations,
)
from lakewash.operators.fingerprint import ContentMismatch, fingerprint, reconcile  # noqa: E402,F401
from lakewash.operators.sketches import merge_profiles, profile_sketch, read_profile  # noqa: E402,F401
from lakewash.operators.temporal import as_of_join, overlap_counts, overlapping_pairs  # noqa: E402,F401
