"""Readers, writers and the flow that combines raw extracts."""

from blotter.sources.clusters import write_clustered
from blotter.sources.copies import CopyMismatch, compare_digests, digest
from blotter.sources.drift import drift, reconcile
from blotter.sources.extracts import (
    build_incidents,
    combine,
    compare_copies,
    count_rejects,
    rejects,
    verify_copies,
)
from blotter.sources.increments import merge_extract
from blotter.sources.lines import WHOLE_LINES, fitting, malformed, read_lines
from blotter.sources.profiles import merge_profiles, profiled_types, type_profile, types_of
from blotter.sources.scratch import (
    drop_scratch,
    scratch_path,
    stored,
    stored_and_measured,
    stored_in_buckets,
)
from blotter.sources.tables import read_csv, read_parquet, write_csv, write_parquet

__all__ = [
    "CopyMismatch",
    "WHOLE_LINES",
    "build_incidents",
    "combine",
    "compare_copies",
    "compare_digests",
    "count_rejects",
    "digest",
    "drift",
    "drop_scratch",
    "fitting",
    "malformed",
    "merge_extract",
    "merge_profiles",
    "profiled_types",
    "read_csv",
    "read_lines",
    "read_parquet",
    "reconcile",
    "rejects",
    "scratch_path",
    "stored",
    "stored_and_measured",
    "stored_in_buckets",
    "type_profile",
    "types_of",
    "verify_copies",
    "write_clustered",
    "write_csv",
    "write_parquet",
]
