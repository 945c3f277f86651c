"""Keyed-table ETL on Spark: typed reads, lookups, upserts, rejects, loads and exports."""

from rowloom.keys import KeySpec, key_spec
from rowloom.session import build_session, scratch_dir

__all__ = ["KeySpec", "build_session", "key_spec", "scratch_dir"]
