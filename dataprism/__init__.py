"""Dataset profiling on Spark: mergeable per-column statistics per partition, time bucket and segment."""

from dataprism.functions.buckets import parse_freq
from dataprism.operators.filters import filter_days
from dataprism.operators.merge import merge_profiles
from dataprism.operators.payload import make_payload, profile_payload
from dataprism.operators.profile import profile
from dataprism.operators.publish import FileProfileWriter, publish, read_store
from dataprism.operators.summary import profile_summary
from dataprism.session import get_session
from dataprism.sources.datagen import amplify, employees, employees_from
from dataprism.sources.profile_files import read_profiles
from dataprism.version import __version__

__all__ = [
    "profile", "profile_summary", "merge_profiles", "filter_days", "parse_freq", "profile_payload", "make_payload",
    "publish", "read_store", "FileProfileWriter", "read_profiles", "employees", "employees_from", "amplify",
    "get_session", "__version__",
]
