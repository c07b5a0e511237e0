"""starloom: a Spark-native cleansing and star-schema library.

Raw tables -> cleansed, flagged, deduplicated silver tables -> dimensions
and facts -> business reports, integrity checks and profiles.  Everything
is DataFrame / SQL composition so Catalyst plans it; the only Python-side
row work is the workbook reader in ``starloom.sources.workbook``.
"""

from starloom.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
