"""quarry: data-mining operators on Spark DataFrames.

Every operator takes DataFrames (plus column names and parameters) and returns
a DataFrame; nothing is collected to the driver except small scalars that an
iterative algorithm needs to decide whether to continue.
"""

from quarry.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
