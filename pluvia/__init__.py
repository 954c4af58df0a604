"""pluvia: daily-observation analytics on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column``) function
that takes column names as parameters; the weather names in
:mod:`pluvia.presets` are only the default preset.
"""

from pluvia.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
