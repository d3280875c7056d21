"""quillmart: a Spark-native sales, cost and recurring-revenue mart library.

Every public builder is a lazy function from DataFrames to a DataFrame with an
explicit ``as_of`` date. Nothing here collects data to the driver.
"""

from quillmart.constants import AS_OF  # noqa: F401

__all__ = ["AS_OF"]
