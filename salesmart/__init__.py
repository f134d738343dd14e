"""salesmart: Spark-native sales warehouse jobs.

Every public function takes and returns DataFrames (or a tuple of them);
nothing on a data path collects to the driver.
"""

from salesmart.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
