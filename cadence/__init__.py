"""cadence: a Spark-native listening-history warehouse.

Raw play records -> cleaned plays -> star schema (song, artist, date
dimensions around an accumulating fact) -> staging views and marts ->
declarative data-quality checks.  Every step is a DataFrame transform
or a Spark write; nothing is pulled through the driver.
"""

__version__ = "0.1.0"
