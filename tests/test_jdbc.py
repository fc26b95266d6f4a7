"""The JDBC connector cannot reach a database here (none may run); these
tests cover its argument handling and that a bad URL fails loudly."""

import pytest

from cadence.sources import jdbc


def test_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="lower_bound"):
        jdbc.read_table(spark, "jdbc:postgresql://nowhere/db", "dim_song",
                        partition_column="song_id", num_partitions=8)


def test_unknown_driver_fails_loudly(spark):
    with pytest.raises(Exception, match="(?i)driver|suitable|jdbc"):
        jdbc.read_table(spark, "jdbc:nosuchdb://nowhere/db", "dim_song").collect()
