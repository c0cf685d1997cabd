"""Shared scratch space."""

import os

from linktally.session import clear_scratch, scratch_path


def test_scratch_tables_of_this_application_are_removed(spark):
    clear_scratch(spark)
    written, unused = scratch_path(spark, "a"), scratch_path(spark, "b")
    spark.range(5).write.parquet(written)
    other = os.path.join(os.path.dirname(written), "other-table")
    spark.range(5).write.parquet(other)
    assert written != unused and clear_scratch(spark) == 1
    assert not os.path.exists(written) and os.path.exists(other)
    assert clear_scratch(spark) == 0
