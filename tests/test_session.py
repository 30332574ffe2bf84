"""Stored tables and their lifetime."""

import os

from salesprism.session import materialised, run_folder, table_folder


def test_run_folder_is_removed(spark):
    outside = table_folder(spark)
    with run_folder(spark) as path:
        assert table_folder(spark) == path
        stored = materialised(spark.range(5))
        assert stored.count() == 5
        local = path.removeprefix("file://").removeprefix("file:")
        assert len(os.listdir(local)) == 1
        with run_folder(spark) as inner:
            assert table_folder(spark) == inner != path
        assert table_folder(spark) == path
    assert not os.path.exists(local)
    assert table_folder(spark) == outside
