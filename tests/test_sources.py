import datetime as dt

from tidemark.session import cut_lineage, ensure_checkpoint_dir, scratch_dir
from tidemark.sources import tables as src


def test_duplicate_names_get_suffixes():
    assert src.suffix_duplicates(["x", "y", "x", "x"]) == ["x", "y", "x__1", "x__2"]


def test_snapshot_is_reused_until_it_is_old(spark):
    root, loads = scratch_dir(spark), []

    def loader():
        loads.append(1)
        return spark.range(len(loads))

    day = lambda d: dt.date(2024, 1, d)
    assert src.cached(spark, root, "k", loader, day(1)).count() == 1
    assert src.cached(spark, root, "k", loader, day(7)).count() == 1
    assert src.cached(spark, root, "k", loader, day(8)).count() == 2
    assert src.cached(spark, root, "k", loader, day(9)).count() == 2
    # a later snapshot is not used for an earlier day
    assert src.cached(spark, root, "k", loader, day(2)).count() == 1
    assert len(loads) == 2


def test_checkpoint_folder_named_by_the_session_is_used(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert cut_lineage(spark.range(3)).count() == 3
