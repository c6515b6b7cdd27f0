import pytest

from quizloom.operators.storage import (
    child_folders,
    materialise,
    materialise_alone,
    scratch,
    shared_folder,
)


def folders(spark):
    return set(child_folders(spark, shared_folder(spark)))


def test_blocks_remove_what_they_stored(spark):
    before = folders(spark)
    with scratch(spark):
        kept = materialise(spark.range(5))
        with scratch(spark):
            assert materialise(kept.filter("id > 2")).count() == 2
            assert len(folders(spark) - before) == 2
        assert len(folders(spark) - before) == 1
        assert kept.count() == 5
    assert folders(spark) == before


def test_blocks_remove_after_errors(spark):
    before = folders(spark)
    with pytest.raises(ValueError, match="broken"):
        with scratch(spark):
            materialise(spark.range(5))
            raise ValueError("broken")
    assert folders(spark) == before


def test_one_table_is_left(spark):
    def make():
        return materialise(spark.range(9)).join(materialise(spark.range(3, 20)), "id")

    before = folders(spark)
    with scratch(spark):
        rows = materialise_alone(spark, make)
        assert len(folders(spark) - before) == 1
        assert sorted(r.id for r in rows.collect()) == [3, 4, 5, 6, 7, 8]
    assert folders(spark) == before
    assert materialise_alone(spark, make).count() == 6
    assert len(folders(spark) - before) == 1
