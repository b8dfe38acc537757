"""Tables that change as a whole."""

import os

import pytest

from fareloom.sources import versions
from fareloom.sources.versions import Store, replace_folder
from tests.conftest import rows


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def test_readers_follow_the_newest_complete_version(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.publish({"data": numbers(spark, 1)}) == 0
    old = store.read()
    assert store.publish({"data": numbers(spark, 2, 3)}, source="test") == 1
    assert sorted(rows(store.read())) == [(2,), (3,)] and rows(old) == [(1,)]  # a reader keeps what it began with
    assert store.manifest(1)["source"] == "test" and rows(store.read(number=0)) == [(1,)]
    with pytest.raises(FileNotFoundError):
        store.read(number=7)


@pytest.mark.parametrize("step", ["second part", "check", "seal"])
def test_a_write_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step):
    store = Store(spark, str(tmp_path / "t"))
    store.publish({"a": numbers(spark, 1), "b": numbers(spark, 1)})

    def die(*_):
        raise RuntimeError("killed")

    if step == "seal":
        monkeypatch.setattr(Store, "_seal", die)
    with pytest.raises(RuntimeError):
        store.publish({"a": numbers(spark, 2), "b": die if step == "second part" else numbers(spark, 2)}, check=die if step == "check" else None)
    monkeypatch.undo()
    assert rows(store.read("a")) == rows(store.read("b")) == [(1,)] and store.numbers() == [0]
    assert store.publish({"a": numbers(spark, 3), "b": numbers(spark, 3)}) == 2  # the number of the dead one is not used again
    assert rows(store.read("a")) == [(3,)]
    assert store.clean(keep=1) >= 2 and rows(store.read("b")) == [(3,)] and store.numbers() == [2]


def test_two_writers_have_two_numbers(spark, tmp_path):
    one, two = Store(spark, str(tmp_path / "t")), Store(spark, str(tmp_path / "t"))

    def second(_):
        two.publish({"data": numbers(spark, 2)})
        return numbers(spark, 1)

    assert one.publish({"data": second}) == 0
    assert one.numbers() == [0, 1] and rows(one.read()) == [(2,)]
    with pytest.raises(FileExistsError):
        one._seal(1, {}, {})


def test_a_repeated_batch_is_left_as_it_is(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    for n, x in ((0, 1), (1, 2), (1, 99)):
        assert store.publish({"data": numbers(spark, x)}, number=n) == n
    assert sorted(rows(store.read_all())) == [(1,), (2,)]


def test_cleaning_keeps_what_is_wanted(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    assert store.clean() == 0
    for x in range(4):
        store.publish({"data": numbers(spark, x)})
    assert store.clean(keep=2) == 2 and store.numbers() == [2, 3] and rows(store.read(number=2)) == [(2,)]


def test_a_folder_is_replaced_or_stays(spark, tmp_path):
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    numbers(spark, 1).write.parquet(old)
    with pytest.raises(OSError):
        replace_folder(spark, new, old)  # there is no new one
    assert rows(spark.read.parquet(old)) == [(1,)]
    numbers(spark, 2).write.parquet(new)
    replace_folder(spark, new, old)
    assert rows(spark.read.parquet(old)) == [(2,)] and os.listdir(tmp_path) == ["old"]
    assert versions.replace_folder is replace_folder
