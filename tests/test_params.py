from __future__ import annotations

import pytest

from clickloom.params import TaskParams
from clickloom.sources.jdbc import jdbc_options


def test_json_of_one_element_arrays():
    params = TaskParams.from_json(
        '{"startDate":["2024-01-01"],"endDate":["2024-01-30"],"startAge":["20"],"endAge":["50"],'
        '"sex":["male"],"cities":[],"keywords":[""],"targetPageFlow":["0,1,2,3"],"other":["x"]}'
    )
    assert params == TaskParams(
        "2024-01-01", "2024-01-30", start_age=20, end_age=50, sex="male", page_flow=(0, 1, 2, 3)
    )


@pytest.mark.parametrize(
    "text",
    [
        "{}",
        '{"startDate":["2024-01-01"]}',
        '{"startDate":["2024-1-1"],"endDate":["2024-01-30"]}',
        '{"startDate":["2024-02-01"],"endDate":["2024-01-30"]}',
        '{"startDate":["2024-01-01"],"endDate":["2024-01-30"],"startAge":["old"]}',
    ],
)
def test_unusable_parameters_raise(text):
    with pytest.raises(ValueError):
        TaskParams.from_json(text)


def test_jdbc_split_is_all_or_nothing():
    base = {"url": "jdbc:x", "driver": "d"}
    assert jdbc_options(base, "city_info") == {**base, "dbtable": "city_info"}
    split = jdbc_options(base, "t", partition_column="id", bounds=(0, 100), partitions=4)
    assert split["partitionColumn"] == "id"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "4")
    with pytest.raises(ValueError):
        jdbc_options(base, "t", partition_column="id")
