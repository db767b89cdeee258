"""Results do not depend on the number of shuffle partitions (SURVEY 5 (d))."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

QUERIES = ["eav_wide_complete", "unpivot_percent_rank", "fold_assignment", "gap_score",
           "range_count", "point_in_polygon", "neighbour_areas", "run_best", "residual_histogram"]


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_for_3_and_17_partitions(spark, name):
    fn = E.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = _rows(fn(spark, SF_SMALL))
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = _rows(fn(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b
