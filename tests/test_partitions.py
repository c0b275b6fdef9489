"""Results do not depend on the number of shuffle partitions."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.helpers import rows_of

NAMES = ["journey_score", "journey_trace", "redraw_until_accept", "next_event_after", "latest_per_key",
         "rows_at_group_max", "dedup_by_key", "framed_export", "keyed_uniform", "nearest_zone", "cooldown_chain",
         "nearest_centroid", "ordered_documents", "group_averages", "date_spine_counts"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_with_2_and_7_partitions(spark, name):
    out = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (2, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out.append(rows_of(E.queries()[name](spark, SF001)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
