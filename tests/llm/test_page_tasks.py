"""Pages meet their neighbours whatever the number of tasks."""

import pytest

from kinestream.llm import html_text


@pytest.mark.parametrize("tasks", [1, 7, 60])
def test_the_number_of_tasks_changes_nothing(spark, tasks):
    # Each page's neighbour shares its frame, so all frames go, on the edges of tasks too.
    rows = [(i, f"http://h.org/{i // 2:03d}/{i % 2}", f"<div>Menu {i // 2}</div><div>story {i}</div><div>Imprint</div>") for i in range(40)]
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])
    assert sorted((r.page_id, r.text, r.n_shared) for r in got) == [(i, f"story {i}", 2) for i in range(40)]
