"""Stages of few rows run in few tasks, whatever the number of shuffle partitions."""

from __future__ import annotations

import pytest

from roadtally.llm.components import components
from roadtally.llm.jaccard_join import near_duplicates


@pytest.fixture
def many_partitions(spark):
    """As on a cluster whose partitions are not merged afterwards."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 40
    for k, v in old.items():
        spark.conf.set(k, v)


def _tasks(spark, make):
    """What ``make`` returns, and the tasks its jobs ran."""
    group = f"tasks-{id(make)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        made = make()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return made, sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)


def test_components_of_few_links_take_few_tasks(spark, many_partitions):
    links = spark.createDataFrame([(i, i + 1) for i in range(30) if i % 10 != 9], "u long, v long").repartition(many_partitions)
    found, tasks = _tasks(spark, lambda: {r.node: r.component for r in components(links).collect()})
    assert found == {i: i - i % 10 for i in range(30)}
    # The links come from 40 tasks and are made distinct in 40; each round has six stages.
    assert tasks < 10 * many_partitions, tasks


def test_near_copies_in_many_partitions(spark, many_partitions):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[:-1] + [f"end{i}"])) for i in range(20)] + [(20 + i, " ".join(f"{w}x{i}" for w in words)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(many_partitions)
    found = {r.id: r.component_id for r in near_duplicates(docs, "doc_id", "text").collect()}
    assert found == {i: 0 if i < 20 else i for i in range(40)}
