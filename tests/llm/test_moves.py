"""Training shuffles no more moves than there are cores, and leaves none of them on disk."""

import time

import numpy as np

from raillark.llm import toxicity, workspace


def kept_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(k).getName() for k in range(files.length())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_moves_are_added_up_in_few_tasks(spark):
    rng = np.random.default_rng(1)
    rows = [(d % 24, int(d % 2), rng.integers(0, toxicity.BUCKETS, (6, 2)).astype(np.int32).tobytes()) for d in range(960)]
    docs = spark.createDataFrame(rows, "shard int, y int, ids binary").repartition(24, "shard").sortWithinPartitions("shard", "ids")
    docs = workspace.stored(docs, "dealt")
    had, tracker = kept_files(spark), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("moves", "moves")
    toxicity.trained(docs, np.ones(2), epochs=2)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("moves") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= spark.sparkContext.defaultParallelism
    until = time.time() + 10
    while kept_files(spark) - had and time.time() < until:
        time.sleep(0.2)
    assert kept_files(spark) <= had
