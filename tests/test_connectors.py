"""The list stream and the staged writer."""

import json
import os

import pytest
from pyspark.sql import functions as F

from souk.sources import connectors, streams

ROWS = [(i, f"user-{i % 7}") for i in range(23)]


def test_list_stream_replays_from_its_offsets(spark, tmp_path):
    seen = []

    def run(rows):
        stream = connectors.list_stream(spark, rows, "id int, name string", per_task=2)
        streams.drain(stream, lambda batch, n: seen.append(sorted(map(tuple, batch.collect()))), "append", str(tmp_path / "c"))

    run(ROWS[:12])
    assert sorted(sum(seen, [])) == ROWS[:12]
    run(ROWS)  # a new stream of a longer list, from the same checkpoint
    assert sorted(sum(seen, [])) == ROWS


def folder_store(path):
    """Stages and published rows as JSON files of a folder that all processes here share."""

    class Store:
        def stage(self, stage, rows):
            with open(os.path.join(path, "staged", stage), "w") as f:
                json.dump([[k, dict(v)] for k, v in rows], f)

        def publish(self, stages):
            for s in stages:
                os.rename(os.path.join(path, "staged", s), os.path.join(path, "shown", s))

        def discard(self, start):
            for s in os.listdir(os.path.join(path, "staged")):
                if s.startswith(start):
                    os.remove(os.path.join(path, "staged", s))

        def close(self):
            pass

    for part in ("staged", "shown"):
        os.makedirs(os.path.join(path, part), exist_ok=True)
    return Store


def shown(path):
    return dict(p for n in os.listdir(f"{path}/shown") for p in json.load(open(f"{path}/shown/{n}")))


@pytest.mark.parametrize("broken", [False, True])
def test_staged_rows_show_all_or_none(spark, tmp_path, broken):
    path = str(tmp_path)
    connect = folder_store(path)
    rows = spark.range(0, 60, 1, 4).select(F.concat(F.lit("k:"), "id").alias("key"), F.create_map(F.lit("v"), F.col("id").cast("string")).alias("features"))
    if not broken:
        connectors.write_staged(rows, connect, flush_rows=4)
        assert shown(path) == {f"k:{i}": {"v": str(i)} for i in range(60)}
    else:
        lost = rows.withColumn("features", F.when(F.col("key") == "k:52", F.raise_error(F.lit("lost"))).otherwise(F.col("features")))
        with pytest.raises(Exception, match="lost"):
            connectors.write_staged(lost, connect, flush_rows=4)
        assert shown(path) == {}
        left = os.listdir(f"{path}/staged")  # of tasks that were still being stopped
        assert len({s.split("-")[0] for s in left}) <= 1
        for s in left:
            connect().discard(s.split("-")[0])
    assert os.listdir(f"{path}/staged") == []
