"""The stateful stream against the stream that rereads its log, over batches and restarts."""

import random

from pagequarry.sources import stores
from pagequarry.streaming import incremental, stateful

SCHEMA = "path string, filename string, length bigint, content string"


def test_batches_and_restarts_give_the_same_records(spark, tmp_path):
    rng = random.Random(7)
    source = str(tmp_path / "in")
    state, plain = str(tmp_path / "state"), str(tmp_path / "plain")

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run(start, root):
        start(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), root).awaitTermination()

    for round_no in range(3):
        for _ in range(1 + round_no % 2):  # several batches in a run, then a restart
            rows = []
            for i in range(14):
                name = f"doc {rng.randrange(12)}{rng.choice(['.pdf', '.csv', '.txt'])}"
                rows.append((f"/{rng.randrange(4)}/{i}/{name}", name, 1, rng.choice(["A", "B", None])))
            arrive(rows)
        run(stateful.start_stateful, state)
        run(incremental.start_incremental, plain)
        fields = [f for f in stateful._FIELDS]
        want = stores.current_index(stores.index_log(spark, plain, incremental.RECORD)).select(*fields).collect()
        got = stateful.current_records(spark, state).select(*fields).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr) and len(got) > 5
    logged = stateful.records(spark, state)
    assert logged.count() == stores.index_log(spark, plain, incremental.RECORD).count()
    before = logged.count()
    run(stateful.start_stateful, state)  # nothing new
    assert stateful.records(spark, state).count() == before
