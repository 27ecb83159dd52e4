"""The reorder buffer over a stream: late and missing names, a bound, and the same rows as on a table."""

import random

import pytest

from lociq.streaming.reorder import restore_order

ROWS = "file string, qname string, at timestamp, ordinal bigint, payload string"


@pytest.fixture()
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def rows_in_batches(seed):
    """Four batches: names come in order, alignments near their names, some before them, some for names that never come."""
    rnd = random.Random(seed)
    batches = [[] for _ in range(4)]
    for file in ("a", "b"):
        for i in range(24):
            b = i // 6
            if i % 9 != 4:
                batches[b].append((file, f"q{i}", 100 + b * 60, i, None))
            for n in range(rnd.randrange(3)):
                at = min(3, max(0, b + rnd.choice([0, 0, 0, 1, -1])))
                batches[at].append((file, f"q{i}", 100 + at * 60, None, f"{i}.{n}"))
    for b in batches:
        rnd.shuffle(b)
    return [*batches, [("c", "end", 100_000, 0, None)]]  # a later time lets the watermark pass


def run(spark, folder, batches, **how):
    import datetime

    got = []
    stamp = lambda s: datetime.datetime.fromtimestamp(s, datetime.timezone.utc).replace(tzinfo=None)
    for i, b in enumerate(batches):
        spark.createDataFrame([(f, q, stamp(at), o, p) for f, q, at, o, p in b], ROWS).coalesce(1).write.mode("append").parquet(f"{folder}/in{i}")
    files = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in*")
    query = restore_order(files, **how).writeStream.foreachBatch(lambda df, i: got.append(df.collect())).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    return got


def test_a_stream_gives_what_a_table_gives(rocks, tmp_path):
    batches = rows_in_batches(1)
    out = run(rocks, tmp_path, batches, wait="5 minutes", late="1 second")
    got = sorted(str((r.file, r.ordinal, r.qname, sorted(r.alignments))) for b in out for r in b if r.file != "c")
    table = rocks.read.schema(ROWS).parquet(f"{tmp_path}/in*")
    want = sorted(str((r.file, r.ordinal, r.qname, sorted(r.alignments))) for r in restore_order(table).collect() if r.file != "c")
    assert got == want and any("None" in x for x in got)
    for b in out:  # in order where rows leave together
        for f in "ab":
            ordinals = [r.ordinal for r in b if r.file == f and r.ordinal is not None]
            assert ordinals == sorted(ordinals)


def test_a_full_buffer_lets_the_oldest_go(rocks, tmp_path):
    """With room for 3 names every row still comes out once, the oldest before the rest has come."""
    batches = rows_in_batches(2)
    out = run(rocks, tmp_path, batches, most=3, wait="5 minutes", late="1 second")
    rows = [r for b in out for r in b if r.file != "c"]
    names = [(r.file, r.qname) for r in rows if r.ordinal is not None]
    assert len(names) == len(set(names)) == sum(o is not None for b in batches[:4] for _, _, _, o, _ in b)
    assert sorted(p for r in rows for p in r.alignments) == sorted(p for b in batches for *_, p in b if p)
    assert [r.ordinal for r in out[0] if r.file == "a"][:1] == [0]
