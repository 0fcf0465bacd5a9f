import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatscope.sources import arrow_dataset as A

TABLE = pa.table({
    "id": pa.array(range(1000), pa.int64()), "text": pa.array([None if i % 7 == 0 else f"tëxt {i}\n" for i in range(1000)]),
    "tags": pa.array([[f"t{j}" for j in range(i % 3)] for i in range(1000)], pa.list_(pa.string())),
    "msg": pa.array([{"role": "user", "n": i} for i in range(1000)], pa.struct([("role", pa.string()), ("n", pa.int32())])),
    "kind": pa.array([["a", "b", "c"][i % 3] for i in range(1000)]).dictionary_encode(),
    "small": pa.array([i % 256 for i in range(1000)], pa.uint8()), "big": pa.array([2**64 - 1 - i for i in range(1000)], pa.uint64()),
    "half": pa.array(np.arange(1000, dtype=np.float16)),
})


def save(root, parts, stream=True, options=None, state=True):
    """A folder as a dataset library leaves it."""
    root.mkdir(parents=True, exist_ok=True)
    names = []
    for k, part in enumerate(parts):
        names.append(f"data-{k:05d}-of-{len(parts):05d}.arrow")
        new = pa.ipc.new_stream if stream else pa.ipc.new_file
        with new(str(root / names[-1]), part.schema, options=options) as w:
            for b in part.to_batches(max_chunksize=64):
                w.write_batch(b)
    if state:
        (root / "state.json").write_text(json.dumps({"_data_files": [{"filename": n} for n in names], "_split": None}))
        (root / "dataset_info.json").write_text("{}")
    return str(root)


def want(table=TABLE):
    return [(r["id"], r["text"], r["tags"], (r["msg"]["role"], r["msg"]["n"]), r["kind"], r["small"], r["big"], float(r["half"]))
            for r in table.to_pylist()]


def rows(df):
    return [(r.id, r.text, r.tags, tuple(r.msg), r.kind, r.small, int(r.big), r.half) for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("stream", [True, False])
@pytest.mark.parametrize("codec", [None, "zstd"])
def test_two_shards_in_many_ranges(spark, tmp_path, stream, codec):
    options = pa.ipc.IpcWriteOptions(compression=codec)
    path = save(tmp_path / "d", [TABLE.slice(0, 600), TABLE.slice(600)], stream, options)
    assert rows(A.read_arrow_dataset(spark, path)) == want()
    fine = A.read_arrow_dataset(spark, path, partition_bytes=3000)
    assert fine.rdd.getNumPartitions() > 10 and rows(fine) == want()
    two = A.read_arrow_dataset(spark, path).select(F.spark_partition_id().alias("p"), "id").groupBy("p").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("p").collect()
    assert [(r.lo, r.hi) for r in two] == [(0, 599), (600, 999)]


def test_columns_are_read_alone(spark, tmp_path):
    path = save(tmp_path / "d", [TABLE])
    df = A.read_arrow_dataset(spark, path, columns=["kind", "id"])
    assert df.columns == ["kind", "id"] and df.count() == 1000
    assert df.where("kind = 'b'").agg(F.sum("id")).first()[0] == sum(i for i in range(1000) if i % 3 == 1)
    with pytest.raises(Exception, match="no column 'nothing'"):
        A.read_arrow_dataset(spark, path, columns=["nothing"])


def test_bodies_outside_the_range_are_not_read(tmp_path):
    path = save(tmp_path / "d", [TABLE])
    (file, size), = A.shards(path)
    with pa.OSFile(file) as f:
        found = list(A.messages(f))
    assert [k for k, _, _ in found].count(A.BATCH_MESSAGE) == 16 and found[0][0] == A.SCHEMA_MESSAGE

    read = []
    segments = A._Segments(pa.OSFile(file), [(a, n) for _, a, n in found[:1]])
    buffer = bytearray(10)
    while n := segments.readinto(buffer):
        read.append(n)
    assert sum(read) == found[0][2] < size / 10


def test_splits_missing_shards_and_cut_files(spark, tmp_path):
    for split in ("train", "test"):
        save(tmp_path / "s" / split, [TABLE.slice(0, 10)])
    (tmp_path / "s" / "dataset_dict.json").write_text('{"splits": ["train", "test"]}')
    assert A.read_arrow_dataset(spark, str(tmp_path / "s"), split="test").count() == 10
    with pytest.raises(Exception, match="name one"):
        A.read_arrow_dataset(spark, str(tmp_path / "s"))
    with pytest.raises(Exception, match="no saved dataset"):
        A.read_arrow_dataset(spark, str(tmp_path / "none"))
    path = save(tmp_path / "d", [TABLE, TABLE])
    (tmp_path / "d" / "data-00001-of-00002.arrow").unlink()
    with pytest.raises(Exception, match="has lost"):
        A.read_arrow_dataset(spark, path)
    whole = (tmp_path / "d" / "data-00000-of-00002.arrow").read_bytes()
    bare = tmp_path / "bare"
    bare.mkdir()
    (bare / "x.arrow").write_bytes(whole)
    assert A.read_arrow_dataset(spark, str(bare)).count() == 1000
    (bare / "x.arrow").write_bytes(whole[:len(whole) // 2])
    with pytest.raises(Exception, match="cut off"):
        A.read_arrow_dataset(spark, str(bare)).count()


def test_written_folders(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, None if i % 5 == 0 else f"é{i}", [("u", "x" * i)]) for i in range(100)],
        "id long, text string, messages array<struct<role string, content string>>").repartition(3)
    path = str(tmp_path / "w")
    A.write_arrow_dataset(df, path, split="train")
    assert len(A.shards(path)) == 3 and json.loads((tmp_path / "w" / "state.json").read_text())["_split"] == "train"
    back = A.read_arrow_dataset(spark, path)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    with pytest.raises(Exception, match="already holds"):
        A.write_arrow_dataset(df, path)
    A.write_arrow_dataset(df.limit(0), str(tmp_path / "e"))
    assert A.read_arrow_dataset(spark, str(tmp_path / "e")).collect() == []


def test_a_failed_write_leaves_no_dataset(spark, tmp_path):
    df = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("poison"))).otherwise("ok").alias("x"))
    with pytest.raises(Exception, match="poison"):
        A.write_arrow_dataset(df.repartition(3), str(tmp_path / "f"))
    assert not (tmp_path / "f" / "state.json").exists()
