"""Large JSON arrays read in ranges against reading them whole."""

import json
import random

import pytest

from normwatch.sources import array_records, arrays, read_json_array

TEXT = ['"', "\\", "{", "}", "[", "]", ",", ":", "é", "\n", "a", " ", "\t", "漢"]


def made(rng, depth=0):
    value = rng.random()
    if value < 0.4 or depth > 3:
        return "".join(rng.choice(TEXT) for _ in range(rng.randint(0, 12)))
    if value < 0.5:
        return rng.choice([None, True, 1.5, -3])
    if value < 0.7:
        return [made(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {f"k{i}{rng.choice(TEXT)}": made(rng, depth + 1) for i in range(rng.randint(0, 3))}


def record(rng, i):
    return {"id": i, **{f"f{k}": made(rng) for k in range(rng.randint(0, 3))}}


def found(spark, path, size):
    texts = [r["value"] for r in array_records(spark, str(path), size).collect()]
    return sorted(json.dumps(json.loads(t), sort_keys=True) for t in texts)


@pytest.mark.parametrize("seed,indent", [(0, None), (1, 2), (2, None), (3, 1)])
def test_any_ranges_give_the_same_records(spark, tmp_path, seed, indent):
    rng = random.Random(seed)
    files = {f"f{k}.json": [record(rng, 1000 * k + i) for i in range(rng.choice([0, 1, 60]))] for k in range(4)}
    files["big.json"] = [record(rng, 9000 + i) for i in range(120)]
    for name, rows in files.items():
        text = json.dumps(rows, indent=indent, ensure_ascii=bool(rng.randint(0, 1)))
        (tmp_path / name).write_text(text + rng.choice(["", "\n"]), encoding="utf-8")
    want = sorted(json.dumps(r, sort_keys=True) for rows in files.values() for r in rows)
    for size in (64, 1000, 1 << 27):
        assert found(spark, tmp_path, size) == want


def test_many_tasks_read_one_file(spark, tmp_path):
    rows = [{"id": i, "text": 'a "quoted" } ] { \\ text'} for i in range(5000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    read = read_json_array(spark, str(tmp_path), range_bytes=10_000)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == setting
    assert read.schema.simpleString() == "struct<id:bigint,text:string>"
    assert sorted((r["id"], r["text"]) for r in read.collect()) == [(r["id"], r["text"]) for r in rows]


def test_what_is_no_record(spark, tmp_path):
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "blank.json").write_text(" \n")
    (tmp_path / "odd.json").write_text('[1, {"a": 1}, {"a": 2} , {"a": [{}]}]  ')
    texts = sorted(r["value"] for r in array_records(spark, str(tmp_path), 8).collect())
    assert texts == ['1, {"a": 1}', '{"a": 2}', '{"a": [{}]}']
    read = read_json_array(spark, str(tmp_path), corrupt="bad", range_bytes=8)
    assert sorted(r["bad"] for r in read.collect() if r["bad"]) == ['1, {"a": 1}']


def test_small_ranges_share_tasks(spark, tmp_path):
    records = [{"a": i, "b": f"}}{{ \"{i}\" ["} for i in range(400)]
    path = str(tmp_path / "one.json")
    with open(path, "w") as out:
        json.dump(records, out)
    before = spark.conf.get(arrays.RANGE_CONF)
    spark.conf.set(arrays.RANGE_CONF, "64")
    try:
        pieces = arrays._pieces(spark, path, 1 << 20)
        assert pieces.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert pieces.select("start").distinct().count() > 100
    finally:
        spark.conf.set(arrays.RANGE_CONF, before)
    texts = arrays.array_records(spark, path, 64).collect()
    assert sorted(json.loads(r["value"])["a"] for r in texts) == list(range(400))
