"""Window backfill, growing keyed tables, load order of windows and JSON arrays."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.plans.registry import LOAD_DATE, _land_dimensions, _land_window, _wrong_amounts
from ledgerline.plans.warehouse import LandedFeeds, Warehouse
from ledgerline.plans.windows import WindowedLayers
from ledgerline.session import scratch_path
from ledgerline.sources import files, jsonarray, sinks

from conftest import SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- keyed tables ---

def _keyed(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, seq int")


def test_buckets_are_the_same_rows_under_any_number(spark):
    """A key's bucket under n buckets is where its bucket under more of them came from."""
    df = spark.range(400).withColumnRenamed("id", "k")
    sizes = list(range(1, 40)) + [64, 65, 100]
    rows = df.select(*[sinks.bucket_of(["k"], n).alias(f"b{n}") for n in sizes]).collect()
    for r in rows:
        for n in sizes:
            assert 0 <= r[f"b{n}"] < n
            for m in sizes:
                if m >= n:
                    assert sinks.origin(r[f"b{m}"], n) == r[f"b{n}"]


def test_table_grows_and_a_batch_rewrites_a_bounded_part(spark):
    """Five batches of new keys: the table gets buckets, and what a small batch rewrites does not grow with it."""
    path, want, written = scratch_path(spark, "t_growing"), {}, []
    for step in range(5):
        rows = [(1000 * step + k, "v" * 50 + str(random.Random(1000 * step + k).random()), step) for k in range(600)]
        want.update({k: v for k, v, _ in rows})
        sinks.upsert_table(spark, path, _keyed(spark, rows), ["k"], ["seq"], bucket_bytes=6000)
    upsert, held = sinks._directory(spark, path)
    assert upsert == 5 and len(held) > 10 and sorted(held) == list(range(len(held)))
    total = sum(size for _, size in held.values())
    for k in range(2):  # three keys each
        sinks.upsert_table(spark, path, _keyed(spark, [(1000 * k + i, "new", 50) for i in range(3)]), ["k"], ["seq"], bucket_bytes=6000)
        now = sinks._directory(spark, path)[1]
        written.append(sum(size for b, (folder, size) in now.items() if folder != held.get(b, ("",))[0]))
        held = now
        want.update({1000 * k + i: "new" for i in range(3)})
    assert max(written) < total / 3
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == want


def test_a_killed_commit_leaves_the_old_table_and_can_be_repeated(spark, monkeypatch):
    path = scratch_path(spark, "t_killed")
    old = _keyed(spark, [(k, "old", 1) for k in range(50)])
    new = _keyed(spark, [(k, "new", 2) for k in range(25, 75)])
    sinks.upsert_table(spark, path, old, ["k"], ["seq"], bucket_bytes=1000)
    before = sinks.read_table(spark, path)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            sinks.upsert_table(spark, path, new, ["k"], ["seq"], bucket_bytes=1000)
    assert _rows(sinks.read_table(spark, path)) == _rows(old)
    sinks.upsert_table(spark, path, new, ["k"], ["seq"], bucket_bytes=1000)
    want = sorted([(k, "old", 1) for k in range(25)] + [(k, "new", 2) for k in range(25, 75)], key=repr)
    assert _rows(sinks.read_table(spark, path)) == want
    assert _rows(before) == _rows(old)  # a frame read before is not changed under its reader
    assert sinks.vacuum_table(spark, path) > 0 and sinks.vacuum_table(spark, path) == 0
    assert _rows(sinks.read_table(spark, path)) == want


def test_keyed_table_without_rows(spark):
    path = scratch_path(spark, "t_no_rows")
    assert sinks.upsert_table(spark, path, _keyed(spark, []), ["k"], ["seq"]).columns == ["k", "v", "seq"]
    assert _rows(sinks.upsert_table(spark, path, _keyed(spark, [(None, "a", 1), (1, None, 1)]), ["k"], ["seq"])) == [(1, None, 1), (None, "a", 1)]


# --- windows ---

ORDER = '{"ORDER_ID": "A", "ORDER_TIME_PST": 60000, "SHIP_TO_DISTRICT_NAME": "d", "SHIP_TO_CITY_CD": "c", ' \
        '"RPTG_AMT": %d, "CURRENCY_CD": "RMB", "ORDER_QTY": 1}'


def test_of_twelve_windows_the_last_wins(spark, tmp_path):
    for k in range(1, 13):
        folder = tmp_path / "dt=20240723" / f"load_window=window{k}"
        os.makedirs(folder)
        (folder / "f.json").write_text(ORDER % k)
        os.utime(folder / "f.json", (1_700_000_000 - k, 1_700_000_000 - k))
    rows = files.read_landed_feed2(spark, str(tmp_path))
    assert [int(r.rptg_amt) for r in sinks.latest_per_key(rows, ["order_id"], files.LOAD_ORDER).collect()] == [12]


def _layers(spark, w, root):
    return WindowedLayers(Warehouse(spark, SMALL, feeds=LandedFeeds(spark, root)), scratch_path(spark, "t_layers"))


def _plain_gold(spark, w, root):
    return Warehouse(spark, SMALL, feeds=LandedFeeds(spark, root)).gold


def test_reloaded_windows_equal_a_full_rebuild(spark):
    """Corrections, an order that leaves its window, a window that becomes empty, and a new window."""
    w = Warehouse.of(spark, SMALL)
    root = scratch_path(spark, "t_backfill")
    ends = lambda *x: F.substring("order_id", -1, 1).isin(*x)
    _land_window(w, root, "window1", lambda r: r)
    _land_window(w, root, "window9", lambda r: _wrong_amounts(r.where(ends("1", "2")), ends("1")))
    _land_window(w, root, "window10", lambda r: _wrong_amounts(r.where(ends("2", "3")), ends("2", "3")))
    _land_dimensions(w, root)
    layers = _layers(spark, w, root)
    layers.reload([(LOAD_DATE, f"window{k}") for k in (1, 9, 10)])
    assert _rows(layers.current()) == _rows(_plain_gold(spark, w, root))
    for make in (lambda r: r.where(ends("3")), lambda r: r.where("order_id = 'none'")):
        _land_window(w, root, "window10", make)
        layers.reload([(LOAD_DATE, "window10")])
        assert _rows(layers.current()) == _rows(_plain_gold(spark, w, root))
    _land_window(w, root, "window11", lambda r: _wrong_amounts(r.where(ends("1")), ends("1")))
    layers.reload([(LOAD_DATE, "window11")])
    assert _rows(layers.current()) == _rows(_plain_gold(spark, w, root))


def test_reload_reads_and_writes_one_window(spark):
    w = Warehouse.of(spark, SMALL)
    root = scratch_path(spark, "t_backfill_plan")
    for k in (1, 2, 3):
        _land_window(w, root, f"window{k}", lambda r: r.where(f"crc32(order_id) % 3 = {k - 1}"))
    _land_dimensions(w, root)
    layers = _layers(spark, w, root)
    layers.reload([(LOAD_DATE, f"window{k}") for k in (1, 2, 3)])
    for feed in ("feed1", "feed2"):
        landed = layers.landed(feed, [(LOAD_DATE, "window2")])
        read = [r.load_file for r in landed.select("load_file").distinct().collect()]
        assert read and all("load_window=window2" in f for f in read)
        plan = landed._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "load_window" in plan.split("PartitionFilters: [")[1].split("]")[0]
    before = {f: set(layers.read("gold", f).inputFiles()) for f in ("feed1", "feed2")}
    layers.reload([(LOAD_DATE, "window2")])
    for feed, files_ in before.items():
        after = set(layers.read("gold", feed).inputFiles())
        assert files_ - after and all("load_window=window2" in f for f in files_ ^ after)


# --- JSON arrays ---

_T = schemas.T
SCHEMA = _T.StructType([_T.StructField("a", _T.StringType()), _T.StructField("n", _T.LongType()),
                        _T.StructField("m", schemas.META), _T.StructField("l", _T.ArrayType(_T.IntegerType()))])


def _odd_records(seed, n):
    r = random.Random(seed)
    tricky = ['"', "\\", '\\"', "},{", '"},{"a":"', "[", "]", "{", "é日😀", "\n", "x" * 40, ""]
    return [{"a": "".join(r.choice(tricky) for _ in range(r.randint(0, 6))), "n": k,
             "m": {r.choice(tricky): r.choice(tricky) for _ in range(r.randint(0, 2))}, "l": list(range(r.randint(0, 3)))} for k in range(n)]


@pytest.mark.parametrize("size", [1, 7, 1000, 1 << 20])
def test_arrays_are_split_anywhere(spark, tmp_path, size):
    want = []
    for k, (indent, ascii_) in enumerate([(None, True), (2, False), (0, True)]):
        rows = _odd_records(k, {1: 1, 7: 2}.get(size, 30))
        want += [(x["a"], x["n"], sorted(x["m"].items()), x["l"]) for x in rows]
        (tmp_path / f"f{k}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    (tmp_path / "empty.json").write_text(" [ ] ")
    (tmp_path / "_SUCCESS").write_text("")
    df = jsonarray.read(spark, [str(tmp_path)], SCHEMA, size)
    assert sorted(map(repr, want)) == sorted(repr((r.a, r.n, sorted(r.m.items()), r.l)) for r in df.collect())
    if size == 1000:
        assert df.rdd.getNumPartitions() > 10


@pytest.mark.parametrize("text", ['{"a": "x"}', '[{"a": "x"}', '[1, 2]', '["x"]', '[[{"a": "x"}]]', '[{"a": "x"}] 5', '{"a":"x"}\n{"a":"y"}'])
def test_what_is_no_array_of_objects_is_refused(spark, tmp_path, text):
    (tmp_path / "f.json").write_text(text)
    with pytest.raises(Exception, match="array"):
        jsonarray.read(spark, [str(tmp_path)], SCHEMA, 5).collect()


def test_array_that_does_not_fit_the_schema_fails(spark, tmp_path):
    (tmp_path / "f.json").write_text('[{"n": "no number"}]')
    with pytest.raises(Exception):
        jsonarray.read(spark, [str(tmp_path)], SCHEMA).collect()


def test_written_arrays_are_arrays(spark):
    path = scratch_path(spark, "t_arrays")
    df = spark.range(1000).select(F.col("id").alias("n"), F.col("id").cast("string").alias("a")).repartition(3)
    jsonarray.write(df, path)
    folder = path.removeprefix("file:")
    parts = [json.load(open(os.path.join(folder, f))) for f in os.listdir(folder) if f.endswith(".txt")]
    assert sorted(x["n"] for p in parts for x in p) == list(range(1000))
    assert jsonarray.read(spark, [path], SCHEMA, 500).count() == 1000
