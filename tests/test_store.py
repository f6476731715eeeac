"""Puts, bulk loads and what they leave on disk."""

import glob
from bisect import bisect_right
from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plans import plan_of
from tableflow import PipelineSpec, build, run
from tableflow.sinks import cells as cell_sink
from tableflow.sinks.store import CellStore, PartitionedTable
from tableflow.spec import TargetSpec


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def drop(spark, name):
    for table in (name, f"{name}_loads"):
        spark.sql(f"drop table if exists {table.replace(':', '.')}")


class Store:
    """A store in a test folder, written and read through specs."""

    def __init__(self, spark, folder, name=None, kind="parquet"):
        self.spark, self.folder, self.kind = spark, folder, kind
        if name:
            drop(spark, name)
        self.name = name or f"{folder}/cells"

    def write(self, df, **options):
        df.createOrReplaceTempView("rows_to_write")
        source = {"id": "r", "source": "ext_hive", "location": "rows_to_write", "join": "r"}
        options = {"tablename": self.name, "cf": "d", "format": self.kind} | options
        target = {"place": "hbase", "options": options}
        run(self.spark, PipelineSpec.from_dict({"source": {"mapping": [source]}, "target": target}))
        self.spark.catalog.dropTempView("rows_to_write")

    def bulk(self, df, regions, **options):
        staging = f"{self.folder}/staging"
        self.write(df, bulkload="true", **{"num-regions": regions, "bulk-stg": staging}, **options)

    def wide(self, names, **more):
        source = {"id": "w", "source": "hbase", "location": self.name, "column.family": "d", "join": "w"}
        source |= {"format": self.kind, "custom": {"mapping": {name: name for name in names}}} | more
        return build(self.spark, PipelineSpec.from_dict({"source": {"mapping": [source]}}))

    def rows(self, *names):
        wide = self.wide([name for name in names if name != "rowkey"])
        return sorted((tuple(row) for row in wide.select(*names).collect()), key=repr)

    def splits(self):
        return CellStore(self.spark, self.name, self.kind).splits()

    def files(self):
        """Region and (key, qualifier) list of every bulk-loaded file."""
        for path in glob.glob(f"{self.folder}/cells/load=*/region=*/*.parquet"):
            region = int(path.split("region=")[1].split("/")[0])
            cells = pq.ParquetFile(path).read(columns=["rowkey", "qualifier"]).to_pydict()
            if region >= 0:
                yield region, list(zip(cells["rowkey"], cells["qualifier"]))

    def check_layout(self):
        splits, total = self.splits(), 0
        for region, cells in self.files():
            assert cells == sorted(cells)
            assert {bisect_right(splits, key) for key, _ in cells} == {region}
            total += len(cells)
        return total


def numbers(spark, count):
    return spark.range(count).selectExpr("id", "cast(id % 7 as string) as b", "if(id % 5 = 0, null, id) as a")


def as_text(count):
    rows = [(str(n), str(n % 7), None if n % 5 == 0 else str(n)) for n in range(count)]
    return sorted(rows, key=repr)


def test_puts_add_up(spark, store):
    store.write(numbers(spark, 20))
    store.write(spark.range(20, 30).select("id"))
    expected = as_text(20) + [(str(n), None, None) for n in range(20, 30)]
    assert store.rows("id", "b", "a") == sorted(expected, key=repr)
    assert store.splits() == []


def test_a_put_needs_no_shuffle(spark):
    df = numbers(spark, 20)
    cells = cell_sink.row_to_cells(df, cell_sink.row_key(df), "d", F.lit(1))
    assert "Exchange" not in plan_of(cells) and "Sort" not in plan_of(cells)


def test_newer_versions_win_and_newer_nulls_hide(spark, store):
    keyed = {"key-columns": ["k"]}
    store.write(spark.sql("select 'x' as k, 1 as v, 1 as w"), version=1, **keyed)
    store.write(spark.sql("select 'x' as k, 2 as v, cast(null as int) as w"), version=3, **keyed)
    store.write(spark.sql("select 'x' as k, 9 as v"), version=2, **keyed)
    assert store.rows("k", "v", "w") == [("x", "2", None)]


def test_without_a_version_a_later_write_wins(spark, store):
    for value in (1, 2):
        store.write(spark.sql(f"select 'x' as k, {value} as v"), **{"key-columns": ["k"]})
    assert store.rows("v") == [("2",)]


def test_a_cell_source_also_projects_and_filters(spark, store):
    store.write(numbers(spark, 20), **{"key-columns": ["id"]})
    wide = store.wide(["b", "a"], columns=["rowkey", "a"], where="b = '3' and rowkey > '1'")
    assert sorted(wide.collect()) == [("10", None), ("17", "17"), ("3", "3")]


@pytest.mark.parametrize("regions", [1, 2, 5, 40])
def test_bulk_load_with_random_keys(spark, store, regions):
    store.bulk(numbers(spark, 200), regions)
    assert store.rows("id", "b", "a") == as_text(200)
    assert store.check_layout() == 600
    # the saved split keys are stored row keys, at equal distances
    keys = sorted({key for _, cells in store.files() for key, _ in cells})
    assert len(keys) == 200 and len(store.splits()) == regions - 1
    assert store.splits() == sorted(keys[(2 * 200 * i + regions - 1) // (2 * (regions - 1))] for i in range(regions - 1))
    # the smallest key is the first split key, so region 0 stays empty
    assert regions == 1 or 0 not in {region for region, _ in store.files()}
    assert glob.glob(f"{store.folder}/staging/*") == []


@pytest.mark.parametrize("regions", [1, 12, 1000])
@pytest.mark.parametrize("regions_per_task", [4, 64])
def test_one_plan_for_any_number_of_regions(spark, store, monkeypatch, regions, regions_per_task):
    monkeypatch.setattr(cell_sink, "REGIONS_PER_TASK", regions_per_task)
    plans = []
    unpivot = cell_sink.unpivot_cells

    def seen(placed, *args):
        plans.append(plan_of(placed, "simple"))
        return unpivot(placed, *args)

    monkeypatch.setattr(cell_sink, "unpivot_cells", seen)
    store.bulk(numbers(spark, 300), regions)
    assert store.check_layout() == 900 and store.rows("id", "b", "a") == as_text(300)
    (plan,) = plans
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and "rangepartitioning" not in plan


def test_regions_are_dealt_to_tasks():
    deal = cell_sink.deal_regions
    assert deal({}, 10) == ([], [], 0)
    assert deal({0: 3, 1: 3, 2: 3, 3: 3}, 6) == ([0, 0, 1, 1], [1, 1, 1, 1], 2)
    assert deal({1: 25, 2: 1, 4: 30}, 10) == ([0, 1, 4, 4, 5], [1, 3, 1, 1, 3], 8)
    first, parts, tasks = deal({region: 1 for region in range(200)}, 1e9)
    assert tasks == 4 and max(first.count(task) for task in range(4)) == 64 and set(parts) == {1}


def test_bulk_load_with_keys_from_columns(spark, store):
    df = spark.sql("select explode(array('a', 'a!', 'a$b', 'a$', 'b', 'é', 'Z')) as k").withColumn("v", F.col("k"))
    store.bulk(df, 4, **{"key-columns": ["k"]})
    assert store.rows("k", "v") == sorted([(k, k) for k in ("a", "a!", "a$b", "a$", "b", "é", "Z")], key=repr)
    assert store.splits() == ["Z", "a!", "b"]
    assert store.check_layout() == 14


@pytest.mark.parametrize("bytes_per_task", [300, 2**28])
def test_rows_that_share_a_key_stay_sorted(spark, store, monkeypatch, bytes_per_task):
    monkeypatch.setattr(cell_sink, "BYTES_PER_TASK", bytes_per_task)
    rows = spark.range(300).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as k", "id as b", "id as a")
    store.bulk(rows, 5, **{"key-columns": ["k"]})
    assert store.check_layout() == 900
    # no cell is lost, also of equal keys
    assert CellStore(spark, store.name).read().where("rowkey = 'hot'").count() == 300


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_a_hot_key_is_written_by_many_tasks(spark, store, monkeypatch, keys):
    monkeypatch.setattr(cell_sink, "BYTES_PER_TASK", 2000)
    rows = spark.range(3000).selectExpr("if(id % 3 > 0, 'hot', cast(id as string)) as k", "id as v")
    store.bulk(rows, 3, **({"key-columns": keys} if keys else {}))
    assert store.check_layout() == 6000
    assert max(len(cells) for _, cells in store.files()) < 1000


def test_an_existing_target_keeps_its_split_keys(spark, store):
    keyed = {"key-columns": ["k"]}
    store.bulk(spark.sql("select explode(array('c', 'e', 'g')) as k"), 4, version=1, **keyed)
    assert store.splits() == ["c", "e", "g"]
    # keys below the first and above the last split key go to the open ends
    later = spark.sql("select explode(array('a', 'd', 'z', 'c')) as k, 1 as v")
    store.bulk(later, 99, version=2, **keyed)
    assert store.splits() == ["c", "e", "g"]
    assert store.check_layout() == 3 + 8
    got = {row.rowkey: row.v for row in store.wide(["v"]).collect()}
    assert got == {"c": "1", "e": None, "g": None, "a": "1", "d": "1", "z": "1"}


def test_bulk_after_put_has_one_region(spark, store):
    store.write(numbers(spark, 10))
    store.bulk(numbers(spark, 50), 7)
    assert store.splits() == [] and store.check_layout() == 150
    assert store.rows("id", "b", "a") == sorted(as_text(10) + as_text(50), key=repr)


def test_an_empty_load_creates_the_target(spark, store):
    store.bulk(numbers(spark, 0), 5)
    assert store.splits() == [] and store.rows("id") == []


def test_columns_with_awkward_names(spark, store):
    df = spark.sql("select 1 as rowkey, 2 as region, 3 as spread, 4 as c0, 5 as `x.y z`, 6 as value, 7 as load")
    store.bulk(df, 2)
    names = ["region", "spread", "c0", "value", "load"]
    assert store.rows(*names) == [("2", "3", "4", "6", "7")]
    qualifiers = {row.qualifier for row in CellStore(spark, store.name).read().collect()}
    assert qualifiers == set(df.columns) and store.check_layout() == 7


def test_orc_store(spark, tmp_path):
    store = Store(spark, str(tmp_path), kind="orc")
    store.write(numbers(spark, 10))
    store.bulk(numbers(spark, 30), 3)
    assert store.rows("id", "b", "a") == sorted(as_text(10) + as_text(30), key=repr)


@pytest.mark.parametrize("name", ["tableflow_store_test", "default:tableflow_store_test"])
def test_catalog_store(spark, tmp_path, name):
    store = Store(spark, str(tmp_path), name=name)
    store.bulk(numbers(spark, 40), 4)
    store.write(numbers(spark, 10))
    assert store.rows("id", "b", "a") == sorted(as_text(10) + as_text(40), key=repr)
    assert len(store.splits()) == 3
    drop(spark, "tableflow_store_test")
    assert store.splits() is None


def test_a_bucketed_cell_table_is_read_without_a_shuffle(spark, store):
    store.write(numbers(spark, 30))
    cells = CellStore(spark, store.name).read()
    cells.write.bucketBy(4, "rowkey").sortBy("rowkey").saveAsTable("tableflow_bucketed_test")
    store.name = "tableflow_bucketed_test"
    assert "Exchange" not in plan_of(store.wide(["id", "b", "a"]))
    assert store.rows("id", "b", "a") == as_text(30)
    spark.sql("drop table tableflow_bucketed_test")


def failing(*args, **kwargs):
    raise OSError("lost")


STEPS = {
    "arrange": (cell_sink, "region_cells"),
    "insert": (PartitionedTable, "insert"),
    "add": (CellStore, "add"),
    "finish": (CellStore, "finish"),
}


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("before", [0, 20])
@pytest.mark.parametrize("table", [False, True])
def test_a_failed_load_leaves_no_trace(spark, tmp_path, monkeypatch, step, before, table):
    store = Store(spark, str(tmp_path), name="tableflow_failed_test" if table else None)
    if before:
        store.bulk(numbers(spark, before), 3)
    rows, splits = (store.rows("id", "b", "a"), store.splits()) if before else ([], None)
    monkeypatch.setattr(*STEPS[step], failing)
    with pytest.raises(OSError, match="lost"):
        store.bulk(spark.range(9).selectExpr("id", "'x' as b", "id as a"), 9)
    monkeypatch.undo()
    assert store.splits() == splits and glob.glob(f"{tmp_path}/staging/*") == []
    assert not before or store.rows("id", "b", "a") == rows
    # the rerun starts afresh, with its own split keys, and no row is there twice
    store.bulk(numbers(spark, 150), 8)
    assert store.rows("id", "b", "a") == sorted(rows + as_text(150), key=repr)
    assert len(store.splits()) == (len(splits) if before else 7)
    drop(spark, "tableflow_failed_test")


def test_a_failed_put_leaves_no_trace(spark, store, monkeypatch):
    monkeypatch.setattr(CellStore, "finish", failing)
    with pytest.raises(OSError, match="lost"):
        store.write(numbers(spark, 5))
    monkeypatch.undo()
    store.bulk(numbers(spark, 30), 3)
    assert len(store.splits()) == 2 and store.rows("id", "b", "a") == as_text(30)


@pytest.mark.parametrize("table", [False, True])
def test_a_store_keeps_the_format_of_its_first_load(spark, tmp_path, table):
    name = "tableflow_format_test" if table else None
    store = Store(spark, str(tmp_path), name=name, kind="orc")
    drop(spark, "tableflow_format_test")
    store.bulk(numbers(spark, 30), 3)
    for later in ("write", "bulk"):
        getattr(store, later)(*([numbers(spark, 10), 3][: 2 if later == "bulk" else 1]), format="")
    store.kind = ""
    assert store.rows("id", "b", "a") == sorted(as_text(10) * 2 + as_text(30), key=repr)
    with pytest.raises(ValueError, match="holds orc"):
        store.write(numbers(spark, 3), format="parquet")
    drop(spark, "tableflow_format_test")


@pytest.mark.parametrize("kind", ["csv", "json", "text"])
def test_formats_that_lose_text_are_refused(spark, store, kind):
    for write in (store.write, lambda df, **options: store.bulk(df, 2, **options)):
        with pytest.raises(ValueError, match="cannot be kept"):
            write(numbers(spark, 3), format=kind)


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_null_empty_and_blank_text_stay_apart(spark, tmp_path, kind):
    store = Store(spark, str(tmp_path), kind=kind)
    df = spark.sql("select explode(array(cast(null as string), '', ' x ')) as v")
    store.bulk(df, 2)
    store.write(df)
    assert store.rows("v") == sorted([(v,) for v in (None, "", " x ")] * 2, key=repr)


@pytest.mark.parametrize("table", [False, True])
@pytest.mark.parametrize("rows,expected", [
    ({"from": "2", "to": "5"}, lambda k: "2" <= k < "5"),
    ({"from": "95"}, lambda k: k >= "95"),
    ({"to": "11"}, lambda k: k < "11"),
    ({"from": "7", "to": "7"}, lambda k: False),
])
def test_a_key_range_reads_its_regions_and_the_puts(spark, tmp_path, rows, expected, table):
    store = Store(spark, str(tmp_path), name="tableflow_range_test" if table else None)
    drop(spark, "tableflow_range_test")
    keyed = {"key-columns": ["id"]}
    store.bulk(numbers(spark, 100), 10, **keyed)
    store.bulk(spark.range(100, 200).selectExpr("id", "'n' as b"), 3, **keyed)
    store.write(spark.range(200, 260).selectExpr("id", "'p' as b"), **keyed)
    wide = store.wide(["b"], custom={"mapping": {"b": "b"}, "rows": rows})
    keys = [str(n) for n in range(260)]
    assert sorted(r.rowkey for r in wide.collect()) == sorted(k for k in keys if expected(k))
    plan = plan_of(wide)
    pruned = any("PartitionFilters" in line and "region" in line for line in plan.splitlines())
    assert pruned or "LocalTableScan" in plan  # an empty range reads nothing at all
    drop(spark, "tableflow_range_test")


OVERLAPS = {
    "bulk": lambda store, rows: store.bulk(rows, 4, **{"key-columns": ["k"]}),
    "put": lambda store, rows: store.write(rows, **{"key-columns": ["k"]}),
}


@pytest.mark.parametrize("table", [False, True])
@pytest.mark.parametrize("second", OVERLAPS)
def test_a_load_that_overlaps_a_first_load_loses_nothing(spark, tmp_path, monkeypatch, second, table):
    """Both loads find no store, and each lays its cells out by what it knows."""
    store = Store(spark, str(tmp_path), name="tableflow_overlap_test" if table else None)
    a, b = (spark.range(400).selectExpr(f"concat('{c}', lpad(id, 4, '0')) as k", "id as v") for c in "ab")
    arrange, run_already = cell_sink.region_cells, []

    def overlapped(*args):
        if not run_already:
            run_already.append(True)
            OVERLAPS[second](store, b)
        return arrange(*args)

    monkeypatch.setattr(cell_sink, "region_cells", overlapped)
    store.bulk(a, 6, **{"key-columns": ["k"]})
    monkeypatch.undo()
    cells = CellStore(spark, store.name)
    assert cells.read().count() == 1600 and len(cells.loads()) == 2
    for first, end in (("b0100", "b0200"), ("a0100", "a0200"), ("a0399", "b0001"), ("b", None), (None, "a0001")):
        wanted = F.lit(True) if first is None else F.col("rowkey") >= first
        wanted &= F.lit(True) if end is None else F.col("rowkey") < end
        got = cells.read(first, end)
        assert got.count() == cells.read().where(wanted).count() > 0
    # a later load reuses what the store has, and is found as well
    store.bulk(spark.sql("select 'b0150x' as k, 1 as v"), 9, **{"key-columns": ["k"]})
    assert cells.read("b0100", "b0200").count() == 202
    if table:
        drop(spark, "tableflow_overlap_test")


@pytest.mark.parametrize("table", [False, True])
def test_loads_at_the_same_time(spark, tmp_path, table):
    name = "tableflow_threads_test" if table else f"{tmp_path}/cells"
    if table:
        drop(spark, name)

    def load(number):
        rows = spark.range(number * 100, number * 100 + 100).selectExpr("cast(id as string) as k", "id as v")
        target = {"tablename": name, "cf": "d", "key-columns": ["k"], "num-regions": 3, "bulk-stg": f"{tmp_path}/staging"}
        target |= {"bulkload": number % 2 == 0}
        cell_sink.write_cells(rows, spark, TargetSpec.from_dict({"place": "hbase", "options": target}))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(load, range(6)))
    cells = CellStore(spark, name)
    assert cells.read().count() == 1200 and len(cells.loads()) == 6
    assert cells.read("200", "210").count() == 22  # and 21
    if table:
        drop(spark, name)


def test_first_loads_of_two_formats_by_one_path(spark, store, monkeypatch):
    arrange, run_already = cell_sink.region_cells, []

    def overlapped(*args):
        if not run_already:
            run_already.append(True)
            store.write(numbers(spark, 10), format="orc")
        return arrange(*args)

    monkeypatch.setattr(cell_sink, "region_cells", overlapped)
    store.bulk(numbers(spark, 30), 3)
    assert store.rows("id", "b", "a") == sorted(as_text(10) + as_text(30), key=repr)


def test_a_load_changes_no_setting_of_the_session(spark, store):
    before = dict(spark.conf.getAll)
    store.bulk(numbers(spark, 20), 3)
    store.write(numbers(spark, 5))
    assert dict(spark.conf.getAll) == before


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_bucketed_stores_are_read_and_joined_without_a_shuffle(spark, tmp_path, keys):
    stores = [Store(spark, str(tmp_path), name=f"tableflow_buckets_{side}") for side in "ab"]
    rows = spark.range(200).selectExpr("cast(id as string) as k", "id % 3 as v")
    for store in stores:
        for load in (rows, rows.where("id < 20").selectExpr("k", "v + 10 as v")):
            options = {"bulkload": True, "bulk-stg": f"{tmp_path}/staging", "buckets": 4}
            store.write(load, **options, **({"key-columns": keys} if keys else {}))
    sides = [
        {"index": at, "id": side, "source": "hbase", "location": f"tableflow_buckets_{side}", "column.family": "d",
         "custom": {"mapping": {f"{side}_v": "v"}}, "join": "a" if side == "a" else "join b on a.rowkey = b.rowkey"}
        for at, side in enumerate("ab")
    ]
    joined = build(spark, PipelineSpec.from_dict({"source": {"mapping": sides, "select": ["a.rowkey", "a_v", "b_v"]}}))
    assert "Exchange" not in plan_of(stores[0].wide(["v"]), "simple")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Exchange" not in plan_of(joined, "simple")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    if keys:
        got = {row.rowkey: (row.a_v, row.b_v) for row in joined.collect()}
        assert got == {str(n): (str(n % 3 + 10 * (n < 20)),) * 2 for n in range(200)}
    else:
        assert stores[0].wide(["v"]).count() == 220
    files = glob.glob(f"{spark.conf.get('spark.sql.warehouse.dir').removeprefix('file:')}/tableflow_buckets_a/*/*/*.parquet")
    assert 0 < len(files) <= 8
    with pytest.raises(ValueError, match="bucketed"):
        stores[0].write(rows)
    with pytest.raises(ValueError, match="4 buckets"):
        stores[0].write(rows, **{"bulkload": True, "bulk-stg": f"{tmp_path}/staging", "buckets": 5})
    for side in "ab":
        drop(spark, f"tableflow_buckets_{side}")


def test_only_tables_are_bucketed(spark, store):
    with pytest.raises(ValueError, match="catalog table"):
        store.write(numbers(spark, 2), **{"bulkload": True, "bulk-stg": f"{store.folder}/staging", "buckets": 4})


def test_a_key_range_has_two_ends(spark, store):
    store.write(numbers(spark, 3))
    with pytest.raises(ValueError, match="not .'until'."):
        store.wide(["b"], custom={"mapping": {"b": "b"}, "rows": {"until": "x"}})


@pytest.mark.parametrize("keep,count", [("false", 2), (False, 2), ("true", 3), (True, 3)])
def test_keep_empty_rows_may_be_text(spark, store, keep, count):
    store.write(spark.sql("select explode(array(1, 2)) as a"))
    store.write(spark.sql("select 3 as b"))
    assert store.wide(["a"], custom={"mapping": {"a": "a"}, "keep_empty_rows": keep}).count() == count


def test_session_settings_are_put_back(spark, store):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    store.bulk(numbers(spark, 20), 3)
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("missing", ["num-regions", "bulk-stg"])
def test_bulk_options_are_required(spark, store, missing):
    options = {"bulkload": True, "num-regions": 2, "bulk-stg": f"{store.folder}/staging"}
    del options[missing]
    with pytest.raises(ValueError, match=missing):
        store.write(numbers(spark, 2), **options)


def test_key_columns_may_be_one_name_in_any_case(spark, store):
    store.bulk(spark.sql("select 'a' as Key, 1 as v"), 2, **{"key-columns": "kEY"})
    assert store.rows("rowkey", "v") == [("a", "1")] and store.splits() == ["a"]


def test_many_cells_raise_the_number_of_tasks(spark, store, monkeypatch):
    monkeypatch.setattr(cell_sink, "CELLS_PER_TASK", 50)
    store.bulk(numbers(spark, 400), 3)
    assert store.check_layout() == 1200 and len(list(store.files())) >= 20


def test_a_cell_source_needs_a_mapping(spark, store):
    store.write(numbers(spark, 2))
    with pytest.raises(ValueError, match="needs custom.mapping"):
        store.wide([])


def test_a_version_range_reads_its_loads_alone(spark, store):
    keyed = {"key-columns": ["id"]}
    store.bulk(numbers(spark, 30), 3, version=10, **keyed)
    store.write(spark.range(20, 40).selectExpr("id", "'p' as b"), version=20, **keyed)
    store.bulk(spark.range(35, 45).selectExpr("id", "'n' as b"), 3, version=30, **keyed)

    def keys(**versions):
        wide = store.wide(["b"], custom={"mapping": {"b": "b"}, "versions": versions})
        plan = plan_of(wide)
        assert any("PartitionFilters" in line and "load" in line for line in plan.splitlines())
        return {int(row.rowkey): row.b for row in wide.collect()}

    assert keys(after=10) == {n: "n" if n >= 35 else "p" for n in range(20, 45)}
    assert keys(after=10, to=20) == {n: "p" for n in range(20, 40)}
    assert set(keys(to=10)) == set(range(30))
    assert store.wide(["b"], custom={"mapping": {"b": "b"}, "versions": {"after": 99}}).collect() == []
    with pytest.raises(ValueError, match="not .'since'."):
        keys(since=3)


@pytest.mark.parametrize("marks", ["path", "table"])
def test_each_run_reads_what_came_after_the_last(spark, store, tmp_path, monkeypatch, marks):
    marks = f"{tmp_path}/marks" if marks == "path" else "tableflow_marks_test"
    spark.sql("drop table if exists tableflow_marks_test")
    keyed = {"key-columns": ["id"]}

    def source(job="copy"):
        custom = {"mapping": {"b": "b"}, "increment": {"job": job, "marks": marks}}
        return {"id": "w", "source": "hbase", "location": store.name, "column.family": "d", "custom": custom, "join": "w"}

    def step(number, job="copy"):
        options = {"location": f"{tmp_path}/out{number}", "format": "parquet", "compression": "snappy", "mode": "overwrite"}
        target = {"place": "hdfs", "options": options}
        run(spark, PipelineSpec.from_dict({"source": {"mapping": [source(job)]}, "target": target}))
        return sorted(int(row.rowkey) for row in spark.read.parquet(f"{tmp_path}/out{number}").collect())

    store.bulk(numbers(spark, 10), 2, **keyed)
    assert step(0) == list(range(10)) and step(1) == []
    # a load that has begun earlier, but ends later
    finish, late = CellStore.finish, []
    monkeypatch.setattr(CellStore, "finish", lambda self, *args: late.append((self, args)))
    store.write(spark.range(10, 13).selectExpr("id", "'p' as b"), **keyed)
    monkeypatch.setattr(CellStore, "finish", finish)
    store.write(spark.range(20, 23).selectExpr("id", "'p' as b"), **keyed)
    assert step(2) == [20, 21, 22]
    finish(late[0][0], *late[0][1])
    # a run that fails leaves no mark, and building alone leaves none either
    monkeypatch.setattr("tableflow.plans.flow.write_target", failing)
    with pytest.raises(OSError):
        step(3)
    monkeypatch.undo()
    assert build(spark, PipelineSpec.from_dict({"source": {"mapping": [source()]}})).count() == 3
    assert step(4) == [10, 11, 12] and step(5) == []
    assert step(6, "other job") == [*range(13), 20, 21, 22]
    with pytest.raises(ValueError, match="needs job"):
        step(7, "")
    spark.sql("drop table if exists tableflow_marks_test")
