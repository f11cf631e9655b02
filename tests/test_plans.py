"""Plan shape: the scale properties the design relies on, read from the physical plan."""

from conftest import SF01

from fleetpulse import cpu_mem_alerts, net_disk_alerts
from fleetpulse.plans.inspect import SUBQUERIES, main_tree, plan_text
from fleetpulse.session import shared_dir
from fleetpulse.sources.csv_tables import read_metric
from fleetpulse.sources.events import metric_tables, read_events


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_slot_plan_two_shuffles_no_cartesian(spark):
    t = metric_tables(read_events(spark, SF01))
    df = cpu_mem_alerts(t["cpu"], t["mem"])
    fmt = plan_text(df)
    main = fmt.split(SUBQUERIES)[0]
    tree = main_tree(df)
    assert tree.count("Exchange") == 2, tree
    assert "hashpartitioning(server_id" in main
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "PythonUDF", "ArrowEvalPython"):
        assert bad not in fmt
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in fmt
    # The offset subquery reads only the columns it needs.
    sub = fmt.split(SUBQUERIES)[1]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in sub


def test_join_plan_is_co_partitioned_sort_merge_full_outer(spark):
    t = metric_tables(read_events(spark, SF01))
    df = net_disk_alerts(t["net"], t["disk"], form="join")
    p = _plan(df)
    assert "SortMergeJoin" in p and "FullOuter" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    # one shuffle per metric aggregate, none for the join, one for the rank
    assert main_tree(df).count("Exchange") == 3


def test_unused_net_out_is_pruned_from_scan(spark):
    t = metric_tables(read_events(spark, SF01))
    base = shared_dir(spark, "prune")
    t["net"].write.parquet(f"{base}/net")
    t["disk"].write.parquet(f"{base}/disk")
    net, disk = spark.read.parquet(f"{base}/net"), spark.read.parquet(f"{base}/disk")
    p = _plan(net_disk_alerts(net, disk))
    assert "net_out" not in p.split("ReadSchema")[1].split("\n")[0]


def test_csv_scan_prunes_columns(spark):
    t = metric_tables(read_events(spark, SF01))
    base = shared_dir(spark, "prunecsv")
    t["net"].write.option("header", True).csv(f"{base}/net")
    t["disk"].write.option("header", True).csv(f"{base}/disk")
    net, disk = read_metric(spark, "net", f"{base}/net"), read_metric(spark, "disk", f"{base}/disk")
    p = _plan(net_disk_alerts(net, disk))
    schemas = [seg.split("\n")[0] for seg in p.split("ReadSchema")[1:]]
    assert schemas and all("net_out" not in s for s in schemas)


def test_single_scan_flagship_reads_events_once(spark):
    import __spark_entry__ as E

    df = E.queries()["cpu_mem_alerts"](spark, SF01)
    tree = main_tree(df)
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 2, tree
    fmt = plan_text(df)
    assert "In(event_type, [click,view])" in fmt
    sub = fmt.split(SUBQUERIES)[1]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in sub


def test_time_parsed_once_per_row(spark):
    import __spark_entry__ as E

    # landed text tables: one parse per scan branch (two scans)
    main = plan_text(E.queries()["cpu_mem_alerts_two_tables"](spark, SF01)).split(SUBQUERIES)[0]
    assert main.split("\n\n", 1)[1].count("gettimestamp(") == 2
    # the flagship reads real timestamps: no text round trip at all
    main = plan_text(E.queries()["cpu_mem_alerts"](spark, SF01)).split(SUBQUERIES)[0]
    details = main.split("\n\n", 1)[1]
    assert "gettimestamp(" not in details and "date_format(" in details.split("Window")[-1]
    assert details.count("make_timestamp(") == 1
