"""JDBC on in-process Derby; catalog attach / detach keeps files."""

import datetime as dt
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT
from monthwise.plans import catalog
from monthwise.plans.load import partition_path, publish_months
from monthwise.session import local_path
from monthwise.sources import jdbc

C = TRIP_CONTRACT.with_timestamp_ntz()


def test_jdbc_replace_and_append(spark):
    db = jdbc.derby_memory(f"t{uuid.uuid4().hex[:6]}")
    df = spark.createDataFrame([(3, dt.date(2020, 1, 1)), (4, dt.date(2020, 2, 1))], "cnt long, date date")
    jdbc.replace_table(df, db, "cnt_tbl")
    jdbc.replace_table(df, db, "cnt_tbl", truncate=True)
    assert jdbc.read_table(spark, db, "cnt_tbl").count() == 2
    jdbc.append_table(df, db, "cnt_tbl")
    back = jdbc.read_table(spark, db, "cnt_tbl", partition_column="cnt", lower=0, upper=10, num_partitions=3)
    assert back.count() == 4


def test_jdbc_swap_leaves_old_rows_on_failure(spark):
    db = jdbc.derby_memory(f"t{uuid.uuid4().hex[:6]}")
    jan, feb = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    df = spark.createDataFrame([(3, jan), (4, feb), (5, feb)], "cnt long, date date")

    def rows():
        return sorted((r.cnt, r.date) for r in jdbc.read_table(spark, db, "trips").collect())

    jdbc.swap_table(df, db, "trips")
    assert rows() == [(3, jan), (4, feb), (5, feb)]
    jdbc.swap_table(spark.createDataFrame([(7, feb)], df.schema), db, "trips", key="date")
    assert rows() == [(3, jan), (7, feb)]
    broken = df.withColumn("cnt", F.when(F.col("cnt") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("cnt")))
    for key in (None, "date"):
        with pytest.raises(Exception, match="broken"):
            jdbc.swap_table(broken, db, "trips", key=key, num_partitions=2)
        assert rows() == [(3, jan), (7, feb)]
    # a row that the table refuses fails the transaction, and nothing is left beside it
    with jdbc._transaction(spark, db) as (connection, quote):
        jdbc._execute(connection, f"ALTER TABLE trips ADD CONSTRAINT small CHECK ({quote}cnt{quote} < 100)")
    with pytest.raises(Exception, match="SMALL"):
        jdbc.swap_table(spark.createDataFrame([(1, jan), (200, jan)], df.schema), db, "trips")
    assert rows() == [(3, jan), (7, feb)]
    with jdbc._transaction(spark, db) as (connection, _):
        found = connection.getMetaData().getTables(None, None, "%NEW%", None)
        assert not found.next()
    jdbc.swap_table(df.limit(0), db, "trips")
    assert rows() == []


def test_catalog_attach_detach_keeps_files(spark, scratch):
    root = scratch("cat")
    name = f"c{uuid.uuid4().hex[:6]}"
    target, ledger = catalog.init_tables(spark, root, db=name, stage_db=f"{name}_s", contract=C)
    assert catalog.database_exists(spark, name) and catalog.table_exists(spark, target)
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 2, 1))], "vendor_id long, date date")
    from monthwise.functions.conform import conform

    staged = f"{root}/staged"
    publish_months(conform(df.withColumnRenamed("vendor_id", "VendorID"), C), staged)
    months = {m: partition_path(staged, m) for m in (dt.date(2020, 1, 1), dt.date(2020, 2, 1))}
    catalog.attach_months(spark, target, months)
    assert spark.table(target).count() == 2
    assert sorted(r.date for r in catalog.attached_months(spark, target).collect()) == sorted(months)
    catalog.detach_months(spark, target, [dt.date(2020, 1, 1)])
    assert spark.table(target).count() == 1
    assert os.path.isdir(local_path(months[dt.date(2020, 1, 1)]))  # external: files stay
    catalog.attach_months(spark, target, {dt.date(2020, 1, 1): months[dt.date(2020, 1, 1)]})
    assert spark.table(target).count() == 2


def test_create_like_copies_columns(spark, scratch):
    root = scratch("like")
    name = f"l{uuid.uuid4().hex[:6]}"
    target, _ = catalog.init_tables(spark, root, db=name, stage_db=f"{name}_s", contract=C)
    stage = f"{name}_s.yellow_tripdata_2020_01"
    catalog.create_like(spark, stage, target, f"{root}/stage")
    assert [(f.name, f.dataType) for f in spark.table(stage).schema] == [(f.name, f.dataType) for f in spark.table(target).schema]
    assert spark.table(stage).count() == 0


def test_path_detach_and_attach(spark, scratch):
    from monthwise.functions.conform import conform
    from monthwise.plans.load import attach_month, detach_month, read_target

    root = scratch("pd")
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 2, 1))], "VendorID long, date date")
    publish_months(conform(df, C), f"{root}/t")
    assert detach_month(spark, f"{root}/t", dt.date(2020, 1, 1), f"{root}/detached")
    assert [r.vendor_id for r in read_target(spark, f"{root}/t", C).collect()] == [2]
    assert attach_month(spark, f"{root}/detached", dt.date(2020, 1, 1), f"{root}/t")
    assert sorted(r.vendor_id for r in read_target(spark, f"{root}/t", C).collect()) == [1, 2]
    assert not detach_month(spark, f"{root}/t", dt.date(2019, 1, 1), f"{root}/detached")


def test_load_months_to_table_swaps_months(spark, scratch):
    from monthwise.functions.conform import conform
    from monthwise.plans.views import orders_trips_raw

    from .conftest import SF_SMALL

    C = TRIP_CONTRACT.with_timestamp_ntz()
    M = dt.date(1998, 7, 1)
    root = scratch("table")
    db = f"t_{uuid.uuid4().hex[:8]}"
    t, ledger = catalog.init_tables(spark, root, db=db, stage_db=f"{db}_s", contract=C)
    trips = conform(orders_trips_raw(spark, SF_SMALL), C)

    def counts():
        return {r.date: r.cnt for r in catalog.month_counts_sql(spark, t).collect()}

    want = {r.date: r.cnt for r in trips.groupBy("date").agg(F.count(F.lit(1)).alias("cnt")).collect()}
    catalog.load_months_to_table(spark, trips, t, ledger, contract=C, rebalance=True)
    assert counts() == want
    old = local_path(catalog.partition_location(spark, t, M))
    assert os.path.isdir(old)

    # reload one month with fewer rows: swapped in, others kept; the old folder
    # stays for running scans and goes with a later vacuum
    other = dt.date(1998, 6, 1)
    other_loc = catalog.partition_location(spark, t, other)
    part = trips.where((F.col("date") == F.lit(M)) & (F.col("store_and_fwd_flag") == "F"))
    catalog.load_months_to_table(spark, part, t, ledger, months=[M], contract=C)
    n = part.count()
    assert 0 < n < want[M] and counts() == {**want, M: n}
    assert os.path.isdir(old) and catalog.partition_location(spark, t, other) == other_loc
    assert catalog.vacuum_runs(spark, t) == [] and os.path.isdir(old)
    time.sleep(1.1)
    assert catalog.vacuum_runs(spark, t, keep=dt.timedelta(0)) and not os.path.exists(old)
    assert counts() == {**want, M: n}

    # empty reload: the month leaves the table, the ledger says 0
    catalog.load_months_to_table(spark, part.where(F.lit(False)), t, ledger, months=[M], contract=C)
    assert M not in counts() and len(counts()) == len(want) - 1
    catalog.ledger_view(spark, ledger, f"{db}_lv")
    assert spark.table(f"{db}_lv").where(F.col("date") == F.lit(M)).first().cnt == 0
    # the reference's ad-hoc query on the count table: one row per month
    counts_view = spark.sql(f"SELECT * FROM {db}.ny_yellow_cnt").collect()
    assert len(counts_view) == len(want) and {r.date: r.cnt for r in counts_view} == {**want, M: 0}

    # a month attached from outside the table is replaced but not deleted
    outside = f"{scratch('outside')}/date={M.isoformat()}"
    publish_months(part, outside.rsplit("/", 1)[0])
    catalog.attach_months(spark, t, {M: outside})
    catalog.load_months_to_table(spark, part, t, ledger, months=[M], contract=C)
    assert os.path.isdir(local_path(outside)) and counts()[M] == n

    # run folders no partition points into are vacuumed; the rest stay
    runs = os.path.join(local_path(catalog.table_location(spark, t)), "_runs")
    os.makedirs(os.path.join(runs, "20200101T000000-crashed", f"date={M.isoformat()}"))
    assert "20200101T000000-crashed" in catalog.vacuum_runs(spark, t)
    assert counts()[M] == n and counts() == {**want, M: n}
    assert all(os.listdir(os.path.join(runs, r)) for r in os.listdir(runs))


def test_table_load_gates_what_it_wrote(spark, scratch):
    import pytest

    from monthwise.functions.conform import conform
    from monthwise.operators.checks import GateError
    from monthwise.plans.views import orders_trips_raw

    from .conftest import SF_SMALL

    C = TRIP_CONTRACT.with_timestamp_ntz()
    M = dt.date(1998, 7, 1)
    root = scratch("table-gates")
    db = f"g_{uuid.uuid4().hex[:8]}"
    t, ledger = catalog.init_tables(spark, root, db=db, stage_db=f"{db}_s", contract=C)
    trips = conform(orders_trips_raw(spark, SF_SMALL), C)
    catalog.load_months_to_table(spark, trips.where(F.col("date") == F.lit(M)), t, ledger, contract=C)
    before = catalog.month_counts_sql(spark, t).collect()
    runs = os.path.join(local_path(catalog.table_location(spark, t)), "_runs")
    n_runs = len(os.listdir(runs))

    # rows of months that were not requested: nothing swapped, run folder gone
    with pytest.raises(GateError):
        catalog.load_months_to_table(spark, trips, t, ledger, months=[M], contract=C)
    assert catalog.month_counts_sql(spark, t).collect() == before
    assert len(os.listdir(runs)) == n_runs

    # row limit: at most 10 rows per month published, the ledger has the full count
    catalog.load_months_to_table(spark, trips, t, ledger, contract=C, row_limit=10, rebalance=True)
    full = {r.date: r.cnt for r in trips.groupBy("date").agg(F.count(F.lit(1)).alias("cnt")).collect()}
    got = {r.date: r.cnt for r in catalog.month_counts_sql(spark, t).collect()}
    assert got == {m: min(c, 10) for m, c in full.items()}
    catalog.ledger_view(spark, ledger, f"{db}_lv")
    assert {r.date: r.cnt for r in spark.table(f"{db}_lv").collect()} == full
