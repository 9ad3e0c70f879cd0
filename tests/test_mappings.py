"""Customer tables and logs by mapping: CSV files, string keys, types from the data."""

from dataclasses import replace

from cadence.config import ORDERS_MAPPING, CustomerMapping
from cadence.operators.features import customer_mart
from cadence.plans.pipeline import RunConfig, attribute_spec, attributes, base_frame, prepare
from cadence.sources import customers, log_types, transactions


def _tables(spark, folder):
    who = spark.createDataFrame(
        [(f"C{i:02d}", float(i) if i % 5 else None, ["Low", "High"][i % 2], "x" if i % 3 else "y", i % 2 == 0, i / 40)
         for i in range(40)],
        "client string, balance double, level string, kind string, active boolean, external double")
    log = spark.createDataFrame(
        [(f"C{i % 30:02d}", f"19{95 + i % 4}-0{1 + i % 9}-1{i % 10}", "AB"[i % 2], float(i)) for i in range(300)],
        "client string, day string, kind string, paid double")
    for fmt in ("csv", "parquet"):
        for name, df in (("clients", who), ("payments", log.selectExpr("client", "to_date(day) day", "kind", "paid"))):
            df.write.format(fmt).option("header", True).save(f"{folder}/{name}.{fmt}")


CLIENTS = CustomerMapping("clients", "client", ordinal={"level": ("Low", "High")}, sanity="external")
PAYMENTS = replace(ORDERS_MAPPING, table="payments", customer_id="client", date="day", type="kind", amount="paid")


def test_csv_equals_parquet(spark, tmp_path):
    _tables(spark, tmp_path)
    found = []
    for fmt in ("csv", "parquet"):
        who, log = replace(CLIENTS, format=fmt), replace(PAYMENTS, format=fmt)
        types = log_types(spark, str(tmp_path), log)
        assert types == ("A", "B")
        mart = customer_mart(customers(spark, str(tmp_path), who), transactions(spark, str(tmp_path), log), log.windows, types)
        assert mart.schema["customer_id"].dataType.simpleString() == "string"
        found.append(sorted(map(tuple, mart.collect())))
    assert found[0] == found[1] and len(found[0]) == 40
    assert sum(r[0] >= "C30" for r in found[0]) == 10


def test_attributes_by_type(spark, tmp_path):
    _tables(spark, tmp_path)
    attrs = attributes(spark, str(tmp_path), CLIENTS)
    assert attrs.columns == ["customer_id", "balance", "level", "kind", "active"]
    spec = attribute_spec(attrs, CLIENTS)
    assert (spec.numeric, spec.ordinal, spec.nominal) == (("balance", "active"), {"level": ("Low", "High")}, ("kind",))


def test_a_mapped_snapshot_is_prepared(spark, tmp_path):
    _tables(spark, tmp_path)
    cfg = RunConfig(mapping=PAYMENTS, customers=CLIENTS)
    base = base_frame(spark, str(tmp_path), cfg)
    spec = attribute_spec(attributes(spark, str(tmp_path), CLIENTS), CLIENTS)
    frame, names, _ = prepare(base, "Cust-only", "future_disengaged", ("A", "B"), spec)
    assert frame.count() == 40
    assert {"balance", "active"} <= set(names) and len(names) == 4


def test_an_expression_maps_a_key(spark, tmp_path):
    _tables(spark, tmp_path)
    m = CustomerMapping("clients", "upper(concat('k-', client))", columns={"twice": "balance * 2"})
    row = customers(spark, str(tmp_path), m).where("customer_id = 'K-C07'").first()
    assert row.asDict() == {"customer_id": "K-C07", "twice": 14.0}
