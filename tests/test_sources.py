import pytest
from pyspark.sql import functions as F

from cardwarden.operators.validation import (
    column_contract,
    enforce,
    quarantine,
    request_rules,
    violations,
)
from cardwarden.plans.prepare import clean_sources, prepare_dataset
from cardwarden.schema import ROW_ID, SOURCE_INDEX, TRANSACTION_COLUMNS
from cardwarden.session import scratch_root, settle_table
from cardwarden.sources.csv_files import load_sources, read_request_csv, read_transactions_csv, write_csv
from cardwarden.sources.events import raw_transactions
from cardwarden.sources.report_files import read_report, write_report
from cardwarden.sources.split_files import read_splits, schema_differences

GOOD = "row_id % 911 <> 0 AND row_id % 499 <> 0 AND row_id % 997 <> 0 AND row_id % 983 <> 0 AND row_id % 701 <> 0 " \
    "AND row_id % 603 <> 0 AND row_id % 887 <> 0 AND row_id % 1201 <> 0 AND row_id % 809 <> 0 AND length(zip) >= 4"


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return raw_transactions(spark, sf_dir)


@pytest.fixture(scope="module")
def csv_paths(raw, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    paths = {}
    for name, rest in [("first", 0), ("second", 1)]:
        paths[name] = str(folder / name)
        part = raw.where(GOOD).where(F.col("row_id") % 2 == rest)
        write_csv(part.withColumnRenamed(ROW_ID, SOURCE_INDEX), paths[name])
    return paths


def test_typed_scan_keeps_text_and_types(spark, tmp_path):
    path = tmp_path / "one.csv"
    header = ",".join([SOURCE_INDEX, *TRANSACTION_COLUMNS[1:]])
    path.write_text(
        header + "\n0,2019-01-01 00:00:18,0012345,m,c,4.97,F,L,F,1 Main,City,NC,00501,36.1,-81.2,3495,Job,"
        "1988-03-09," + "0" * 32 + ",1325376018,36.0,-82.0,0\n"
    )
    df = read_transactions_csv(spark, str(path))
    row = df.first()
    assert df.columns == TRANSACTION_COLUMNS
    assert (row["cc_num"], row["zip"]) == ("0012345", "00501")
    assert dict(df.dtypes)["is_fraud"] == "tinyint"


def test_wrong_header_or_value_fails(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        read_transactions_csv(spark, str(bad)).collect()
    with pytest.raises(Exception):
        read_transactions_csv(spark, str(tmp_path / "none.csv")).collect()


def test_sources_are_stacked_and_sampled_per_source(spark, csv_paths):
    both = load_sources(spark, csv_paths)
    assert both.count() == sum(read_transactions_csv(spark, p).count() for p in csv_paths.values())
    head = load_sources(spark, csv_paths, sample_rows=5)
    counts = {r["source"]: r["count"] for r in head.groupBy("source").count().collect()}
    assert counts == {"first": 5, "second": 5}
    smallest = [r[0] for r in head.where("source = 'first'").orderBy("row_id").select("row_id").collect()]
    everything = read_transactions_csv(spark, csv_paths["first"]).orderBy("row_id").limit(5).collect()
    assert smallest == [r["row_id"] for r in everything]


def test_request_csv_trims_header_and_accepts_any_order(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text(" amt ,cc_num, category\n10.5,0123,food\n20.0,5678,travel\n")
    df = read_request_csv(spark, str(path))
    assert df.columns == ["amt", "cc_num", "category"]
    assert [tuple(r) for r in df.orderBy("amt").collect()] == [(10.5, "0123", "food"), (20.0, "5678", "travel")]


def test_json_report_roundtrip_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, None), ("b", None, "x")], "k string, v double, t string")
    write_report(df, str(tmp_path / "report"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert any('"t":null' in line for line in lines)
    back = read_report(spark, str(tmp_path / "report"), df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_prepare_writes_exact_splits(spark, csv_paths, tmp_path):
    out = str(tmp_path / "prepared")
    summary = {r["split"]: r for r in prepare_dataset(spark, csv_paths, out).collect()}
    n = sum(r["rows"] for r in summary.values())
    assert n == load_sources(spark, csv_paths).count()
    assert summary["train"]["original_features"] == 22
    assert summary["train"]["engineered_features"] == 44
    train, val, test = read_splits(spark, out)
    assert train.count() == summary["train"]["rows"]
    assert schema_differences(train, val) == schema_differences(train, test) == []


def test_clean_sources_writes_copies_and_summary(spark, csv_paths, tmp_path):
    out, report = str(tmp_path / "clean"), str(tmp_path / "report")
    rows = {r["dataset"]: r for r in clean_sources(spark, csv_paths, out, report).collect()}
    copy = spark.read.option("header", True).csv(f"{out}/first")
    assert copy.count() == rows["first"]["rows"]
    assert spark.read.text(report).count() == 2


def test_every_kind_of_bad_row_is_counted(raw):
    counts = {(r["rule"], r["column_name"]): r["violations"] for r in violations(raw).collect()}
    n = raw.count()

    def hits(m):
        return (n - 1) // m + 1

    assert counts[("pattern", "cc_num")] == hits(499)
    assert counts[("non_empty", "merchant")] == hits(997)
    assert counts[("non_empty", "category")] == hits(983)
    assert counts[("allowed_values", "gender")] == hits(603)
    assert counts[("pattern", "state")] == hits(887)
    assert counts[("calendar", "dob")] == hits(809)
    assert counts[("range", "lat")] >= 0
    assert counts[("non_empty", "first")] == 0


def test_patterns_match_the_whole_text(spark, raw):
    row = raw.where(GOOD).limit(1)
    for column, value in [("state", "NC\n"), ("zip", "123456"), ("dob", "2019-1-01"), ("trans_num", "G" * 32)]:
        broken = row.withColumn(column, F.lit(value))
        found = {r["column_name"] for r in violations(broken).where("violations > 0").collect()}
        assert column in found
    nan = row.withColumn("amt", F.lit(float("nan")))
    assert violations(nan).where("violations > 0").first()["column_name"] == "amt"


def test_enforce_and_contract(raw):
    good = raw.where(GOOD)
    assert enforce(good) is good
    with pytest.raises(ValueError, match="breaks rule"):
        enforce(raw)
    with pytest.raises(ValueError, match="columns differ"):
        enforce(good.drop("zip"))
    assert column_contract(good).where("NOT ok").count() == 0
    assert column_contract(good.drop("zip")).where("NOT ok").count() > 0


def test_quarantine_is_a_partition(raw):
    good, bad = quarantine(raw, request_rules())
    assert good.count() + bad.count() == raw.count()
    reasons = {x for r in bad.select("reasons").collect() for x in r["reasons"]}
    assert "pattern:gender" in reasons and "required:merchant" in reasons


def test_scratch_folder_follows_the_session(spark, tmp_path):
    old = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (old or spark.sparkContext.getCheckpointDir())
    stored = settle_table(spark.range(10).withColumn("split", F.lit("train")), "t", ["split"])
    assert stored.columns == ["id", "split"] and stored.count() == 10


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        @staticmethod
        def get(name, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session)


def test_request_files_with_columns_in_another_order(spark, tmp_path):
    from cardwarden.sources.csv_files import read_request_csv

    (tmp_path / "a.csv").write_text("lat, long \n1.5,2.5\n")
    (tmp_path / "b.csv").write_text("long,lat\n20.5,10.5\n")
    got = {(r["lat"], r["long"]) for r in read_request_csv(spark, str(tmp_path)).collect()}
    assert got == {(1.5, 2.5), (10.5, 20.5)}
