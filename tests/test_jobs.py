"""Jobs that read once and write complete runs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.operators.models import fit_logistic, logistic_gradient
from cardwarden.operators.summaries import histogram, histogram_quantile
from cardwarden.operators.validation import quarantine
from cardwarden.plans import prepare
from cardwarden.plans.prepare import clean_sources, prepare_dataset
from cardwarden.plans.score import score_job
from cardwarden.schema import GROUP_STATS, ROW_ID, SOURCE_INDEX
from cardwarden.session import ship_package
from cardwarden.sources import csv_files
from cardwarden.sources.csv_files import read_transactions_csv, write_csv
from cardwarden.sources.events import raw_transactions
from cardwarden.sources.run_documents import complete_runs, read_part, write_run


@pytest.fixture(scope="module")
def sources(spark, sf_dir, tmp_path_factory):
    ship_package(spark)
    folder = tmp_path_factory.mktemp("csv")
    raw = raw_transactions(spark, sf_dir)
    good = quarantine(raw)[0].withColumnRenamed(ROW_ID, SOURCE_INDEX)
    paths = {n: str(folder / n) for n in ("first", "second", "broken")}
    write_csv(good.where(f"`{SOURCE_INDEX}` % 2 = 0"), paths["first"])
    write_csv(good.where(f"`{SOURCE_INDEX}` % 2 = 1"), paths["second"])
    write_csv(raw.withColumnRenamed(ROW_ID, SOURCE_INDEX), paths["broken"])
    return paths


@pytest.fixture
def parsed(spark, monkeypatch):
    """Rows that come out of the CSV parser, however often it runs."""
    rows = spark.sparkContext.accumulator(0)

    def counted(session, path):
        df = read_transactions_csv(session, path)

        def count(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    for module in (csv_files, prepare):
        monkeypatch.setattr(module, "read_transactions_csv", counted)
    return rows


def test_prepare_parses_each_file_once(spark, sources, parsed, tmp_path):
    paths, out = {n: sources[n] for n in ("first", "second")}, str(tmp_path / "out")
    summary = {r["split"]: r for r in prepare_dataset(spark, paths, out).collect()}
    written = spark.read.parquet(out)
    assert parsed.value == written.count() == sum(r["rows"] for r in summary.values())
    for r in written.groupBy("split").agg(F.count("*").alias("n"), F.sum("is_fraud").alias("f"), F.avg("is_fraud").alias("rate")).collect():
        assert (summary[r["split"]]["rows"], summary[r["split"]]["fraud_rows"]) == (r["n"], r["f"])
        assert summary[r["split"]]["fraud_rate"] == pytest.approx(r["rate"])


def test_clean_parses_once_and_a_breach_leaves_no_output(spark, sources, parsed, tmp_path):
    rows = clean_sources(spark, {"first": sources["first"]}, str(tmp_path / "c"), str(tmp_path / "r")).collect()
    assert parsed.value == rows[0]["rows"]
    with pytest.raises(ValueError, match="breaks rule"):
        prepare_dataset(spark, {"broken": sources["broken"]}, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_only_complete_runs_can_be_read(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert complete_runs(spark, path).count() == 0
    one = spark.createDataFrame([("a", 1.5, None), ("b", None, {"x": 1.0})], "k string, v double, m map<string,double>")
    assert write_run(spark, path, "r1", {"report": one}, {"rows": one.limit(1)}) == {"report": 2, "rows": 1}
    assert sorted(map(str, read_part(spark, path, "r1", "report").collect())) == sorted(map(str, one.collect()))
    one.write.parquet(f"{path}/r2/rows")  # a run that broke off before its manifest
    assert {r["run_id"] for r in complete_runs(spark, path).collect()} == {"r1"}
    with pytest.raises(ValueError, match="no complete part"):
        read_part(spark, path, "r2", "rows")
    one.write.mode("overwrite").parquet(f"{path}/r1/rows")
    with pytest.raises(ValueError, match="manifest says 1"):
        read_part(spark, path, "r1", "rows")


def test_scoring_job_rejects_what_the_rules_reject(spark, sf_dir, tmp_path):
    raw = raw_transactions(spark, sf_dir)
    train = raw.select("amt", "lat", F.col("is_fraud").cast("int").alias("is_fraud"))
    model = fit_logistic(train, ["amt", "lat"], {"max_iter": 5})
    requests, medians = raw.drop("trans_date_trans_time", "is_fraud"), dict.fromkeys(GROUP_STATS, 1.0)
    totals = score_job(requests, model, medians, str(tmp_path), "all", keep=["row_id"]).first()
    assert totals["requests"] == raw.count() == totals["scored"] + totals["rejected"] and totals["rejected"] > 0
    scored, rejected = (read_part(spark, str(tmp_path), "all", p) for p in ("scored", "rejected"))
    assert scored.where("is_fraud").count() == totals["flagged"]
    assert rejected.where("size(reasons) = 0").count() == 0
    # Requests that lack a field are all set aside, with that reason; the job goes on.
    totals = score_job(requests.drop("merchant"), model, medians, str(tmp_path), "lacking", keep=["row_id"]).first()
    assert (totals["scored"], totals["rejected"], totals["flagged_rate"]) == (0, raw.count(), 0.0)
    reasons = read_part(spark, str(tmp_path), "lacking", "rejected").where("array_contains(reasons, 'required:merchant')")
    assert reasons.count() == raw.count()


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_histogram_percentile(spark, q):
    rng = np.random.default_rng(2)
    groups = {"a": rng.exponential(0.3, 500), "b": np.full(3, 0.01), "c": np.array([99.0]), "d": np.array([0.2, 99.0])}
    rows = [(g, float(x)) for g, values in groups.items() for x in values] + [("a", None), ("e", math.nan)]
    bounds = [0.1, 0.25, 0.5, 1.0, 2.5]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r for r in histogram_quantile(histogram(df, "x", bounds, ["g"]), bounds, q, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        upto = [int((values <= b).sum()) for b in bounds]
        rank, want = q * len(values), bounds[-1]
        for i, n in enumerate(upto):
            if n >= rank:
                low, before = (bounds[i - 1], upto[i - 1]) if i else (0.0, 0)
                want = low + (bounds[i] - low) * ((rank - before) / (n - before) if n > before else 0.0)
                break
        assert got[g]["value"] == pytest.approx(want) and got[g]["observations"] == len(values)


def test_gradient_is_zero_only_at_the_minimum(spark):
    df = spark.range(800).select(F.randn(1).alias("a"), (F.randn(2) * 100 + 5).alias("b"), F.rand(3).alias("u"))
    df = df.withColumn("is_fraud", (F.col("u") < 1 / (1 + F.exp(1.5 - F.col("a")))).cast("int")).drop("u").cache()

    def largest(iterations):
        model = fit_logistic(df, ["a", "b"], {"max_iter": iterations})
        return max(abs(r["gradient"]) for r in logistic_gradient(df, ["a", "b"], model).collect())

    assert largest(1000) < 1e-4 < largest(0)
