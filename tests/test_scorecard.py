import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelake.functions import lending, scorecard
from scorelake.operators import metrics, model, quality, split, woe


def test_target_flag_cases(spark):
    df = spark.createDataFrame(
        [("DECLINED", 0, 0, "Rejected"), ("APPROVED", 90, 0, "Bad"), ("APPROVED", 0, 1, "Bad"), ("APPROVED", 0, 0, "Good"), ("APPROVED", 30, 0, "Indeterminate"), ("APPROVED", None, None, "NotFunded")],
        "d string, a int, h int, want string",
    )
    got = df.select(lending.target_flag(F.col("d") == "DECLINED", F.col("a"), F.col("h")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_points_and_grades(spark):
    df = spark.createDataFrame([(1 / 51,), (1 / 101,), (0.0,), (1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(scorecard.points(F.col("p"))).collect()] == [600, 620, 666, 0, None]
    grades = spark.createDataFrame([(749,), (750,), (499,), (500,)], "s int").select(scorecard.grade(F.col("s")))
    assert [r[0] for r in grades.collect()] == ["A2", "A1", "D", "C2"]


def test_auc_equals_pair_count(spark):
    rnd = random.Random(3)
    for _ in range(3):
        data = [(rnd.randint(0, 1), rnd.choice([0.1, 0.2, 0.2, 0.5, rnd.random()]), rnd.choice("xy")) for _ in range(80)] + [(1, 0.4, "one")]
        got = {r.g: r for r in metrics.roc_metrics(spark.createDataFrame(data, "y int, s double, g string"), "y", "s", ["g"]).collect()}
        for g in "xy":
            pos, neg = [s for y, s, h in data if h == g and y], [s for y, s, h in data if h == g and not y]
            auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)
            ks = max(sum(p >= t for p in pos) / len(pos) - sum(q >= t for q in neg) / len(neg) for t in [*pos, *neg, 9])
            assert got[g].auc == pytest.approx(auc, abs=6e-5) and got[g].ks == pytest.approx(ks, abs=6e-5)
        assert got["one"].auc is None and got["one"].ks is None


def test_psi_of_itself_is_zero_and_alerts(spark):
    rows = [(g, float(i % 37)) for g in ("DEV", "OOT") for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert tuple(metrics.psi(df, "v", "g", "DEV").first()) == ("OOT", 0.0, "none")
    levels = spark.createDataFrame([(0.0999,), (0.10,), (0.25,)], "p double").select(metrics.alert(F.col("p")))
    assert [r[0] for r in levels.collect()] == ["none", "warning", "critical"]


def test_bands_and_selection(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1)], "x int, bad int")
    bands = woe.continuous_bands(df, ["x"], "bad")
    assert [r["count"] for r in bands.groupBy("band").count().orderBy("band").collect()] == [10] * 10
    levels = spark.createDataFrame([(0.0199,), (0.02,), (0.0999,), (0.10,)], "iv double").withColumn("feature", F.col("iv").cast("string"))
    assert [r.status for r in woe.select_features(levels).orderBy("feature").collect()] == ["EXCLUDED", "SELECTED_WEAK", "SELECTED_WEAK", "SELECTED"]
    assert [r.status for r in woe.missing_features(df.withColumn("n", F.lit(None)), ["x", "n", "z"]).collect()] == ["PRESENT", "ALL_NULL", "MISSING"]


def test_checks_and_class_balance(spark):
    for bad, n, passed in ((99, 10_000, False), (1, 100, True), (50, 100, True), (5001, 10_000, False)):
        df = spark.range(n).select(F.when(F.col("id") < bad, "Bad").otherwise("Good").alias("t"), F.lit(None).cast("double").alias("x"))
        rows = {r.check_name: r for r in quality.run_checks(df, not_null=("x",), ranges={"x": (0, 1)}, target=("t", "Bad", "Good")).collect()}
        assert rows["bad_share"].passed is passed
        assert rows["not_null"].passed is False and rows["range_min"].passed is True
    assert quality.overall(quality.run_checks(df, not_null=("x",))).first().result == "FAIL"


def test_split_is_stable_and_dates_can_be_missing(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else "2024-01-01", i % 3 > 0) for i in range(600)], "id int, d string, funded boolean")
    label = lambda d: {r.id: r._population for r in split.populations(d, "id", "d", F.col("funded"), F.lit("2024-06-01")).collect()}
    assert label(df) == label(df.repartition(7))
    assert {v for k, v in label(df).items() if k % 10 == 0 and k % 3} == {"NODATE"}
    chosen = split.exact_quota(df, "id", ["funded"], 0.7).groupBy("funded").agg(F.count_if("_chosen").alias("n")).collect()
    assert {r.funded: r.n for r in chosen} == {True: 280, False: 140}


def test_logit_is_at_its_optimum_and_wald_agrees(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.5 + x @ [1.0, -2.0])))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(t)) for (a, b), t in zip(x, y)], "a double, b double, y int")
    fitted = model.fit_logit(df, ["a", "b"], [], "y")
    z = np.column_stack([np.ones(400), (x - x.mean(0)) / x.std(0, ddof=1)])
    beta = np.array([fitted.stages[-1].intercept, *fitted.stages[-1].coefficients])
    p = 1 / (1 + np.exp(-z @ beta))
    gradient = z.T @ (p - y) + np.array([0, *beta[1:]])
    assert np.abs(gradient).max() < 1e-2
    errors = np.sqrt(np.diag(np.linalg.inv(z.T @ (z * (p * (1 - p))[:, None]))))
    table = model.wald_table(df, fitted, ["a", "b"]).collect()
    assert [r.std_err for r in table] == pytest.approx(list(errors), rel=1e-6)
    assert table[1].odds_ratio == pytest.approx(math.exp(table[1].coefficient))
    parcels = model.parcel_rejects(df.limit(3).withColumn("p", F.lit(0.25)), "p", "y")
    assert parcels.count() == 6 and parcels.agg(F.sum("weight")).first()[0] == pytest.approx(3)


def test_feature_table_has_all_populations_and_selected_features(spark, tmp_path):
    from scorelake.queries import QUERIES

    rnd = random.Random(7)
    # The amount tells bad from good, the other features are the same in both; P has other customers.
    customers = [(i, float(i % 5), "AB"[i % 2]) for i in range(20)]
    orders = [(i, i // 3 % 20, "FOP"[i % 3], 100.0 * (i % 3) + rnd.random(), f"{1995 + i // 3 % 2}-0{1 + i // 9 % 9}-05", "1-URGENT", i // 3) for i in range(9000)]
    spark.createDataFrame(customers, "c_custkey long, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    columns = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string, n long"
    spark.createDataFrame(orders, columns).withColumn("o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["feature_table_populations"](spark, str(tmp_path))
    assert got.columns == ["application_id", "_population", "bad", "o_totalprice"]
    rows = got.collect()
    assert {r._population for r in rows} == {"DEV", "HOL", "OOT", "TTD"}
    want = sorted((i, {"F": 1, "O": 0, "P": None}[s], amount) for i, _, s, amount, *_ in orders)
    assert sorted((r.application_id, r.bad, r.o_totalprice) for r in rows) == want
    assert all((r._population == "TTD") == (r.bad is None) for r in rows)


def test_quantiles_equal_a_full_sort_and_one_value_gets_a_band(spark):
    rng = np.random.default_rng(1)
    columns = {"a": rng.normal(size=900), "b": rng.integers(0, 7, 900).astype(float), "c": np.full(900, 3.0)}
    df = spark.createDataFrame([tuple(float(v[i]) for v in columns.values()) + (i % 2,) for i in range(900)], "a double, b double, c double, y int")
    long = woe.long_form(df, list(columns), "y", "double")
    shares = [0.0, 0.03, 0.5, 0.77, 1.0]
    for r in woe.quantiles(long, shares).collect():
        assert r.points == pytest.approx(np.quantile(columns[r.feature], shares).tolist())
    edges = {r.feature: r.edges for r in woe.quantile_edges(long).collect()}
    assert len(edges["c"]) == 3 and edges["c"][0] < 3.0 < edges["c"][2] and len(edges["a"]) == 11
    table = woe.label_bands(woe.evidence(woe.continuous_bands(df, ["b", "c"], "y"), "band"), woe.quantile_edges(long))
    got = {(r.feature, r.band): r.bin_label for r in table.collect()}
    assert got["c", 1] == "[2.997, 3.000]" and got["b", 1].startswith("[0.000") and sorted(b for f, b in got if f == "b") == list(range(1, sum(f == "b" for f, _ in got) + 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_newton_is_exact_whatever_the_partitions(spark, seed):
    """Coefficients to nine digits, with weights, against Newton steps in numpy; nearly separable data converge too."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.1]
    y = (x[:, 0] * 8 + x[:, 1] + rng.normal(size=300) * (0.01 if seed == 2 else 5) > 0).astype(int)
    w = rng.random(300) + 0.1
    df = spark.createDataFrame([(*map(float, a), int(t), float(v)) for a, t, v in zip(x, y, w)], "a double, b double, c double, y int, w double")
    z = np.column_stack([np.ones(300), (x - x.mean(0)) / x.std(0, ddof=1)])
    beta, ridge = np.zeros(4), np.array([0, 2, 2, 2])
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = beta + np.linalg.solve(z.T @ (z * (w * p * (1 - p))[:, None]) + np.diag(ridge), z.T @ (w * (y - p)) - ridge * beta)
    for parts in (1, 7):
        fitted = model.fit_logit(df.repartition(parts), ["a", "b", "c"], [], "y", "w", c=0.5)
        assert [fitted.stages[-1].intercept, *fitted.stages[-1].coefficients] == pytest.approx(list(beta), abs=1e-9)
        assert fitted.stages[-1].steps < 15
    assert [r.p_bad for r in model.probability(df, fitted).orderBy("a", "b").collect()] == pytest.approx([1 / (1 + math.exp(-m)) for m in (z @ beta)[np.lexsort((x[:, 1], x[:, 0]))]], abs=1e-9)
