import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.classifier import classifier_scores, fit_classifier, hash_split
from ledgerlens.operators.encoding import add_dummy_vectors, add_indices, category_tables, sparse_dummies, sparse_onehot
from ledgerlens.operators.iforest import average_path_length, fit_isolation_forest, isolation_scores, score_isolation_forest


def cats(spark):
    rows = [("h1", "b", "x", "night"), ("h2", "a", "x", "night"), ("h3", "b", "y", "morning"), ("h4", "c", None, "night"), ("h5", None, "y", "midnight")]
    return spark.createDataFrame(rows, "hash string, methodId string, functionName string, time_slot string")


def test_string_index_frequency_then_alphabetical(spark):
    df = cats(spark)
    out = add_indices(df)
    idx = {r["hash"]: (r["methodId_index"], r["functionName_index"]) for r in out.collect()}
    # methodId: b (2) -> 0, then a, c tie -> alphabetical; NULL -> last index 3
    assert idx["h1"][0] == 0.0 and idx["h2"][0] == 1.0 and idx["h4"][0] == 2.0 and idx["h5"][0] == 3.0
    assert idx["h4"][1] == 2.0  # NULL functionName -> number of labels


def test_onehot_null_is_the_zero_vector(spark):
    out = add_indices(cats(spark))
    rows = {r["hash"]: r for r in out.select("hash", *sparse_onehot("methodId")).collect()}
    assert rows["h1"]["methodId_onehot_at"] == 0 and rows["h1"]["methodId_onehot_size"] == 3
    assert rows["h5"]["methodId_onehot_at"] is None


def test_unseen_values_get_the_last_index(spark):
    df = cats(spark)
    tables = category_tables(df.filter("hash <> 'h2'"), ["methodId"])
    seen = add_indices(df, ["methodId"], tables)
    got = {r["hash"]: r["methodId_index"] for r in seen.collect()}
    # an unseen value has no dummy, NULL has the last one
    dummies = {r["hash"]: list(r["indices"]) for r in seen.select("hash", *sparse_dummies(["methodId"])).collect()}
    assert dummies == {"h1": [0], "h2": [], "h3": [0], "h4": [1], "h5": [2]}
    vectors = {r["hash"]: np.flatnonzero(r["features"].toArray()).tolist() for r in add_dummy_vectors(seen, ["methodId"]).collect()}
    assert vectors == dummies
    assert got == {"h1": 0.0, "h2": 2.0, "h3": 0.0, "h4": 1.0, "h5": 2.0}


def test_many_categories(spark):
    # every third row has one value, the others a value of their own
    df = spark.range(150_000).select(
        F.col("id").alias("hash"), F.when(F.col("id") % 3 == 0, "transfer").otherwise(F.concat(F.lit("f"), F.lpad(F.col("id").cast("string"), 7, "0"))).alias("functionName")
    )
    out = add_indices(df, ["functionName"]).select("hash", "functionName", *sparse_onehot("functionName"))
    r = out.agg(F.min("functionName_onehot_size"), F.countDistinct("functionName_onehot_at"), F.max("functionName_onehot_at"), F.count("*")).first()
    assert tuple(r) == (100_001, 100_001, 100_000, 150_000)
    assert {x[0] for x in out.filter("functionName = 'transfer'").select("functionName_onehot_at").distinct().collect()} == {0}
    assert out.filter("hash = 1").first()["functionName_onehot_at"] == 1  # ties in alphabetical order


def test_sparse_dummies_tell_null_from_the_text_nan(spark):
    rows = [("h1", "b", "x"), ("h2", "nan", "x"), ("h3", None, "x"), ("h4", "b", None)]
    df = spark.createDataFrame(rows, "hash string, methodId string, functionName string")
    cols = ["methodId", "functionName"]
    got = {r["hash"]: (r["size"], list(r["indices"]), list(r["values"])) for r in add_indices(df, cols).select("hash", *sparse_dummies(cols)).collect()}
    # methodId: b, nan, NULL; functionName: x, NULL
    assert got == {"h1": (5, [0, 3], [1.0, 1.0]), "h2": (5, [1, 3], [1.0, 1.0]), "h3": (5, [2, 3], [1.0, 1.0]), "h4": (5, [0, 4], [1.0, 1.0])}


def test_dummy_vectors_are_what_the_columns_say(spark):
    indexed = add_indices(cats(spark)).withColumn("amount", F.length("hash").cast("double"))
    both = add_dummy_vectors(indexed, more=["amount"]).select("features", "amount", *sparse_dummies())
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    for r in both.collect():
        dense = [r["amount"]] + [0.0] * r["size"]
        for i, v in zip(r["indices"], r["values"], strict=True):
            dense[1 + i] = v
        assert r["features"].toArray().tolist() == dense


def test_dummy_vectors_of_100_000_names(spark):
    df = spark.range(100_000).select(F.col("id").alias("hash"), F.concat(F.lit("f"), F.col("id")).alias("functionName"), (F.col("id") % 2).cast("double").alias("label"))
    indexed = add_indices(df, ["functionName"])
    r = indexed.select(*sparse_dummies(["functionName"])).agg(F.min("size"), F.countDistinct(F.col("indices")[0]), F.max(F.size("indices"))).first()
    assert tuple(r) == (100_001, 100_000, 1)
    from pyspark.ml.classification import LogisticRegression

    vectors = add_dummy_vectors(indexed, ["functionName"])
    assert vectors.first()["features"].size == 100_001
    model = LogisticRegression(maxIter=2).fit(vectors.limit(2000))
    assert model.numFeatures == 100_001


def test_average_path_length():
    assert list(average_path_length(np.array([0.0, 1.0, 2.0]))) == [0.0, 0.0, 1.0]
    assert average_path_length(np.array([256.0]))[0] == pytest.approx(10.244770920116851)


def test_isolation_forest_planted_outliers(spark):
    rng = np.random.default_rng(0)
    n = 3000
    x = rng.normal(size=(n, 3))
    x[:5] += 12.0  # planted outliers
    rows = [(f"h{i:05d}", *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "hash string, a double, b double, c double")
    model = fit_isolation_forest(df, ["a", "b", "c"], n_trees=50, max_samples=256, seed=42)
    scored = score_isolation_forest(df, model, contamination=0.01)
    top = [r["hash"] for r in scored.orderBy("anomaly_score").limit(5).collect()]
    assert sorted(top) == [f"h{i:05d}" for i in range(5)]
    flagged = scored.filter(F.col("pred_label") == -1).count()
    assert abs(flagged - 30) <= 1
    again = score_isolation_forest(df, fit_isolation_forest(df, ["a", "b", "c"], n_trees=50, seed=42), 0.01)
    a = {r["hash"]: r["anomaly_score"] for r in scored.collect()}
    b = {r["hash"]: r["anomaly_score"] for r in again.collect()}
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)  # deterministic for a seed


def test_forest_samples_have_fixed_size(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("hash"), F.rand(1).alias("a"))
    model = fit_isolation_forest(df, ["a"], n_trees=20, max_samples=64)
    assert model.psi == 64 and list(model.size[:, 0]) == [64.0] * 20


def test_forest_over_categories_walks_its_nodes(spark):
    # one rare category, NULLs, and ten thousand names of which none is merged
    df = spark.range(20_000).select(
        F.col("id").cast("string").alias("hash"),
        (F.col("id") % 7).cast("double").alias("a"),
        F.when(F.col("id") == 5, "rare").when(F.col("id") % 11 == 0, F.lit(None)).otherwise("m").alias("methodId"),
        F.concat(F.lit("f"), F.col("id") % 10_000).alias("functionName"),
    )
    model = fit_isolation_forest(df, ["a"], n_trees=10, max_samples=128, categories=["methodId", "functionName"])
    names = {n[2] for n in model.nodes if n[2]}
    assert "c:methodId" in names and "c:methodId=m" in names and sum(x.startswith("c:functionName=") for x in names) > 50
    nodes = {(t, i): (f, cut, size) for t, i, f, cut, size in model.nodes}
    rows = {r["hash"]: r for r in df.filter("hash < 40").collect()}
    got = {r["hash"]: r["iforest_raw"] for r in isolation_scores(df.filter("hash < 40"), model).collect()}
    for h, r in rows.items():
        path = 0.0
        for t in range(10):
            i, depth = 0, 0
            while nodes[t, i][0] is not None:
                f, cut, _ = nodes[t, i]
                kind, _, rest = f.partition(":")
                column, _, value = rest.partition("=")
                x = r[column] if kind == "n" else float(r[column] == (value if "=" in rest else None))
                i, depth = 2 * i + 1 + (x >= cut), depth + 1
            path += depth + float(average_path_length(np.array([float(nodes[t, i][2])]))[0])
        want = -(2 ** (-path / 10 / float(average_path_length(np.array([128.0]))[0])))
        assert got[h] == pytest.approx(want, abs=2e-9)
    assert sum(f is not None for f, _, _ in nodes.values()) * 2 + 10 == len(nodes)


def test_classifier(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        lab = int(i % 10 == 0)
        rows.append((f"h{i}", float(rng.normal() + 4 * lab), float(rng.normal()), float(lab)))
    df = spark.createDataFrame(rows, "hash string, f1 double, f2 double, label double").withColumn("is_train", hash_split(F.col("hash")))
    model = fit_classifier(df.filter("is_train"), ["f1", "f2"], num_trees=10, max_depth=3)
    out = classifier_scores(df, model, ["f1", "f2"])
    acc = out.filter(~F.col("is_train")).select(F.avg((F.col("risk_pred") == F.col("label").cast("int")).cast("double"))).first()[0]
    assert acc > 0.9
    share = df.filter("is_train").count() / 600
    assert 0.7 < share < 0.9


def test_model_persistence(spark, tmp_dir):
    import os

    from pyspark.ml import PipelineModel

    from ledgerlens.operators.iforest import IsolationForestModel

    rng = np.random.default_rng(5)
    rows = [(f"h{i}", float(v), float(w)) for i, (v, w) in enumerate(rng.normal(size=(500, 2)))]
    df = spark.createDataFrame(rows, "hash string, a double, b double")
    model = fit_isolation_forest(df, ["a", "b"], n_trees=10, max_samples=64)
    first = {r["hash"]: r["anomaly_score"] for r in score_isolation_forest(df, model, 0.05).collect()}
    model.save(spark, os.path.join(tmp_dir, "forest"))
    again = IsolationForestModel.load(spark, os.path.join(tmp_dir, "forest"))
    second = {r["hash"]: r["anomaly_score"] for r in score_isolation_forest(df, again, contamination=None).collect()}
    assert all(abs(first[k] - second[k]) < 1e-12 for k in first)

    lab = df.withColumn("label", (F.col("a") > 1).cast("double"))
    clf = fit_classifier(lab, ["a", "b"], num_trees=5, max_depth=3)
    clf.write().overwrite().save(os.path.join(tmp_dir, "clf"))
    back = PipelineModel.load(os.path.join(tmp_dir, "clf"))
    p1 = [r["risk_prob"] for r in classifier_scores(lab, clf, ["a", "b"]).orderBy("hash").collect()]
    p2 = [r["risk_prob"] for r in classifier_scores(lab, back, ["a", "b"]).orderBy("hash").collect()]
    assert p1 == p2
