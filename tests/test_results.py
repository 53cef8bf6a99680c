"""Result folders of unlike models read back as one table."""

import uuid

from emolens.session import ensure_checkpoint_dir
from emolens.sources import io


def test_six_folders_one_table(spark):
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-results-{uuid.uuid4().hex}"
    families = {
        "logistic": ({"C": 1.0, "k": 1500}, 0.24, False), "svm": ({"C": 0.1, "k": 1500}, 0.25, True), "bayes": ({"alpha": 0.1, "fit_prior": False}, 0.23, False),
        "tree": ({"criterion": "entropy"}, 0.15, True), "forest": ({"trees": 300}, 0.17, True), "007": ({}, 0.19, False),
    }
    for name, (params, f1, gap) in families.items():
        rows = [("train_accuracy", 0.9), ("test_accuracy", 0.3 + f1), ("macro_f1", f1)] + ([("train_test_accuracy_gap", 0.123)] if gap else [])
        io.write_model_result(spark.createDataFrame(rows, "metric string, score double"), base, name, params)
    got = {r["model"]: r.asDict() for r in io.collect_model_results(spark, base).collect()}
    assert len(got) == 6 and [m for m, _ in sorted(got.items(), key=lambda x: x[1]["rank"])][:2] == ["svm", "logistic"]
    assert got["svm"]["accuracy_gap"] == 0.123 and abs(got["logistic"]["accuracy_gap"] - (0.9 - 0.54)) < 1e-9
    assert got["svm"]["param_C"] == 0.1 and got["bayes"]["param_C"] is None and got["bayes"]["param_fit_prior"] is False
    assert got["tree"]["param_criterion"] == "entropy" and got["forest"]["param_trees"] == 300 and got["svm"]["weighted_f1"] is None
