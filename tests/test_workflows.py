"""End-to-end flows run on the fixture layers and agree with the registered queries."""

from pyspark.sql import functions as F

from conftest import SF001
from parcelkit.plans import catalog, inputs, workflows


def test_e1_matches_registered(spark):
    nb, tr = inputs.neighborhoods(spark, SF001), inputs.tracts(spark, SF001)
    out = workflows.tract_to_neighborhood(nb, tr, tr)
    got = {r["name"]: round(r["avg_income"], 6) for r in out["income"].collect()}
    want = {r["name"]: r["avg_income"] for r in catalog.QUERIES["income_from_matches"](spark, SF001).collect()}
    assert got == want
    assert out["combined_layer"].count() == nb.attrs.count()


def test_e2_e3_run(spark):
    nb, tr = inputs.neighborhoods(spark, SF001), inputs.tracts(spark, SF001)
    m = workflows.house_master(inputs.houses(spark, SF001), nb, tr, tr)
    assert m.count() >= inputs.houses(spark, SF001).count()
    imp = workflows.imputation(m)
    assert imp["summary"].count() > 0
    lg = workflows.logit(m)
    assert {r["metric"] for r in lg["metrics"].collect()} == {"auc", "accuracy", "precision", "recall", "f1",
                                                                 "log_loss", "brier"}
