"""Every registered query against its SQL twin on the smallest data."""

import numpy as np
import pandas as pd
import pytest
from harness import duck, same

from tidemark.config import FEATURES
from tidemark.functions.expr import clean_nonfinite
from tidemark.operators import learn
from tidemark.plans.catalogue import ORACLES, QUERIES, learning
from tidemark.plans.workspace import Workspace

SF = "/root/testdata/sf0.001"
SLOW = {"M03_walk_forward_trees", "M09_variants"}
# The registered queries train the whole grid (test_learning_grid.py); here the same code runs over settings that fit the few rows of SF.
SMALL_GRID = [{"maxDepth": 3, "stepSize": 0.1, "maxIter": 3, "minInstancesPerNode": 5}, {"maxDepth": 2, "stepSize": 0.1, "maxIter": 2, "minInstancesPerNode": 5}]


@pytest.fixture(scope="module", autouse=True)
def small_grid():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(learn, "GRID", SMALL_GRID)
        yield


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert same(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_feature_gains_are_shares(spark):
    rows = QUERIES["M08_feature_importance"](spark, SF).collect()
    assert len(rows) == len(FEATURES) == 36 and all(r["gain"] >= 0 for r in rows) and abs(sum(r["gain"] for r in rows) - 1) < 36e-6        # rounded to six digits


def test_logistic_scores_follow_from_stored_coefficients(spark):
    """p_lr again in numpy from the medians, scale and coefficients that were stored."""
    ws = Workspace(spark, SF)
    frozen = learn.Frozen(spark, learning.frozen_path(ws), ws.cfg)
    fill, _, scale, line = frozen.line.stages
    medians = fill.surrogateDF.first().asDict()
    x = learn.clip_inputs(clean_nonfinite(ws.scored())).select("ticker", "date", *FEATURES).toPandas()
    z = np.column_stack([x[f].astype(float).fillna(medians[f]) for f in FEATURES])
    z = (z - scale.mean.toArray()) / np.where(scale.std.toArray() == 0, 1, scale.std.toArray())
    want = 1 / (1 + np.exp(-(z @ line.coefficients.toArray() + line.intercept)))
    got = x[["ticker", "date"]].merge(QUERIES["M07_batch_score"](spark, SF).toPandas(), on=["ticker", "date"], how="left")
    assert len(got) == len(want) and np.abs(got.p_lr.to_numpy() - want).max() < 2e-6 and got.p_up_5.between(0, 1).all()


def test_walk_forward_log_counts_and_choice(spark):
    log = pd.concat([QUERIES[q](spark, SF).toPandas() for q in ("M03_walk_forward_trees", "M04_walk_forward_logistic")])
    folds = duck(SF).execute(ORACLES["M02_walk_forward_folds"]).df().set_index(["fold", "role"])["n"]
    assert all((r.n_train, r.n_val) == (folds[r.fold, "train"], folds[r.fold, "val"]) for r in log.itertuples())
    trees = log[log.model != "logreg"].groupby("model").ic_mean.mean()
    best = QUERIES["M05_choose_config"](spark, SF).first()
    assert best["model"] == trees.idxmax() and abs(best["mean_ic"] - trees.max()) < 2e-6
    assert QUERIES["M06_frozen_manifest"](spark, SF).first()["params"] == best["cfg"]
