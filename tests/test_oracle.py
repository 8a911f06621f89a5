"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import connect, difference, spark_rows, sql_rows
from conftest import SF_ORACLE

from tidewatch.plans.oracles import ORACLES
from tidewatch.plans.queries import QUERIES

ROWS_ONLY = {"moderation_model_scores", "moderation_model_evaluation"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_ORACLE)


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SF_ORACLE))
    assert got[0], "the check would be empty"
    assert difference(got, sql_rows(con, ORACLES[name])) is None


def test_a_model_scores_every_row_and_is_judged_by_its_scores(spark):
    rows = QUERIES["moderation_model_scores"](spark, SF_ORACLE).collect()
    assert rows and all(0.0 <= r["prob_violation"] <= 1.0 for r in rows)
    found = QUERIES["moderation_model_evaluation"](spark, SF_ORACLE).first()
    good = [r.prob_violation for r in rows if r.true_label == 1]
    bad = [r.prob_violation for r in rows if r.true_label == 0]
    pairs = sum((a > b) + 0.5 * (a == b) for a in good for b in bad)
    assert found.auc == pytest.approx(pairs / (len(good) * len(bad)), abs=1e-9) and found.auc > 0.8
    assert (found.false_positives, found.false_negatives) == (sum(b >= 0.5 for b in bad), sum(a < 0.5 for a in good))
    assert found.n == len(rows)
