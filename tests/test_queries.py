"""Every registered query against its SQL, or for shape where SQL can't express it."""

import pytest

from kinestream.plans.catalog import ORACLE_SQL, QUERIES
from tests.oracle import duck, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck(SF, ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["bracket_linear", "asof_causal", "nearest_earlier_tie", "fir_reflect"])
def test_joins_on_time_have_no_nested_loop(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_fits(spark):
    rows = QUERIES["similarity_fit"](spark, SF).collect()
    assert rows and all(r["scale"] is None or r["scale"] > 0 for r in rows)
    assert QUERIES["rts_smooth"](spark, SF).count() == QUERIES["kernel_mapping"](spark, SF).count()
    assert QUERIES["frame_rotation"](spark, SF).count() > 0 and QUERIES["plane_fit"](spark, SF).count() > 0
    assert all(abs(sum(x * x for x in r["direction"][:3]) - 1) < 1e-6 for r in QUERIES["guided_posterior"](spark, SF).limit(20).collect())


def test_rotations_of_frames_are_numpy(spark):
    """Each pose's rotation and scale to its label's mean, by an eigenvector of the quaternion form instead of singular vectors."""
    import numpy as np
    from kinestream.plans.poses import _pairs

    pairs = {}
    for r in _pairs(spark, SF).collect():
        pairs.setdefault((r.label, r.frame), []).append((tuple(r.s), tuple(r.t)))
    for r in QUERIES["frame_rotation"](spark, SF).limit(60).collect():
        s, t = (np.array(x) for x in zip(*pairs[r.label, r.frame], strict=True))
        m = s.T @ t
        skew = np.array([m[1, 2] - m[2, 1], m[2, 0] - m[0, 2], m[0, 1] - m[1, 0]])
        form = np.block([[np.trace(m), skew], [skew[:, None], m + m.T - np.trace(m) * np.eye(3)]])
        w, x, y, z = np.linalg.eigh(form)[1][:, -1]
        turn = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])
        assert np.allclose(np.array(r.rotation).reshape(3, 3), turn, atol=1e-6) and r.scale == pytest.approx((t * (s @ turn.T)).sum() / (s * s).sum())
