"""The whole DAG over documents made from the test tables, and its declared suite."""

import pytest

from conftest import SF_DIR
from ledgerloom.operators.models import Dag
from ledgerloom.operators.quality import run_suite
from ledgerloom.plans.build import MARTS, build_dag, write_marts
from ledgerloom.plans.suite import declared_checks
from ledgerloom.schemas import STAGING
from ledgerloom.sources.staging import stage
from ledgerloom.workloads.standins import AS_OF, StandIns


@pytest.fixture(scope="module")
def dag(spark):
    source = StandIns(spark, SF_DIR)
    staged = {t: stage(t, source.landing(t), number_scale=2) for t in STAGING}
    return build_dag(spark, staged, source.seed, AS_OF)


def test_models_build_and_pass_their_suite(dag, spark):
    assert len(dag.names()) == 17
    models = {name: dag.ref(name) for name in dag.names()}
    results = run_suite(declared_checks(), models).collect()
    assert len(results) == 71
    failed = {(r.model, r.column, r.check) for r in results if r.should_error}
    # Two test lines agree in all key columns, so their cost events share a key: the suite must find that.
    lines = StandIns(spark, SF_DIR).table("lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    repeated = lines.count() != lines.select(*keys).distinct().count()
    assert failed == ({("int_unified_cost", "cost_event_id", "unique")} if repeated else set())


def test_marts_are_written(dag, spark):
    written = write_marts(dag)
    assert set(written) == set(MARTS)
    assert all(df.count() > 0 for df in written.values())
    assert "dbt_loaded_at" in written["fact_revenue_gap"].columns


def test_suite_covers_every_declared_check():
    kinds = [c.kind for c in declared_checks()]
    assert (len(kinds), kinds.count("not_null"), kinds.count("unique"), kinds.count("relationships")) == (71, 36, 22, 13)


def test_dag_builds_once_and_refuses_cycles(spark):
    dag, calls = Dag(spark), []

    @dag.model()
    def a(d, s):
        calls.append(1)
        return s.range(1)

    @dag.model()
    def b(d, s):
        return d.ref("a").union(d.ref("a")).toPandas()  # a pandas result is accepted

    @dag.model()
    def c(d, s):
        return d.ref("c")

    assert dag.ref("b").count() == 2 and calls == [1]
    with pytest.raises(ValueError, match="cycle"):
        dag.ref("c")
