"""Property: however silver is cut into micro-batches, whatever their order,
and whichever batches are replayed, the refreshed facts and the
dimensions end equal to their batch form."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attrlake.operators import dims as D
from attrlake.operators import facts as A
from attrlake.plans import queries as Qy
from attrlake.session import run_dir
from attrlake.streaming import pipeline as P
from attrlake.streaming.runner import Lake

from conftest import SF_SMALL


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    parts=st.integers(min_value=2, max_value=4),
    seed=st.integers(min_value=0, max_value=10_000),
    order=st.permutations(range(4)),
    replay=st.lists(st.integers(min_value=0, max_value=3), max_size=2),
)
def test_any_batching_order_and_replay_gives_the_batch_result(spark, parts, seed, order, replay):
    lake = Lake(spark, run_dir(spark, "t-prop"))
    silver = Qy.silver_rows(spark, SF_SMALL).persist()
    piece = F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(parts))
    batches = [silver.where(piece == i) for i in range(parts)]
    sequence = [i for i in order if i < parts] + [i for i in replay if i < parts]
    name = "fact_events_daily"
    for bid in sequence:
        lake.silver.insert_new(batches[bid], ["event_date", "id"])
        P.refresh_touched_days(batches[bid], lake.silver, lake.fact(name), name)
        P.upsert_dimension(batches[bid], lake.dim("dim_app"), "dim_app")
    want = A.fact_events_daily(silver)
    got = lake.fact(name).read().select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    want_dim = D.dim_app(silver)
    assert lake.dim("dim_app").read().select(*want_dim.columns).exceptAll(want_dim).count() == 0
    silver.unpersist()
