"""Random change histories: increments end where a full build ends."""

from __future__ import annotations


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oreline.operators.changes import incremental, scd1_seen
from oreline.operators.tables import VersionedTable, work_dir
from oreline.sources import rows_df

SCHEMA = "k bigint, at timestamp_ntz, v string"

# A history is a list of loads; a load edits or adds some of ten keys.
HISTORY = st.lists(
    st.dictionaries(st.integers(0, 9), st.sampled_from("abc"), max_size=6), min_size=1, max_size=4
)


def _stamp(load: int):
    import datetime as dt

    return dt.datetime(2026, 1, 1) + dt.timedelta(hours=load)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(HISTORY)
def test_increments_equal_full_refresh(spark, history):
    table = VersionedTable(spark, f"{work_dir(spark)}/t", key="k", buckets=3)
    source: dict[int, tuple] = {}
    for load, edits in enumerate(history):
        source |= {k: (k, _stamp(load), v) for k, v in edits.items()}
        now = rows_df(spark, list(source.values()), SCHEMA)
        incremental(table, now, lambda df: df, "at")
    assert sorted(map(tuple, table.read().collect())) == sorted(source.values())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(HISTORY)
def test_scd1_follows_a_plain_model(spark, history):
    dim = rows_df(spark, [], "k bigint, v string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz")
    model: dict[int, tuple] = {}
    for load, seen in enumerate(history):
        at = _stamp(load)
        observed = rows_df(spark, [(k, at, v) for k, v in seen.items()], SCHEMA)
        dim = scd1_seen(dim, observed, "k", "at")
        for k, v in seen.items():
            model[k] = (k, v, model[k][2] if k in model else at, at)
    assert sorted(map(tuple, dim.collect())) == sorted(model.values())
