"""Order, concurrency, selection and failures of the model graph."""

import threading
import time

import pytest

from cadence.operators.clean import clean_plays
from cadence.operators.star import load_star
from cadence.plans import graph as G
from cadence.plans.graph import CycleError, Model, ModelsFailed, levels, run_models
from cadence.plans.models import MART_NAMES
from tests.conftest import staged_df


def plays(spark, *rows):
    return clean_plays(staged_df(spark, [("t", a, f"2026-{d}T22:00:00Z", "60000", a, s) for d, a, s in rows]))


def test_levels_follow_the_declared_inputs():
    assert levels() == [["stg_artists", "stg_dates", "stg_songs", "stg_streams"], sorted(MART_NAMES)]
    with pytest.raises(CycleError, match="a, b"):
        levels((Model("a", ("b",), None), Model("b", ("a",), None), Model("c", ("dim_song",), None)))
    with pytest.raises(ValueError, match="nothing"):
        levels((Model("a", ("nothing",), None),))
    with pytest.raises(ValueError, match="unique"):
        levels((Model("a", ("dim_song",), None), Model("a", ("dim_song",), None)))
    with pytest.raises(ValueError, match="unique"):
        levels((Model("dim_song", (), None),))


def test_only_what_a_commit_changed_is_built(spark, warehouse):
    load_star(warehouse, plays(spark, ("05-01", "x", "s1")), "b1")
    assert set(run_models(warehouse).status.values()) == {"built"}
    assert set(run_models(warehouse).status.values()) == {"unchanged"}
    assert set(run_models(warehouse, whole=True).status.values()) == {"built"}
    by_artist = Model("artists", ("stg_artists",), lambda a: a, True)
    graph = (*G.MODELS, by_artist, Model("names", ("artists",), lambda a: a.select("artist_name"), True))
    assert run_models(warehouse, graph).status == {n: "unchanged" for n in MART_NAMES} | {
        "artists": "built", "names": "built"}
    # Cells of a known artist change the marts but not what reads artists only.
    load_star(warehouse, plays(spark, ("05-02", "x", "s1")), "b2")
    status = run_models(warehouse, graph).status
    assert status == {n: "built" for n in MART_NAMES} | {"artists": "unchanged", "names": "unchanged"}
    load_star(warehouse, plays(spark, ("05-02", "y", "s2")), "b3")
    assert run_models(warehouse, graph, select={"names", "mart_top_songs"}).status == {
        "names": "built", "mart_top_songs": "built"}
    assert sorted(r.artist_name for r in warehouse.read_model("artists").collect()) == ["x"]
    with pytest.raises(ValueError, match="other"):
        run_models(warehouse, select={"other"})


def test_children_of_a_failed_model_are_skipped_and_others_are_built(spark, warehouse):
    load_star(warehouse, plays(spark, ("05-01", "x", "s1")), "b1")

    def broken(songs):
        raise ArithmeticError("no")

    graph = (Model("songs", ("dim_song",), broken, True), Model("child", ("songs",), lambda s: s, True),
             Model("view", ("child",), lambda s: s), Model("grandchild", ("view", "dim_date"), lambda s, d: s, True),
             Model("beside", ("dim_artist",), lambda a: a, True))
    for strict in (True, False):
        with pytest.raises(ModelsFailed, match="songs .ArithmeticError: no") as e:
            run_models(warehouse, graph, all_or_nothing=strict)
        status = e.value.run.status
        assert status == {"songs": "failed", "child": "skipped", "view": "skipped", "grandchild": "skipped",
                          "beside": "built"}
        assert ("beside" in warehouse.state().models) == (not strict)
    assert "songs" not in warehouse.state().models


def test_no_more_models_at_a_time_than_allowed(spark, warehouse):
    load_star(warehouse, plays(spark, ("05-01", "x", "s1")), "b1")
    lock, now, most = threading.Lock(), [0], [0]

    def slow(df):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.3)
        with lock:
            now[0] -= 1
        return df

    graph = tuple(Model(f"m{i}", ("dim_artist",), slow, True) for i in range(5))
    assert len(run_models(warehouse, graph, concurrency=2).attempts) == 5 and most[0] == 2
