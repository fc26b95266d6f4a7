"""The model graph (W3): declared inputs, levels, limited concurrency, changed models only.

A model names its inputs, which are star tables or other models.  Views are lazy
frames, tables are built into attempts of their own, at most ``CONCURRENCY`` at a
time and each as soon as its inputs are there.  A model remembers the state of the
star tables it was built from, so a run builds only what a commit changed.  The
children of a model that fails are skipped, models beside it are still built, and
what was built is published in one commit unless the run is to be all or nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cadence.operators.star import dim_table
from cadence.plans import models as M
from cadence.sources.warehouse import DIM_TABLES, FACT, State, Warehouse

# Fixed value: how many models are built at the same time.
CONCURRENCY = 4
SOURCES = (*DIM_TABLES, FACT)


class CycleError(ValueError):
    """Models that need each other."""


class ModelsFailed(RuntimeError):
    """Some models could not be built; ``run`` tells which."""

    def __init__(self, run: Run):
        super().__init__(f"models failed: {', '.join(f'{n} ({e})' for n, e in sorted(run.errors.items()))}")
        self.run = run


@dataclass(frozen=True)
class Model:
    """``build`` takes the inputs by name; a ``stored`` model is a table, others are views."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    stored: bool = False


MODELS = (
    Model("stg_streams", (FACT,), M.stg_streams),
    Model("stg_songs", ("dim_song",), M.stg_songs),
    Model("stg_artists", ("dim_artist",), M.stg_artists),
    Model("stg_dates", ("dim_date",), M.stg_dates),
    Model("mart_top_artists", ("stg_streams", "stg_artists"), M.mart_top_artists, True),
    Model("mart_top_songs", ("stg_streams", "stg_songs", "stg_artists"), M.mart_top_songs, True),
    Model("mart_listening_patterns", ("stg_streams", "stg_dates"), M.mart_listening_patterns, True),
)


@dataclass
class Run:
    """What became of each stored model: built, unchanged, failed or skipped."""

    version: int
    status: dict[str, str] = field(default_factory=dict)
    attempts: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def levels(graph: tuple[Model, ...] = MODELS, sources: tuple[str, ...] = SOURCES) -> list[list[str]]:
    """The models in order: each level needs sources and earlier levels only."""
    names = [m.name for m in graph]
    if len(set(names)) < len(names) or set(names) & set(sources):
        raise ValueError("model names must be unique and differ from the sources")
    unknown = {i for m in graph for i in m.inputs} - set(names) - set(sources)
    if unknown:
        raise ValueError(f"unknown inputs {sorted(unknown)}")
    left, done, out = {m.name: set(m.inputs) - set(sources) for m in graph}, set(), []
    while left:
        level = sorted(n for n, needs in left.items() if needs <= done)
        if not level:
            raise CycleError(f"models need each other: {', '.join(sorted(left))}")
        out.append(level)
        done |= set(level)
        left = {n: needs for n, needs in left.items() if n not in done}
    return out


def sources_of(graph: tuple[Model, ...]) -> dict[str, set[str]]:
    """model -> the star tables below it."""
    known = {m.name: m for m in graph}
    out: dict[str, set[str]] = {}
    for level in levels(graph):
        for name in level:
            out[name] = set().union(*[out.get(i, {i}) for i in known[name].inputs])
    return out


def built_from(state: State, tables: set[str]) -> str:
    """A signature of the rows of some star tables: which attempts hold them."""
    held = []
    for table in sorted(tables):
        if table == FACT:
            # A fold renames a month's attempts, so models are built once more after it.
            held += [f"{m}/{a}" for m, found in sorted(state.sources().items()) for a in sorted(found)]
        else:
            held += [f"{table}/{a}" for a in state.dims.get(table, [])]
    return State.signature(held)


def run_models(warehouse: Warehouse, graph: tuple[Model, ...] = MODELS, select: set[str] | None = None,
               concurrency: int = CONCURRENCY, all_or_nothing: bool = False, whole: bool = False,
               fact: DataFrame | None = None, state: State | None = None, publish: bool = True) -> Run:
    """Build the stored models that changed (``whole``: all), or of ``select`` those that did.

    ``fact`` may hold the fact of ``state``, if it is stored already.  Raises
    ``ModelsFailed`` after publishing what was built; with ``all_or_nothing`` nothing
    is published then.
    """
    order = [n for level in levels(graph) for n in level]
    known, state = {m.name: m for m in graph}, state or warehouse.state()
    unknown = (select or set()) - set(known)
    if unknown:
        raise ValueError(f"unknown models {sorted(unknown)}")
    run, below = Run(state.version), sources_of(graph)
    wanted = []
    for name in order:
        if not known[name].stored or (select is not None and name not in select):
            continue
        same = state.built.get(name) == built_from(state, below[name]) and name in state.models
        if same and not whole:
            run.status[name] = "unchanged"
        else:
            wanted.append(name)
    needed = set(wanted)
    for name in reversed(order):
        if name in needed:
            needed |= set(known[name].inputs)
    frames: dict[str, DataFrame] = {}
    for table in SOURCES:
        if table in needed:
            frames[table] = dim_table(warehouse, table, state) if table != FACT else (
                M.fact_song_stream(warehouse, state) if fact is None else fact)
    _build(warehouse, [known[n] for n in order if n in needed], wanted, frames, run, concurrency)
    if publish and run.attempts and not (run.errors and all_or_nothing):
        warehouse.publish_models(run.attempts, {n: built_from(state, below[n]) for n in run.attempts})
    if run.errors:
        raise ModelsFailed(run)
    return run


def _build(warehouse: Warehouse, models: list[Model], wanted: list[str], frames: dict[str, DataFrame], run: Run,
           concurrency: int) -> None:
    """Build views at once and tables as soon as their inputs are there."""
    waiting, running = list(models), {}

    def table(model: Model, inputs: list[DataFrame]) -> str:
        attempt = warehouse.new_attempt("build")
        # A stored table has no order; readers sort what they show.
        ordered = {"ordered": False} if model.build in ORDERED else {}
        model.build(*inputs, **ordered).write.parquet(warehouse.attempt_path(f"marts/{model.name}", attempt))
        return attempt

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        while waiting or running:
            for model in list(waiting):
                if any(i in run.errors or run.status.get(i) == "skipped" for i in model.inputs):
                    run.status[model.name] = "skipped"
                    waiting.remove(model)
                elif all(i in frames for i in model.inputs):
                    inputs = [frames[i] for i in model.inputs]
                    waiting.remove(model)
                    if model.stored and model.name in wanted:
                        running[pool.submit(table, model, inputs)] = model
                    elif model.stored:
                        # An unchanged or unselected table that another model reads.
                        _attempted(run, model, lambda m=model: frames.__setitem__(
                            m.name, warehouse.read_model(m.name)))
                    else:
                        _attempted(run, model, lambda m=model, i=inputs: frames.__setitem__(m.name, m.build(*i)))
            if running:
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                for future in done:
                    _finished(warehouse, running.pop(future), future, frames, run)


def _attempted(run: Run, model: Model, build: Callable[[], None]) -> None:
    try:
        build()
    except Exception as e:  # noqa: BLE001 - reported by run_models
        run.status[model.name], run.errors[model.name] = "failed", f"{type(e).__name__}: {e}"


def _finished(warehouse: Warehouse, model: Model, future: Future, frames: dict[str, DataFrame], run: Run) -> None:
    def take() -> None:
        attempt = future.result()
        frames[model.name] = warehouse.spark.read.parquet(warehouse.attempt_path(f"marts/{model.name}", attempt))
        run.status[model.name], run.attempts[model.name] = "built", attempt

    _attempted(run, model, take)


ORDERED = (M.mart_top_artists, M.mart_top_songs, M.mart_listening_patterns)
