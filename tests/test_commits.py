"""A version is published once, by whatever process comes first."""

import os
import subprocess
import sys
from types import SimpleNamespace

from cadence.sources.warehouse import Warehouse
from tests.conftest import ROOT

WRITER = """
import sys, time
sys.path.insert(0, {root!r})
from cadence.session import build_session
from cadence.sources.warehouse import State, Warehouse
spark = build_session("local[1]")
wh = Warehouse(spark, {warehouse!r})
open({warehouse!r} + "/ready-" + sys.argv[1], "w").close()
while not __import__("os").path.exists({warehouse!r} + "/go"):
    time.sleep(0.01)
won = []
for version in range(60):
    # Both processes start from the same version, whoever published it.
    if wh.try_commit(State(version=version), streams={{sys.argv[1]: version}}):
        won.append(version + 1)
print("WON", *won)
"""


def test_two_processes_never_publish_the_same_version(spark, tmp_path):
    root = str(tmp_path)
    code = WRITER.format(root=ROOT, warehouse=root)
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--driver-memory 512m pyspark-shell"}
    running = [subprocess.Popen([sys.executable, "-c", code, name], stdout=subprocess.PIPE, text=True, env=env)
               for name in ("a", "b")]
    try:
        while not all((tmp_path / f"ready-{n}").exists() for n in ("a", "b")):
            assert all(p.poll() is None for p in running)
        (tmp_path / "go").touch()
        out = [p.communicate(timeout=240)[0] for p in running]
    finally:
        for p in running:
            p.kill()
    won = [set(next(x for x in o.splitlines() if x.startswith("WON")).split()[1:]) for o in out]
    assert not won[0] & won[1] and len(won[0] | won[1]) == 60
    wh = Warehouse(spark, root)
    for version in wh.versions():
        assert str(version) in won["ab".index(next(iter(wh.state(version).streams)))]


def test_a_rename_does_not_overwrite_either(spark, warehouse):
    base = warehouse.state()
    fs = warehouse._fs(warehouse.root)[1]
    elsewhere = SimpleNamespace(getScheme=lambda: "other", getUri=fs.getUri)
    real = warehouse._name_once
    warehouse._name_once = lambda _, draft, target: real(elsewhere, draft, target)
    assert warehouse.try_commit(base, streams={"a": 1}).version == 1
    draft, _ = warehouse._fs(f"{warehouse.root}/_commits/.late")
    fs.create(draft, False).close()
    target, _ = warehouse._fs(f"{warehouse.root}/_commits/{1:012d}.json")
    try:
        real(elsewhere, draft, target)
    except Exception as e:  # noqa: BLE001
        assert "FileAlreadyExists" in str(e)
    else:
        raise AssertionError("overwritten")
    assert warehouse.state().streams == {"a": 1}
    assert not [n for n, _ in warehouse.list_dir(f"{warehouse.root}/_commits") if n.startswith(".draft")]
