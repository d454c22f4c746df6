from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from civiclake.session import build_session

    s = build_session("local[4]", app="civiclake-tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run():
    return tempfile.mkdtemp(prefix="civiclake-test-")


def land(root: str, endpoint: str, pages: list[list[dict]], parent: tuple[str, object] | None = None,
         next_on_last: bool = False, skip: tuple[int, ...] = (), subdir: str = "") -> str:
    """Write landed page files ``<root>/<endpoint>/[<p>=<id>/][subdir/]page=<n>.json``."""
    d = os.path.join(root, endpoint)
    if parent:
        d = os.path.join(d, f"{parent[0]}={parent[1]}")
    if subdir:
        d = os.path.join(d, subdir)
    os.makedirs(d, exist_ok=True)
    for i, recs in enumerate(pages, start=1):
        if i in skip:
            continue
        links = [{"rel": "self", "href": f"x?pagina={i}"}]
        if i < len(pages) or next_on_last:
            links.append({"rel": "next", "href": f"x?pagina={i + 1}"})
        with open(os.path.join(d, f"page={i}.json"), "w") as fh:
            json.dump({"dados": recs, "links": links}, fh)
    return d
