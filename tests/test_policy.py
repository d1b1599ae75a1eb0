"""Source-level guards for the library (not the test bindings)."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "arealens"


def _sources(*parts):
    for p in LIB.joinpath(*parts).rglob("*.py"):
        yield p, p.read_text()


def test_no_local_checkpoint_anywhere():
    for p, src in _sources():
        assert "localCheckpoint" not in src, p


def test_operators_never_collect_or_use_python_udfs():
    for p, src in _sources("operators"):
        assert not re.search(r"\.collect\(\)|\.toPandas\(\)|\budf\(|pandas_udf", src), p


def test_machine_local_folder_only_as_test_fallback():
    for p, src in _sources():
        if "/tmp" in src:
            assert p.name == "session.py", p   # used only when the session names no checkpoint folder


def test_operators_run_no_measuring_jobs():
    for p, src in _sources("operators"):
        assert not re.search(r"\.first\(\)|\.count\(\)(?!\.|\s*\.agg)", src), p
