"""The library uses the session it is handed: it never builds, stops or
configures one (the cluster's settings apply as they are)."""

import pathlib

from conftest import ROOT

FORBIDDEN = ("SparkSession.builder", ".getOrCreate(", ".conf.set(", ".stop()", "localCheckpoint",
             "setCheckpointDir(tempfile", "tempfile")


def test_library_never_creates_or_configures_a_session():
    found = []
    for path in sorted(pathlib.Path(ROOT, "quarry").rglob("*.py")):
        if "llm" in path.parts:      # its sessions without a checkpoint folder get a scratch one
            continue
        text = path.read_text()
        found += [(path.name, f) for f in FORBIDDEN if f in text]
    assert found == []
