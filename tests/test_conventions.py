"""Library conventions: native expressions only, no per-row Python, no RDDs,
no machine-local checkpoints."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parents[1] / "ledgerline"
SOURCES = {p: p.read_text() for p in PKG.rglob("*.py")}
CODE = {
    p: "\n".join(
        line for line in text.splitlines() if not line.lstrip().startswith(("#", '"', "'", "``"))
    )
    for p, text in SOURCES.items()
}


def _hits(pattern: str) -> list[str]:
    rx = re.compile(pattern)
    return [f"{p.name}:{i + 1}" for p, text in CODE.items() for i, line in enumerate(text.splitlines()) if rx.search(line)]


def test_no_local_checkpoint():
    assert _hits(r"localCheckpoint\(") == []


def test_no_python_udfs():
    assert _hits(r"pandas_udf|\bF\.udf\b|@udf|mapInPandas|applyInPandas") == []


def test_no_rdd_api():
    assert _hits(r"\.rdd\b|mapPartitions\(|sparkContext\.parallelize") == []
