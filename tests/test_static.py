"""Guards on the library source: built-in expressions only, nothing pulled to the driver."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parents[1] / "turnstile"
# The only driver reads: the latest day of a run, the touched buckets or days of a batch (their number is a setting, or
# that of the days), the partitions of a table (one tuple a directory), the checkpoints ever used (one row each).
ALLOWED_DRIVER_READS = {
    ("operators/quality.py", ".first()"),
    ("operators/keys.py", ".collect()"),
    ("sources/files.py", ".collect()"),
    ("streaming/ingest.py", ".collect()"),
    ("plans/compaction.py", ".collect()"),  # one row a day
    ("plans/versions.py", ".collect()"),  # one row a run
}


def _sources():
    # The optional training-data operators are free in style; they have tests of their own.
    for path in sorted(p for p in PKG.rglob("*.py") if "llm" not in p.relative_to(PKG).parts):
        yield path.relative_to(PKG).as_posix(), path.read_text()


def test_no_python_udfs_or_rdds():
    for name, text in _sources():
        assert not re.search(r"\budf\b|pandas_udf|\.rdd\b|mapPartitions|localCheckpoint", text), name


def test_driver_reads_are_bounded_control_values():
    for name, text in _sources():
        for call in (".collect()", ".first()", ".toPandas()", ".take("):
            if call in text:
                assert (name, call) in ALLOWED_DRIVER_READS, (name, call)


def test_entry_without_the_optional_operators():
    """Whatever keeps them from being imported, the event queries are there, and a warning names the cause."""
    import subprocess
    import sys

    code = (
        "import sys, warnings; sys.modules['{absent}'] = None\n"
        "with warnings.catch_warnings(record=True) as seen:\n"
        "    warnings.simplefilter('always'); import __spark_entry__ as E\n"
        "print(len(E.queries()), any('op1_bpe' in k for k in E.queries()), [str(w.message) for w in seen if 'left out' in str(w.message)])"
    )
    for absent in ("xxhash", "turnstile.llm", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", code.format(absent=absent)], capture_output=True, text=True, cwd=PKG.parent, timeout=120)
        from turnstile.plans import catalog

        assert out.stdout.startswith(f"{len(catalog.queries())} False"), out.stderr
        cause = absent.split(".")[0] if (PKG / "llm").is_dir() else "turnstile"  # without the folder it is always the cause
        assert cause in out.stdout.split("left out")[1]
