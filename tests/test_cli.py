import subprocess
import sys

from turnstile.__main__ import _parser


def test_parser_knows_every_job():
    for cmd in ("land-students", "produce", "stream", "full", "daily", "increment", "compact", "analytics"):
        assert _parser().parse_args([cmd, "--root", "/x"]).command == cmd


def test_help_runs():
    out = subprocess.run([sys.executable, "-m", "turnstile", "--help"], capture_output=True, text=True,
                         cwd=__file__.rsplit("/tests/", 1)[0], timeout=60)
    assert out.returncode == 0 and "analytics" in out.stdout
