"""The entry leaves these operators out only where they are not there."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _entry(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as e; print(sum(q.startswith('op') for q in e.queries()))")
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                          timeout=120)


def test_absent_operators_are_left_out_and_broken_ones_raise():
    for gone in ("dayflow.llm.queries", "corpus_pipeline"):
        out = _entry(gone)
        assert out.returncode == 0 and out.stdout.strip() == "0", out.stderr
    for needed in ("dayflow.llm.bpe", "dayflow.llm.common", "regex_that_is_not_used"):
        out = _entry(needed)
        broken = needed.startswith("dayflow")
        assert (out.returncode != 0) == broken
        assert not broken or "ModuleNotFoundError" in out.stderr
