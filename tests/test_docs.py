"""The README's coverage table lists every query of the library, and every key
there is registered."""

import os
import re

from zonecast.plans.registry import all_queries


def test_readme_coverage_matches_registry():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    text = open(os.path.join(root, "README.md"), encoding="utf-8").read()
    table = text[text.index("## Coverage"):text.index("## Decisions")]
    listed = set(re.findall(r"`([a-z_]+)`", table))
    registered = set(all_queries())
    assert registered <= listed, sorted(registered - listed)
    assert {k for k in listed if "_" in k} - registered <= {"oracle_sql"}
