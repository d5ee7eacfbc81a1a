"""Run queries against their SQL: ``python tests/check_all.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tablewright.session import local_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, db = local_session(8), oracle.connect(folder)
    names = sys.argv[2:] or list(entry.oracle_sql())
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = oracle.difference(
                entry.queries()[name](spark, folder), db, entry.oracle_sql()[name]
            )
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.2f}s {result or ''}")
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
