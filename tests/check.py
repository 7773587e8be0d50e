"""Run queries against their oracles: python tests/check.py sf0.01 [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import differences  # noqa: E402

from tidalfed.session import local_session  # noqa: E402

folder = f"/root/testdata/{sys.argv[1]}"
names = sys.argv[2:] or list(entry.queries())
spark = local_session()
bad = 0
for name in names:
    began = time.time()
    try:
        frame = entry.queries()[name](spark, folder)
        statement = entry.oracle_sql().get(name)
        problem = differences(frame, statement, folder) if statement else f"rows only: {frame.count()}"
    except Exception as error:  # noqa: BLE001
        problem = f"{type(error).__name__}: {str(error)[:600]}"
    bad += bool(problem) and not problem.startswith("rows only")
    print(f"{name:32} {time.time() - began:6.1f}s  {problem or 'ok'}", flush=True)
print(f"{bad} bad of {len(names)}")
