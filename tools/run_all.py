"""Run every registered query once and report rows / errors / seconds."""
import sys
import time
import traceback

from rankflow.plans import registry
from rankflow.session import local_session

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2:]
spark = local_session(8)
for name, fn in registry.queries().items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        n = fn(spark, sf).count()
        print(f"OK   {name:32s} rows={n:8d} {time.time() - t:6.2f}s", flush=True)
    except Exception as e:  # noqa: BLE001
        msg = str(e).split("\n")[0][:300]
        print(f"FAIL {name:32s} {msg}", flush=True)
        if only:
            traceback.print_exc()
