"""Command line check: python tests/run_oracle.py <sf_dir> [name part ...]"""

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from __spark_entry__ import _registered  # noqa: E402
from millrace.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402

if __name__ == "__main__":
    sf, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), duck(sf)
    bad = 0
    for name, (fn, sql) in sorted(_registered().items()):
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            if sql is None:
                n = fn(spark, sf).count()
                problems = [] if n else ["no rows"]
                note = f"rows only: {n}"
            else:
                problems = compare(spark, con, fn, sql, sf)
                note = "ok"
        except Exception as e:  # report and go on
            problems = [traceback.format_exc(limit=-3)[-1500:] if "-v" in wanted else str(e)[:600]]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t:.1f}s {'; '.join(problems) or note}", flush=True)
    print("failed:", bad)
