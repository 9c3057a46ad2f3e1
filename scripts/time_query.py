"""Time registered queries (build + full execution via the noop sink).

Usage: python scripts/time_query.py sf_dir name [name ...] [--explain]
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pktsieve.plans import queries as Q  # noqa: E402
from pktsieve.session import local_session  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    explain = "--explain" in sys.argv
    sf, names = args[0], args[1:]
    spark = local_session(8)
    for name in names:
        for i in range(3):
            t0 = time.perf_counter()
            df = Q.REGISTRY[name](spark, sf)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            t2 = time.perf_counter()
            print(f"{name} run{i}: build {t1 - t0:.2f}s exec {t2 - t1:.2f}s", flush=True)
        if explain:
            df.explain("formatted")


if __name__ == "__main__":
    main()
