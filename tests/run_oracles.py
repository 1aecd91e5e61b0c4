"""Manual check: every registered query against its DuckDB oracle.

    python tests/run_oracles.py [sf_dir] [name ...]
"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duck  # noqa: E402
from stagecraft.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in os_:
                problems, n = compare(df, con, os_[name])
            else:
                problems, n = ["(no oracle)"], df.count()
        except Exception as e:  # noqa: BLE001
            problems, n = [f"ERROR {type(e).__name__}: {str(e)[:600]}"], -1
        ok = not problems or problems == ["(no oracle)"]
        bad += 0 if ok else 1
        print(f"\n{"OK " if ok else "BAD"} {name:24s} rows={n:<8d} {time.time() - t:6.1f}s {'; '.join(problems)}",
              flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
