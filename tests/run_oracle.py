"""Command line: compare all or the named catalogue queries at a scale folder."""

import sys
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tradeflow.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    plans, sqls = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names or plans:
        try:
            if name in sqls:
                ok, note, seconds = compare(spark, con, plans[name], sqls[name], sf_dir)
            else:
                ok, note, seconds = True, f"rows-only: {plans[name](spark, sf_dir).count()}", 0.0
        except Exception:
            ok, note, seconds = False, traceback.format_exc(limit=3)[-1800:], 0.0
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {seconds:.1f}s {note}", flush=True)
    print("failed:", failed)
