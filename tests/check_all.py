"""Run every named query against its SQL: python tests/check_all.py [folder] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import connect, difference  # noqa: E402

from archivekit.plans.oracles import ORACLES  # noqa: E402
from archivekit.plans.queries import QUERIES  # noqa: E402
from archivekit.session import get_session  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("check", **{
        "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        t = time.time()
        try:
            problem = difference(QUERIES[name](spark, folder), ORACLES[name], con)
        except Exception as error:  # show and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    spark.stop()
