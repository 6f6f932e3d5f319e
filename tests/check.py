"""``python tests/check.py [sf_dir] [name ...]``: run queries beside DuckDB and print what differs."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry_module  # noqa: E402
from compare import differences, duck  # noqa: E402
from earshot.session import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, plans, sql = duck(sf_dir), entry_module.queries(), entry_module.oracle_sql()
    bad = 0
    for name in names or plans:
        start = time.time()
        try:
            df = plans[name](spark, sf_dir)
            if name in sql:
                problems = differences(df, con, sql[name])
            else:
                problems = [] if df.count() else ["EMPTY"]
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool([p for p in problems if p != "EMPTY"])
        mark = "ok  " if not problems else "BAD "
        print(f"{mark}{name} {time.time() - start:.2f}s {'' if name in sql else '(rows only)'} {problems or ''}", flush=True)
    print(f"{bad} bad of {len(names or plans)}")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    directory = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(directory, args) else 0)
