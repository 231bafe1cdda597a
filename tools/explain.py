"""Print the formatted physical plan of registered queries.

Usage: ``python tools/explain.py [sf_dir] key [key ...]``. With
``--run`` the query is executed first, so the adaptive plan shown is the
final one (AQE's runtime choices included).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventtrails import registry  # noqa: E402
from eventtrails.session import local_session  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    run = "--run" in sys.argv
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session(8)
    qs = registry.queries()
    for key in args or sorted(qs):
        df = qs[key](spark, sf_dir)
        if run:
            df.write.format("noop").mode("overwrite").save()
        print(f"===== {key} =====")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
