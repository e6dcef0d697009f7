"""python -m tesserae list | run QUERY TABLES OUT | show QUERY TABLES: the catalogue from the command line."""

from __future__ import annotations

import sys


def main(args: list[str]) -> int:
    from tesserae.plans import catalogue
    from tesserae.session import get_spark

    known = catalogue.queries()
    if args[:1] == ["list"] and len(args) == 1:
        print("\n".join(sorted(known)))
        return 0
    if len(args) < 3 or args[0] not in ("run", "show") or args[1] not in known or (args[0] == "run") != (len(args) == 4):
        print(__doc__, file=sys.stderr)
        return 2
    got = known[args[1]](get_spark(args[1]), args[2])
    if args[0] == "run":
        got.write.mode("errorifexists").parquet(args[3])
    else:
        got.show(20, False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
