"""``python -m tastegrid {compact,train,recommend} [domain] --root FOLDER``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from tastegrid.config import DOMAINS
from tastegrid.plans import jobs
from tastegrid.session import build_session

INPUTS = ("log", "users", "catalogue", "tags", "rules")


def main() -> None:
    parser = argparse.ArgumentParser(prog="tastegrid", description=__doc__)
    parser.add_argument("job", choices=("compact", "train", "recommend"))
    parser.add_argument("domain", nargs="?", choices=list(DOMAINS), default="all")
    parser.add_argument("--root", required=True, help="folder of the inputs")
    parser.add_argument("--work", help="folder of the results (default ROOT/work)")
    for name in INPUTS:
        parser.add_argument(f"--{name}", help="this input, where it lies elsewhere")
    parser.add_argument("--as-of-year", type=int, help="year for unreadable birthdays")
    parser.add_argument("--stale", choices=("rebuild", "fail", "keep"), default="rebuild",
                        help="stored tables whose inputs, settings or code have changed")
    parser.add_argument("--resume", action="store_true", help="train on from the stored model")
    parser.add_argument("--top-n", type=int, default=200)
    parser.add_argument("--num-users", type=int, default=-1, help="first users only (-1: all)")
    parser.add_argument("--num-items", type=int, default=-1,
                        help="first active items only (-1: all)")
    parser.add_argument("--rule-sep", default="", help="between a rule and its contents")
    parser.add_argument("--batch-rows", type=int, help="rows per update, the domain's by default")
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    options = parser.parse_args()

    elsewhere = {n: getattr(options, n) for n in INPUTS if getattr(options, n)}
    layout = replace(jobs.Layout.under(options.root, options.work), **elsewhere)
    spark = build_session(f"tastegrid-{options.job}-{options.domain}", options.master)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(f"{layout.work.rstrip('/')}/scratch")
    domain = DOMAINS[options.domain]
    if options.job == "compact":
        print(jobs.compact_log(spark, layout))
    elif options.job == "train":
        for line in jobs.train_domain(
            spark, layout, domain, options.as_of_year, options.stale, options.resume,
            batch_rows=options.batch_rows,
        ):
            print(*line)
    else:
        found = jobs.recommend_domain(
            spark, layout, domain, options.as_of_year, options.top_n, options.num_users,
            options.num_items, options.rule_sep, options.stale,
        )
        print(found.count(), "profiles")
    spark.stop()


if __name__ == "__main__":
    main()
