"""Command line: `python -m tidewheel <step> ...` or the same under spark-submit."""

from __future__ import annotations

import argparse

from tidewheel.contract import BOOST_GRID, BOOST_SHIPPED
from tidewheel.operators.models import BoostParams
from tidewheel.plans import service, study, warehouse
from tidewheel.session import clear_scratch, session


def _quantile(text: str) -> float:
    value = float(text)
    if not 0 < value < 1:
        raise argparse.ArgumentTypeError(f"must be in (0, 1), got {value}")
    return value


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidewheel", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    build = steps.add_parser("build", help="raw CSV folders -> star schema -> export")
    build.add_argument("--raw", required=True, help="folder with one sub-folder of CSV files per year")
    build.add_argument("--years", required=True, nargs="+")
    build.add_argument("--warehouse", required=True)
    build.add_argument("--export", required=True)
    build.add_argument("--holidays", help="Parquet table with a date column `holiday`; else Ontario's by rule")

    prepare = steps.add_parser("prepare", help="export -> pool, panel, features, frozen split")
    prepare.add_argument("--export", required=True)
    prepare.add_argument("--out", required=True)
    prepare.add_argument("--scope", choices=["annual", "all"], default="annual")

    fit = argparse.ArgumentParser(add_help=False)
    fit.add_argument("--out", required=True)
    fit.add_argument("--quantile", type=_quantile, help="fit this quantile; without it the mean, by Poisson loss")
    fit.add_argument("--rounds", type=int, default=BOOST_SHIPPED["rounds"])
    fit.add_argument("--leaves", type=int, default=BOOST_SHIPPED["max_leaf_nodes"])
    fit.add_argument("--depth", type=int, help="bound on the depth of trees; none by default")
    fit.add_argument("--learning-rate", type=float, default=BOOST_SHIPPED["learning_rate"])
    fit.add_argument("--min-samples-leaf", type=int, default=20)
    fit.add_argument("--l2", type=float, default=0.0)
    fit.add_argument("--max-features", type=float, default=BOOST_SHIPPED["max_features"])

    train = steps.add_parser("train", parents=[fit], help="fit one boosted model on the frozen split")
    train.add_argument("--name", required=True)

    steps.add_parser("ablation", parents=[fit], help="the learner without and with the prior-year features")

    sweep = steps.add_parser("sweep", help="rank the published candidates on validation, train the winner")
    sweep.add_argument("--out", required=True)
    sweep.add_argument("--name", required=True)
    sweep.add_argument("--rounds-divisor", type=int, default=1, help="fit this fraction of the published rounds")

    regression = steps.add_parser("regression", help="Poisson regression against the cell means")
    regression.add_argument("--out", required=True)
    regression.add_argument("--alpha", type=float, default=1.0)

    importance = steps.add_parser("importance", help="what shuffling each feature costs a saved model")
    importance.add_argument("--out", required=True)
    importance.add_argument("--name", required=True)
    importance.add_argument("--repeats", type=int, default=3)

    interval = steps.add_parser("interval", help="bootstrap interval of a saved model's gain over the cell means")
    interval.add_argument("--out", required=True)
    interval.add_argument("--name", required=True)

    evaluate = steps.add_parser("evaluate", help="all reports of saved models on the test part")
    evaluate.add_argument("--out", required=True)
    evaluate.add_argument("--names", required=True, nargs="+")
    evaluate.add_argument("--quantiles", nargs="*", default=[], help="name=level of the quantile models")
    evaluate.add_argument("--reference", required=True)
    evaluate.add_argument("--recommended", required=True)

    lookups = steps.add_parser("lookups", help="write what the forecast step looks up")
    lookups.add_argument("--out", required=True)
    lookups.add_argument("--export", required=True)
    lookups.add_argument("--history-year", type=int, required=True)

    forecast = steps.add_parser("forecast", help="score a table of (request_id, body)")
    forecast.add_argument("--out", required=True)
    forecast.add_argument("--name", required=True)
    forecast.add_argument("--requests", required=True, help="Parquet table")
    forecast.add_argument("--answers", required=True)
    forecast.add_argument("--holidays", help="the table that the warehouse was built with")
    return parser


def _params(args: argparse.Namespace) -> BoostParams:
    loss = {"loss": "poisson"} if args.quantile is None else {"loss": "quantile", "quantile": args.quantile}
    return BoostParams(rounds=args.rounds, max_leaf_nodes=args.leaves, depth=args.depth, learning_rate=args.learning_rate,
                       min_samples_leaf=args.min_samples_leaf, l2=args.l2, max_features=args.max_features, **loss)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = session(f"tidewheel {args.step}")
    holidays = spark.read.parquet(args.holidays) if getattr(args, "holidays", None) else None
    if args.step == "build":
        folders = {year: f"{args.raw}/{year}/*.csv" for year in args.years}
        for name, report in warehouse.build(spark, folders, args.warehouse, args.export, holidays).items():
            print(name)
            report.show(100, truncate=False)
    elif args.step == "prepare":
        scope = study.ANNUAL if args.scope == "annual" else study.ALL_USERS
        study.prepare(spark, args.export, args.out, scope)
        print(study.read_contract(spark, args.out))
    elif args.step == "train":
        study.train(spark, args.out, args.name, _params(args)).show(truncate=False)
    elif args.step == "ablation":
        study.ablation(spark, args.out, _params(args)).show(truncate=False)
    elif args.step == "sweep":
        grid = [BoostParams(**{**p, "rounds": max(1, p["rounds"] // args.rounds_divisor)}) for p in BOOST_GRID]
        study.sweep(spark, args.out, args.name, grid).show(truncate=False)
    elif args.step == "regression":
        study.regression(spark, args.out, args.alpha).show(truncate=False)
    elif args.step == "importance":
        study.importance(spark, args.out, args.name, args.repeats).show(truncate=False)
    elif args.step == "interval":
        study.interval(spark, args.out, args.name).show(truncate=False)
    elif args.step == "evaluate":
        levels = {name: float(level) for name, _, level in (q.partition("=") for q in args.quantiles)}
        for name, report in study.evaluate(spark, args.out, args.names, levels, args.reference, args.recommended).items():
            print(name)
            report.show(100, truncate=False)
    elif args.step == "lookups":
        service.build_lookups(spark, args.out, args.export, args.history_year)
    else:
        predictions, refusals = service.forecast(
            spark, args.out, args.name, spark.read.parquet(args.requests), holidays)
        predictions.write.mode("overwrite").parquet(f"{args.answers}/predictions")
        refusals.write.mode("overwrite").parquet(f"{args.answers}/refusals")
    clear_scratch(spark)


if __name__ == "__main__":
    main()
