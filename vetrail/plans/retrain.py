"""Monthly retraining: fit on all but the newest year, measure on it, register the challenger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.operators import quality, split, train
from vetrail.sources import sinks


def retrain(
    features: DataFrame,
    names: Sequence[str],
    folder: str,
    version: str,
    trained_on: Date,
    target: str = "target_oai",
    date: str = "inspection_date",
    categories: Sequence[str] = (),
    floor: Mapping[str, float] | None = None,
    min_features: int = quality.MIN_FEATURES,
    **options,
) -> bool:
    """Write the model to ``folder``/<version> and its entry to the registry; tell if promoted.

    The newest year is split off for the measurement only. Early stopping, where asked for by
    ``stop_early=True``, watches the year before it. ``categories`` are coded by codes fitted on the training
    part, which are stored beside the model and named in the registry; their columns come after ``names``.
    With ``floor`` a model that does not pass the gates raises :class:`quality.GateFailed` and is not
    registered. A version that is registered already is refused before anything is fitted.
    """
    spark, registry, path = features.sparkSession, f"{folder}/registry", f"{folder}/{version}"
    train.refuse_known(spark, registry, version)
    stop_early = options.pop("stop_early", False)
    options.setdefault("positive_weight", None)
    codes_path = None
    if categories:
        early, _ = split.rolling_split(features, date)
        codes = split.fit_codes(early, categories)
        codes_path = f"{path}-codes"
        sinks.write_parquet(codes, codes_path)
        features = split.apply_codes(features, codes, categories)
        names = [*names, *[f"{c}_encoded" for c in categories]]
    fit, held = split.rolling_split(features, date)
    valid = None
    if stop_early:
        fit, valid = split.rolling_split(fit, date)
    model = train.fit_boosted_trees(fit, names, target, valid=valid, **options)
    scored = train.score_rows(model, held, names).withColumn("_y", F.col(target).cast("int"))
    measured = train.evaluate(scored, "_y", "risk_score")
    if floor is not None:
        quality.require(quality.model_gates(measured, len(names), floor, min_features))
    metrics = measured.first()
    train.save_model(spark, model, path)
    return train.register_challenger(
        spark, registry, version, path, trained_on, metrics.asDict(), names, categories, codes_path
    )
