"""Champion/challenger decisions over metric and registry tables.

Runs and models are rows, so any number of models is gated in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Stage names, alias, required precision share and the reason texts.
PRODUCTION, ARCHIVED, CHAMPION = "Production", "Archived", "champion"
MIN_PRECISION_RATIO = 0.95
REASON_FIRST = "No champion model, promoting as first production model"
REASON_RECALL = "Challenger Recall (%.4f) < Champion (%.4f)"
REASON_PRECISION = "Challenger Precision (%.4f) < Min required (%.4f)"
REASON_PROMOTE = "Recall: %.4f >= %.4f | Precision: %.4f >= %.4f"

PROMOTION_METRICS = ["auprc", "recall", "precision"]


def run_metrics(long: DataFrame) -> DataFrame:
    """Named run metrics from rows ``(run_id, position, model, split, metric, value)``.

    Every value is named ``<model>_<split>_<metric>``; the best model by validation average
    precision (the lowest position among equals) adds its plain validation metrics.
    """
    slug = F.replace(F.lower("model"), F.lit(" "), F.lit("_"))
    named = long.select(
        "run_id", F.concat_ws("_", slug, F.col("split"), F.col("metric")).alias("name"), "value"
    )
    val = (
        long.where((F.col("split") == "val") & F.col("metric").isin(PROMOTION_METRICS))
        .groupBy("run_id", "model", "position")
        .pivot("metric", PROMOTION_METRICS)
        .agg(F.first("value"))
    )
    best = val.groupBy("run_id").agg(
        F.max_by(
            F.struct(*PROMOTION_METRICS), F.struct(F.col("auprc"), -F.col("position"))
        ).alias("b")
    )
    plain = best.select(
        "run_id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("name"), F.col(f"b.{m}").alias("value"))
                    for n, m in [
                        ("best_val_auprc", "auprc"),
                        ("val_recall", "recall"),
                        ("val_precision", "precision"),
                        ("val_auprc", "auprc"),
                    ]
                ]
            )
        ),
    )
    return named.unionByName(plain)


def promotion_metrics(metrics: DataFrame) -> DataFrame:
    """One row per run ``(run_id, val_auprc, val_recall, val_precision, auprc, recall, precision)``.

    ``metrics`` has ``(run_id, name, value[, position])``. Plain names are kept for runs that have no others. Runs with plain validation recall and precision keep
    them. For others the per-model names are grouped: complete triples come before incomplete ones,
    then the highest average precision, then the model whose metrics come first (by ``position``, if the
    table has one, then by name); plain values still take precedence.
    """
    position = F.col("position") if "position" in metrics.columns else F.lit(0)
    parsed = metrics.select(
        position.cast("long").alias("position"),
        "run_id",
        "name",
        "value",
        F.regexp_extract("name", r"^(.*)_val_(auprc|recall|precision)$", 1).alias("model"),
        F.regexp_extract("name", r"^(.*)_val_(auprc|recall|precision)$", 2).alias("metric"),
    )
    plain = parsed.groupBy("run_id").agg(
        *[F.max(F.when(F.col("name") == f"val_{m}", F.col("value"))).alias(f"plain_{m}") for m in PROMOTION_METRICS],
        *[F.max(F.when(F.col("name") == m, F.col("value"))).alias(m) for m in PROMOTION_METRICS],
    )
    per_model = (
        parsed.where((F.col("metric") != "") & (F.col("model") != "best"))
        .groupBy("run_id", "model")
        .agg(
            F.min("position").alias("position"),
            *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in PROMOTION_METRICS],
        )
    )
    complete = F.col("auprc").isNotNull() & F.col("recall").isNotNull() & F.col("precision").isNotNull()
    zeroed = [F.coalesce(m, F.lit(0.0)).alias(m) for m in PROMOTION_METRICS]
    # The smallest entry: complete first, high precision average first, then by name.
    best = per_model.groupBy("run_id").agg(
        F.min_by(
            F.struct(*zeroed), F.struct((~complete).alias("c"), (-F.coalesce("auprc", F.lit(0.0))).alias("a"), "position", "model")
        ).alias("best")
    )
    settled = F.col("plain_recall").isNotNull() & F.col("plain_precision").isNotNull()
    return plain.join(best, "run_id", "left").select(
        "run_id",
        *[
            F.when(settled, F.col(f"plain_{m}"))
            .otherwise(F.coalesce(f"plain_{m}", F.col(f"best.{m}")))
            .alias(f"val_{m}")
            for m in PROMOTION_METRICS
        ],
        *PROMOTION_METRICS,
    )


def _either(df_prefix: str, columns: list[str], metric: str) -> Column:
    """``val_<metric>``, else ``<metric>``, else 0."""
    options = [F.col(f"{df_prefix}{n}") for n in (f"val_{metric}", metric) if n in columns]
    return F.coalesce(*options, F.lit(0.0))


def promotion_gate(
    challengers: DataFrame, champions: DataFrame, min_precision_ratio: float = MIN_PRECISION_RATIO
) -> DataFrame:
    """``(model_name, promoted, reason)`` plus the compared figures, one row per challenger.

    Recall must not fall, precision must reach its share of the champion's; a model without a
    champion is promoted.
    """
    metric_columns = [n for m in ("recall", "precision") for n in (f"val_{m}", m)]
    mine = [c for c in metric_columns if c in challengers.columns]
    theirs = [c for c in metric_columns if c in champions.columns]
    left = challengers.select("model_name", *[F.col(c).alias(f"ch_{c}") for c in mine])
    right = champions.select(
        "model_name", F.lit(True).alias("has_champion"), *[F.col(c).alias(f"cp_{c}") for c in theirs]
    )
    joined = left.join(right, "model_name", "left").select(
        "model_name",
        F.coalesce("has_champion", F.lit(False)).alias("has_champion"),
        _either("ch_", mine, "recall").alias("challenger_recall"),
        _either("ch_", mine, "precision").alias("challenger_precision"),
        _either("cp_", theirs, "recall").alias("champion_recall"),
        (_either("cp_", theirs, "precision") * min_precision_ratio).alias("required_precision"),
    )
    recall_low = F.col("challenger_recall") < F.col("champion_recall")
    precision_low = F.col("challenger_precision") < F.col("required_precision")
    recalls = ["challenger_recall", "champion_recall"]
    precisions = ["challenger_precision", "required_precision"]
    return joined.select(
        "model_name",
        (~F.col("has_champion") | (~recall_low & ~precision_low)).alias("promoted"),
        F.when(~F.col("has_champion"), F.lit(REASON_FIRST))
        .when(recall_low, F.format_string(REASON_RECALL, *recalls))
        .when(precision_low, F.format_string(REASON_PRECISION, *precisions))
        .otherwise(F.format_string(REASON_PROMOTE, *recalls, *precisions))
        .alias("reason"),
        *recalls,
        *precisions,
    )


def champion_versions(registry: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """``(model_name, version, run_id)`` of the champion per model.

    A version carrying the champion alias (and a run) wins; otherwise it is the latest version in
    the stage. Models whose choice has no run have no champion.
    """
    aliased = F.coalesce((F.col("alias") == CHAMPION) & F.col("run_id").isNotNull(), F.lit(False))
    choice = F.struct(aliased, F.col("version"))
    return (
        registry.where(aliased | (F.col("stage") == stage))
        .groupBy("model_name")
        .agg(F.max_by(F.struct("version", "run_id"), choice).alias("c"))
        .select("model_name", "c.version", "c.run_id")
        .where(F.col("run_id").isNotNull())
    )


def champion_metrics(registry: DataFrame, metrics: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """Normalised run metrics of every champion; a champion whose run has none keeps its row."""
    return champion_versions(registry, stage).join(promotion_metrics(metrics), "run_id", "left")


def apply_promotions(registry: DataFrame, promoted: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """The registry after registering ``promoted`` ``(model_name, run_id)`` in ``stage``.

    New versions follow the highest one; several runs of one model are numbered by run. In production, versions already there are archived
    and the champion alias moves.
    """
    latest = registry.groupBy("model_name").agg(F.max("version").alias("latest"))
    # Few rows: promotions, not transactions. The last of a model's runs carries the alias.
    runs = Window.partitionBy("model_name").orderBy("run_id")
    backwards = Window.partitionBy("model_name").orderBy(F.desc("run_id"))
    numbered = promoted.withColumns({"_nth": F.row_number().over(runs), "_last": F.row_number().over(backwards) == 1})
    in_stage = F.when(F.col("_last") | F.lit(stage != PRODUCTION), F.lit(stage)).otherwise(F.lit(ARCHIVED))
    new = numbered.join(latest, "model_name", "left").select(
        "model_name",
        (F.coalesce("latest", F.lit(0)) + F.col("_nth")).cast(registry.schema["version"].dataType).alias("version"),
        in_stage.alias("stage"),
        F.when(F.col("_last") & F.lit(stage == PRODUCTION), F.lit(CHAMPION)).alias("alias"),
        "run_id",
    )
    if stage != PRODUCTION:
        return registry.select(*new.columns).unionByName(new)
    touched = promoted.select("model_name", F.lit(True).alias("_touched")).distinct()
    demoted = F.col("_touched").isNotNull()
    kept = registry.join(touched, "model_name", "left").select(
        "model_name",
        "version",
        F.when(demoted & (F.col("stage") == stage), F.lit(ARCHIVED)).otherwise(F.col("stage")).alias("stage"),
        F.when(~(demoted & F.coalesce(F.col("alias") == CHAMPION, F.lit(False))), F.col("alias")).alias("alias"),
        "run_id",
    )
    return kept.unionByName(new)
