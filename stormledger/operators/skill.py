"""How good the forecasts were."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.flags import hail_flag, wind_flag
from ..functions.scores import pearson, skill, tally
from .coverage import with_thresholds

# Fixed label of the scored rule and fixed cutoffs of the sweep.
COMBO_MODEL = "COMBO(W OR H)"
SWEEP_CUTOFFS = (0.01, 0.03, 0.05, 0.10, 0.15, 0.20)


def scorable(master: DataFrame, cfg: Config) -> DataFrame:
    """Rows with enough readings and a configured lead."""
    return master.where(
        (F.col("samples_in_block") >= cfg.min_samples_per_block) & F.col("lead_hours").isin(*cfg.lead_hours)
    )


def lead_performance(master: DataFrame, thresholds: DataFrame, cfg: Config) -> DataFrame:
    """Confusion counts, precision, recall and F1 of the wind-or-hail rule per county and lead."""
    flag = wind_flag() | hail_flag(cfg)
    truth = F.col("outage_ratio_6h_max") >= F.lit(cfg.outage_threshold)
    return (
        with_thresholds(scorable(master, cfg), thresholds)
        .select("county_fips", "lead_hours", flag.alias("flag"), truth.alias("truth"))
        .groupBy("county_fips", "lead_hours")
        .agg(F.count(F.lit(1)).alias("n_scored"), *tally(F.col("flag"), F.col("truth")))
        .select(
            F.lit(COMBO_MODEL).alias("model"),
            "county_fips", "lead_hours", "n_scored", "TP", "FP", "FN", "TN", *skill(),
        )
    )


def correlations(master: DataFrame, cfg: Config) -> DataFrame:
    """Pearson correlation of the block's peak outage with each ingredient, per county and lead."""
    against = {
        "r_ws10": "ws10_max_mps",
        "r_ws925": "ws925_max_mps",
        "r_shear": "shear_0_6km_max_mps",
        "r_updraft": "updraft700_pos_max_pas",
        "r_precip": "tp6_mm_max",
        "r_t700": "t700_c_min",
    }
    outage = F.col("outage_ratio_6h_max")
    return (
        scorable(master, cfg)
        .groupBy("county_fips", "lead_hours")
        .agg(
            F.count(F.lit(1)).alias("n_scored"),
            *[pearson(outage, F.col(x)).alias(name) for name, x in against.items()],
        )
    )


def threshold_sweep(predictions: DataFrame) -> DataFrame:
    """Skill of a predicted ratio at fixed cutoffs, each applied to prediction and truth alike."""
    cutoff = F.col("threshold")
    return (
        predictions.select(
            "predicted_ratio", "actual_ratio",
            F.explode(F.array(*[F.lit(c) for c in SWEEP_CUTOFFS])).alias("threshold"),
        )
        .groupBy("threshold")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *tally(F.col("predicted_ratio") >= cutoff, F.col("actual_ratio") >= cutoff),
        )
        .select("threshold", "n", "TP", "FP", "FN", "TN", *skill())
        .orderBy("threshold")
    )
