"""Measures over billing rows joined with their meters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.money import as_double
from tidegauge.operators.measures import by_groups, differs, distinct_values, filtered, is_false, or_zero, ratio, rows

# Fixed values of the billing export.
PAUSE = "Capacity Pause/Delete Surcharge"
RESERVATION = "Reservation"


def measures(
    df: DataFrame, by: Sequence[str], storage: str, autoscale: str, recovery: str, mirroring: str = "mirror"
) -> DataFrame:
    """All cost measures per group.

    ``storage`` is a meter category, ``autoscale`` a meter name, ``recovery`` and ``mirroring`` are
    texts searched in meter names, ignoring case.
    """
    cost, saved = F.col("EffectiveCost"), F.col("ContractedCost") - F.col("EffectiveCost")
    included, reserved = F.col("Included"), F.col("CommitmentDiscountType") == RESERVATION
    not_reserved = differs(F.col("CommitmentDiscountType"), RESERVATION)

    def named(text: str):
        return F.contains(F.upper("MeterName"), F.lit(text.upper()))

    parts = dict(
        TotalCost=F.sum(cost),
        AvailableCapacity=filtered(F.sum, cost, F.col("Main")),
        ProvisionedCapacity=filtered(F.sum, cost, included),
        PauseCost=filtered(F.sum, cost, F.col("BillingType") == PAUSE),
        _payg=filtered(F.sum, cost, included & not_reserved),
        Reservation=filtered(F.sum, cost, included & reserved),
        Storage=filtered(F.sum, cost, (F.col("MeterCategory") == storage) & is_false(included)),
        AutoScale=filtered(F.sum, cost, F.col("MeterName") == autoscale),
        RecoveryCost=filtered(F.sum, cost, named(recovery)),
        MirroringCost=filtered(F.sum, cost, named(mirroring)),
        _saved=F.sum(saved),
        Rows=rows(),
    )
    # Rows are added up per resource and region first, so that the two distinct counts copy the few
    # sums instead of every billing row.
    inner = by_groups(df, list(dict.fromkeys([*by, "ResourceName", "RegionName"])), **parts)
    zero = ("PauseCost", "Reservation", "AutoScale", "RecoveryCost", "MirroringCost")
    sums = by_groups(
        inner,
        by,
        **{n: or_zero(F.sum(n)) if n in zero else F.sum(n) for n in parts},
        Capacities=distinct_values(F.col("ResourceName")),
        Regions=distinct_values(F.col("RegionName")),
    )
    exact = sums.withColumns(
        {
            "CapacityPAYG": F.coalesce("_payg", F.lit(0)) - F.col("PauseCost"),
            "OtherPAYG": F.col("PauseCost") + F.col("AutoScale"),
            "CostWithoutCommitment": F.col("_saved") + F.col("TotalCost"),
            "CommitmentSavings": F.when(F.col("_saved") > 1, F.col("_saved")).otherwise(F.lit(0)),
            "UsedCapacity": F.col("ProvisionedCapacity") - F.coalesce("AvailableCapacity", F.lit(0)),
        }
    ).drop("_payg", "_saved")
    counts = {"Capacities", "Regions", "Rows", *by}
    out = exact.select(*[F.col(c) if c in counts else as_double(F.col(c)).alias(c) for c in exact.columns])
    return out.withColumns(
        {
            "UsageRatio": ratio(F.col("UsedCapacity"), F.col("ProvisionedCapacity")),
            "ReservationShare": ratio(F.col("Reservation"), F.col("TotalCost")),
            "AutoScaleShare": ratio(F.col("AutoScale"), F.col("TotalCost")),
            "PauseShare": ratio(F.col("PauseCost"), F.col("CapacityPAYG")),
        }
    )
