"""Natural keys to surrogate ids on the incoming requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import stored_hours
from ..schemas import COMPLAINT_KEY, FACT, FACT_COLUMNS, LOCATION_KEY
from .dimensions import normalized_complaint, normalized_location


def resolve_keys(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with four ids; a request without agency keeps a null agency id.

    Both sides of the composite keys are normalized the same way. Dimensions are
    read from Parquet, so Catalyst knows their size: small ones are broadcast, a
    large one falls back to a shuffled join under AQE.
    """
    wide = normalized_complaint(normalized_location(df)).withColumns(
        {"full_date": F.to_date("created_date"), "agency_code": F.col("agency")}
    )
    keyed = (
        wide.join(dims["dim_date"].select("date_id", "full_date"), ["full_date"], "left")
        .join(dims["dim_agency"], ["agency_code"], "left")
        .join(dims["dim_complaint_type"], COMPLAINT_KEY, "left")
        .join(dims["dim_location"], LOCATION_KEY, "left")
        .withColumn("resolution_time_in_hours", stored_hours(F.col("resolution_time_in_hours")))
    )
    kinds = {f.name: f.dataType for f in FACT}
    present = [c for c in FACT_COLUMNS if c in keyed.columns]
    return keyed.select(*[F.col(c).cast(kinds[c]) for c in present])
