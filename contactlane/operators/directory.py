"""Account directory: build it, and flag records whose id it knows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import joins

ACTIVE = "ACTIVE"


def build_directory(ids: DataFrame, id_col: str = "sap_id", as_of=None) -> DataFrame:
    """Distinct upper-cased ids (NULLs dropped), status ``ACTIVE``, stamped.

    Ids are upper-cased only -- neither trimmed nor validated -- and the
    constants are added after the distinct so it runs on the id alone.
    """
    stamp = as_of if as_of is not None else F.current_timestamp()
    return (ids.where(F.col(id_col).isNotNull())
            .select(F.upper(F.col(id_col)).alias("sap_id")).distinct()
            .withColumns({"account_status": F.lit(ACTIVE), "last_updated": stamp}))


def with_directory_flag(df: DataFrame, directory: DataFrame,
                        key: str = "normalized_sap_id", out: str = "sap_exists",
                        directory_key: str = "sap_id", filtered: bool = False) -> DataFrame:
    """``df`` plus ``out``: the (normalised) id is in the directory. Row count
    is preserved; a NULL id gives ``false``. ``filtered``: ids that a bitmap of the
    directory rules out are not shuffled (for a stored ``df``, which is read twice)."""
    flag = joins.exists_flag_filtered if filtered else joins.exists_flag
    return flag(df, directory, key, directory_key, out)
