"""Batch audit plans: fixture views -> items -> groups -> versioned results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.reduce import reduce_items, with_single_page
from ..session import spread


def groups_from_view(items: DataFrame) -> DataFrame:
    """Groups of the ``items`` view (one page per item), with what their origin and their batch tell.

    The page count of a batch (lot_id, origen; M3) is the sum of its groups' items: a
    window over the groups, on the exchange and in the order that the reduce has
    already, and not planned where no one reads it.
    """
    batch = Window.partitionBy("lot_id", "origen")
    groups = reduce_items(with_single_page(spread(items, "lot_id", "origen")), count_as="_items")
    tipo = F.when(F.lower("origen").endswith(".pdf"), F.lit(C.ORIGIN_TYPE_PDF)).otherwise(F.lit(C.ORIGIN_TYPE_IMAGES))
    return groups.withColumns({"tipo_origen": tipo, "paginas_original": F.sum("_items").over(batch).cast("int")}) \
        .drop("_items")
