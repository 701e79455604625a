"""Layered tables: sources, IDs, bronze / silver / gold, reads and writes."""

from tablefit.sources.layers import (  # noqa: F401
    attach_target,
    bronze,
    gold,
    gold_select,
    normalise_columns,
    read_layer,
    read_table,
    sequential_id,
    silver,
    silver_dropna,
    write_layer,
)
from tablefit.sources.tables import lineitem_regression, load, null_injected  # noqa: F401
