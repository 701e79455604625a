"""Feature specifications and model signatures."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are features, which is the target and which the row ID."""

    features: tuple[str, ...]
    target: str
    id_col: str

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features))

    @property
    def layer_columns(self) -> list[str]:
        """Bronze / silver expected columns: features, target, ID."""
        return [*self.features, self.target, self.id_col]

    @property
    def gold_columns(self) -> list[str]:
        """Gold column order: features, then target, then ID."""
        return [*self.features, self.target, self.id_col]


# The regression table the rebuild derives from ``lineitem``.
LINEITEM_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
LINEITEM_SPEC = FeatureSpec(LINEITEM_FEATURES, "revenue", "row_id")


def signature(df: DataFrame, spec: FeatureSpec, output: str = "prediction") -> dict:
    """Input / output signature of a model fitted on ``df``."""
    fields = {f.name: f for f in df.schema.fields}
    inputs = T.StructType([T.StructField(c, fields[c].dataType, True) for c in spec.features])
    outputs = T.StructType([T.StructField(output, T.DoubleType(), True)])
    return {"inputs": json.loads(inputs.json()), "outputs": json.loads(outputs.json())}


def signature_json(sig: dict) -> str:
    return json.dumps(sig, sort_keys=True)


def check_signature(df: DataFrame, sig: dict) -> None:
    """Raise when ``df`` lacks an input column or has it with another type."""
    inputs = T.StructType.fromJson(sig["inputs"])
    fields = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(f.name for f in inputs.fields if f.name not in fields)
    if missing:
        raise ValueError(f"Signature check failed. Missing columns: {missing}")
    wrong = sorted(
        f"{f.name}: expected {f.dataType.simpleString()}, got {fields[f.name].simpleString()}"
        for f in inputs.fields
        if fields[f.name] != f.dataType
    )
    if wrong:
        raise ValueError(f"Signature check failed. Type mismatch: {wrong}")
