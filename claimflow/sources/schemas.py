"""Declared schemas; nothing on the way in is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..fixed_values import (
    CATEGORICAL_FEATURES,
    CURATED_COLUMNS,
    CURATED_INTEGERS,
    EVALUATION_INPUTS,
    LANDING_PARTITION,
    RAW_COLUMNS,
)


def _text(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


RAW_SCHEMA = _text(RAW_COLUMNS)
_lower = [c.lower() for c in RAW_COLUMNS]
LANDING_SCHEMA = _text([c for c in _lower if c != LANDING_PARTITION] + [LANDING_PARTITION])
CURATED_SCHEMA = StructType(
    [StructField(c, IntegerType() if c in CURATED_INTEGERS else StringType(), True) for c in CURATED_COLUMNS]
)

_FORM_DERIVED = {
    "rango_precio_vehiculo", "dias_poliza_accidente", "reclamos_pasados", "semana_accidente", "semana_reclamo",
}
_FORM_TEXT = set(CATEGORICAL_FEATURES) | {
    "cambio_direccion", "antiguedad_vehiculo", "edad_titular", "numero_suplementos", "tipo_agente",
}


def _form_type(name: str):
    if name == "valor_estimado_vehiculo":
        return DoubleType()
    return StringType() if name in _FORM_TEXT else IntegerType()


# A scoring form: plain values and dates; bands and weeks are derived from them.
FORM_SCHEMA = (
    StructType(
        [StructField("case_id", StringType(), False)]
        + [StructField(n, _form_type(n), True) for n in EVALUATION_INPUTS if n not in _FORM_DERIVED]
    )
    .add("fecha_accidente", StringType())
    .add("fecha_reclamo", StringType())
)

FEEDBACK_SCHEMA = "case_id long, fecha_validacion timestamp_ntz, label int, event_id long"


def require_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in declared order; a missing or retyped one is an error."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"missing or of another type: {', '.join(wrong)}")
    return df.select(*schema.fieldNames())
