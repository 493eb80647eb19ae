"""Column contracts of the stored tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_REQUIRED = {"transacao_id", "tipo", "valor", "dt_transacao", "associado_id", "agencia_id", "canal"}


def _fields(spec: dict[str, object]) -> StructType:
    return StructType([StructField(n, t, n not in _REQUIRED) for n, t in spec.items()])


# What producers drop as JSON: instants with a zone, read in the session zone.
TRANSACTION_STREAM = _fields(
    {
        "transacao_id": StringType(),
        "tipo": StringType(),
        "valor": DoubleType(),
        "dt_transacao": TimestampType(),
        "conta_origem": StringType(),
        "conta_destino": StringType(),
        "associado_id": StringType(),
        "agencia_id": StringType(),
        "operador_id": StringType(),
        "canal": StringType(),
        "ip_origem": StringType(),
        "geo_lat": DoubleType(),
        "geo_lon": DoubleType(),
        "dt_ingestao": TimestampType(),
        "fraude_label": BooleanType(),
        "fraude_tipo": StringType(),
    }
)

# The same 16 columns as batch operators see them: wall-clock time without a zone.
TRANSACTION_COLUMNS = TRANSACTION_STREAM.fieldNames()

ALERTS = StructType(
    [
        StructField("alerta_id", StringType()),
        StructField("transacao_id", StringType()),
        StructField("dt_alerta", TimestampNTZType()),
        StructField("regra_id", StringType()),
        StructField("familia", StringType()),
        StructField("severidade", StringType()),
        StructField("score", DoubleType()),
        StructField("motivo", StringType()),
        StructField("status", StringType()),
    ]
)

# The row every detector emits, next to its own key columns.
FINDING_COLUMNS = ("regra_id", "familia", "alerta", "score", "motivo")

FINDINGS = StructType(
    [
        StructField("entidade", StringType()),
        StructField("regra_id", StringType()),
        StructField("familia", StringType()),
        StructField("alerta", BooleanType()),
        StructField("score", DoubleType()),
        StructField("motivo", StringType()),
    ]
)
