"""The transaction model laid over the public sample tables (events, customer, nation, region)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.operators.silver import calendar
from txwatch.plans.medallion import Dimensions

# Sample event types and channels under the model's names.
TYPES = {
    "click": "PIX_OUT",
    "view": "PIX_IN",
    "purchase": "TED",
    "signup": "SAQUE",
    "error": "DEPOSITO",
}
CHANNELS = ("APP", "INTERNET_BANKING", "ATM", "AGENCIA", "API")

# The rules named by the alert of each event type.
ALERT_RULES = {
    "click": "D2_EWMA|M1_ISOLATION_FOREST",
    "view": "D1_CUSUM",
    "purchase": "D5_FRACIONAMENTO",
    "signup": "D3_3SIGMA_HORA",
    "error": "D4_BENFORD|M2_AUTOENCODER",
}


def sample_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _code(prefix: str, number: str, width: int) -> str:
    return f"concat('{prefix}', lpad(cast({number} as string), {width}, '0'))"


def _named(value: str, names: dict[str, str]) -> str:
    arms = " ".join(f"when '{key}' then '{name}'" for key, name in names.items())
    return f"case {value} {arms} end"


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per event, without defects."""
    channels = ", ".join(f"'{c}'" for c in CHANNELS)
    mapped = sample_table(spark, folder, "events").selectExpr(
        "event_id",
        "user_id",
        "ts",
        f"{_named('event_type', TYPES)} as tipo",
        f"element_at(array({channels}), 1 + cast(get_json_object(props, '$.k') as int) % 5) as canal",
        "value * 250.0D as valor",
    )
    typed = mapped.selectExpr(
        "*",
        "canal in ('APP', 'INTERNET_BANKING', 'API') as digital",
        "event_id % 997 = 0 as far",
    )
    marked = typed.selectExpr(
        "*",
        "case when digital and far then 'F4_GEO_OUTLIER' "
        "when valor > 75000 then 'F3_BENFORD_VIOLATION' end as fraude_tipo",
    )
    return marked.selectExpr(
        "concat('T', event_id) as transacao_id",
        "tipo",
        "valor",
        "ts as dt_transacao",
        f"{_code('CT', 'user_id', 10)} as conta_origem",
        f"case when tipo in ('PIX_OUT', 'TED') then {_code('CT', '(event_id * 7919) % 200', 10)} end "
        "as conta_destino",
        # One user in 17 has no row among the members, which exercises the outer join.
        f"{_code('AS', 'user_id + if(user_id % 17 = 0, 9000000, 0)', 7)} as associado_id",
        f"{_code('AG', 'user_id % 27', 4)} as agencia_id",
        f"case when not digital then {_code('OP', 'event_id % 40', 5)} end as operador_id",
        "canal",
        "case when digital then concat('10.0.', event_id % 254, '.', user_id % 254) end as ip_origem",
        "case when digital then if(far, 35.6D, "
        "-16.6D + ((event_id * 31) % 1000 - 500) / 500.0D) end as geo_lat",
        "case when digital then if(far, 139.6D, "
        "-49.3D + ((event_id * 37) % 1000 - 500) / 500.0D) end as geo_lon",
        "ts + interval 1 hour as dt_ingestao",
        "fraude_tipo is not null as fraude_label",
        "fraude_tipo",
    )


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions plus defects for cleaning: deposits delivered twice, zero amounts for
    withdrawals, and ids lost by counter payments."""
    tx = transactions(spark, folder)
    # Each row is delivered one to two times; what is wrong with a copy depends on the data, so cleaning
    # has to look at every row, and there is one scan.
    copies = (
        "explode(concat(array('ok'), if(tipo = 'DEPOSITO', array('again'), array()), "
        "if(tipo = 'SAQUE', array('zero'), array()), "
        "if(tipo = 'TED' and canal = 'AGENCIA', array('lost'), array()))) as _copy"
    )
    changed = {
        "transacao_id": "case _copy when 'zero' then concat('Z', transacao_id) when 'lost' then null "
        "else transacao_id end as transacao_id",
        "valor": "if(_copy = 'zero', valor * 0.0D, valor) as valor",
    }
    return tx.selectExpr("*", copies).selectExpr(*[changed.get(c, c) for c in tx.columns])


def dim_member(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer is a member."""
    customer, nation = (sample_table(spark, folder, t) for t in ("customer", "nation"))
    joined = customer.join(nation, F.expr("c_nationkey = n_nationkey"), "left")
    return joined.selectExpr(
        f"{_code('AS', 'c_custkey', 7)} as associado_id",
        "c_mktsegment as segmento",
        "date_sub(date'2024-01-01', cast((c_custkey * 37) % 7300 as int)) as dt_adesao",
        "case when c_custkey % 11 <> 0 then "
        "least(greatest((10000 - c_acctbal) / 11000, 0.0D), 1.0D) end as score_risco",
        "n_name as uf_residencia",
    )


def dim_branch(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = (sample_table(spark, folder, t) for t in ("nation", "region"))
    joined = nation.join(region, F.expr("n_regionkey = r_regionkey"))
    return joined.selectExpr(
        f"{_code('AG', 'n_nationkey', 4)} as agencia_id",
        "n_name as municipio",
        "r_name as uf",
        "'C' as central",
        "element_at(array('PEQUENO', 'MEDIO', 'GRANDE'), 1 + n_nationkey % 3) as porte",
        "cast(null as string) as endereco",
    )


def dim_operator(spark: SparkSession, folder: str) -> DataFrame:
    """The operators seen in the events."""
    seen = transactions(spark, folder).where("operador_id is not null")
    return seen.select("operador_id").distinct().selectExpr(
        "operador_id",
        "element_at(array('CAIXA', 'GERENTE', 'AUDITOR', 'SUPORTE'), "
        "1 + cast(substring(operador_id, 3) as int) % 4) as funcao",
        f"{_code('AG', 'cast(substring(operador_id, 3) as int) % 25', 4)} as agencia_lotacao",
    )


def dim_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return calendar(sample_table(spark, folder, "events").selectExpr("to_date(ts) as dt"))


def dimensions(spark: SparkSession, folder: str) -> Dimensions:
    return Dimensions(
        dim_member(spark, folder), dim_branch(spark, folder), dim_calendar(spark, folder)
    )


def labelled_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """One alert with an auditor status per event."""
    scored = sample_table(spark, folder, "events").selectExpr(
        "*",
        "least(1.0D, value / 150.0D) as score",
        "cast(get_json_object(props, '$.k') as int) % 4 as slot",
    )
    return scored.selectExpr(
        "concat('A', event_id) as alerta_id",
        "concat('T', event_id) as transacao_id",
        "ts as dt_alerta",
        f"{_named('event_type', ALERT_RULES)} as regra_id",
        "case event_type when 'purchase' then 'PLD' when 'signup' then 'CONTROLE_INTERNO' "
        "else 'FRAUDE' end as familia",
        "case when score < 0.7D then 'BAIXA' when score < 0.85D then 'MEDIA' "
        "when score < 0.95D then 'ALTA' else 'CRITICA' end as severidade",
        "score",
        "concat('Regra ', event_type) as motivo",
        "case when value > 60 then 'CONFIRMADO' when slot = 0 then 'ABERTO' "
        "when slot = 1 then 'EM_ANALISE' else 'FALSO_POSITIVO' end as status",
    )


def labelled_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Seven detector scores per labelled alert, one row each."""
    spread = {
        "D1_CUSUM": 3,
        "D2_EWMA": 7,
        "D3_3SIGMA_HORA": 11,
        "D4_BENFORD": 13,
        "D5_FRACIONAMENTO": 17,
        "M2_AUTOENCODER": 23,
    }
    cells = [f"'{rule}', (event_id * {p}) % 100 / 100.0D" for rule, p in spread.items()]
    cells.append("'M1_ISOLATION_FOREST', least(1.0D, value / 150.0D)")
    return sample_table(spark, folder, "events").selectExpr(
        "concat('A', event_id) as alerta_id",
        f"stack({len(cells)}, {', '.join(cells)}) as (regra_id, score)",
    )


def feedback(spark: SparkSession, folder: str) -> DataFrame:
    """Auditors' verdicts, one per event: up to three on every third alert, none on the others."""
    seen = sample_table(spark, folder, "events").selectExpr("*", "cast(get_json_object(props, '$.k') as int) % 4 as slot")
    return seen.selectExpr(
        "event_id as feedback_id",
        "concat('A', event_id - event_id % 3) as alerta_id",
        "concat('auditor', event_id % 7) as auditor",
        "case when slot = 0 then 'EM_ANALISE' when value * (1 + event_id % 2) > 60 then 'CONFIRMADO' "
        "else 'FALSO_POSITIVO' end as veredito",
        "ts + interval 1 day as dt_veredito",
    )
