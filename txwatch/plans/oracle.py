"""SQL counterparts of the catalogue queries, written for DuckDB over the same sample tables.

The control charts are spelled as recursions here, which checks the closed forms of the Spark side.
"""

from __future__ import annotations

from txwatch.plans import oracle_learned as learned

# --- shared table expressions ------------------------------------------------------------------

_TX = """
mapped AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS slot FROM events
), tx AS (
  SELECT
    'T' || event_id AS transacao_id,
    CASE event_type WHEN 'click' THEN 'PIX_OUT' WHEN 'view' THEN 'PIX_IN' WHEN 'purchase' THEN 'TED'
                    WHEN 'signup' THEN 'SAQUE' WHEN 'error' THEN 'DEPOSITO' END AS tipo,
    value * 250.0e0 AS valor,
    ts AS dt_transacao,
    'CT' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS conta_origem,
    CASE WHEN event_type IN ('click', 'purchase')
         THEN 'CT' || lpad(CAST((event_id * 7919) % 200 AS VARCHAR), 10, '0') END AS conta_destino,
    'AS' || lpad(CAST(user_id + CASE WHEN user_id % 17 = 0 THEN 9000000 ELSE 0 END AS VARCHAR), 7, '0') AS associado_id,
    'AG' || lpad(CAST(user_id % 27 AS VARCHAR), 4, '0') AS agencia_id,
    CASE WHEN slot IN (2, 3) THEN 'OP' || lpad(CAST(event_id % 40 AS VARCHAR), 5, '0') END
      AS operador_id,
    CASE slot WHEN 0 THEN 'APP' WHEN 1 THEN 'INTERNET_BANKING' WHEN 2 THEN 'ATM'
              WHEN 3 THEN 'AGENCIA' WHEN 4 THEN 'API' END AS canal,
    CASE WHEN slot IN (0, 1, 4)
         THEN '10.0.' || (event_id % 254) || '.' || (user_id % 254) END AS ip_origem,
    CASE WHEN slot IN (0, 1, 4) THEN CASE WHEN event_id % 997 = 0 THEN 35.6e0
         ELSE -16.6e0 + ((event_id * 31) % 1000 - 500) / 500.0e0 END END AS geo_lat,
    CASE WHEN slot IN (0, 1, 4) THEN CASE WHEN event_id % 997 = 0 THEN 139.6e0
         ELSE -49.3e0 + ((event_id * 37) % 1000 - 500) / 500.0e0 END END AS geo_lon,
    ts + INTERVAL 1 HOUR AS dt_ingestao,
    CASE WHEN slot IN (0, 1, 4) AND event_id % 997 = 0 THEN 'F4_GEO_OUTLIER'
         WHEN value * 250.0e0 > 75000 THEN 'F3_BENFORD_VIOLATION' END AS fraude_tipo
  FROM mapped
), labelled_tx AS (
  SELECT *, fraude_tipo IS NOT NULL AS fraude_label FROM tx
), bronze AS (
  SELECT * FROM labelled_tx
  UNION ALL SELECT * FROM labelled_tx WHERE tipo = 'DEPOSITO'
  UNION ALL SELECT * REPLACE ('Z' || transacao_id AS transacao_id, 0.0e0 AS valor)
            FROM labelled_tx WHERE tipo = 'SAQUE'
  UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS transacao_id)
            FROM labelled_tx WHERE tipo = 'TED' AND canal = 'AGENCIA'
)"""

_CLEAN = f"""{_TX}, clean AS (
  SELECT * EXCLUDE (copy_no) FROM (
    SELECT *, row_number() OVER (PARTITION BY transacao_id ORDER BY dt_ingestao) AS copy_no
    FROM bronze
    WHERE transacao_id IS NOT NULL AND valor > 0 AND dt_transacao IS NOT NULL)
  WHERE copy_no = 1
)"""


def _digit(value: str) -> str:
    return (
        f"try_cast(substr(regexp_replace(CAST({value} AS VARCHAR), '[^1-9]', '', 'g'), 1, 1) "
        "AS BIGINT)"
    )


_DATED = f"""{_CLEAN}, dated AS (
  SELECT *, CAST(dt_transacao AS DATE) AS dt, hour(dt_transacao) AS hora,
         isodow(dt_transacao) - 1 AS dia_semana, {_digit('valor')} AS primeiro_digito
  FROM clean
)"""


def _calendar(name: str, source: str) -> str:
    return f"""{name}_span AS (SELECT min(d) AS a, max(d) AS b FROM ({source})),
{name}_days AS (
  SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY))
              AS DATE) AS dt FROM {name}_span
), {name} AS (
  SELECT dt, year(dt) AS ano, month(dt) AS mes, isodow(dt) - 1 AS dia_semana,
         (month(dt) * 100 + day(dt)) IN (101, 421, 501, 907, 1012, 1102, 1115, 1225) AS feriado,
         isodow(dt) < 6 AND (month(dt) * 100 + day(dt))
           NOT IN (101, 421, 501, 907, 1012, 1102, 1115, 1225) AS dia_util
  FROM {name}_days
)"""


_DIMS = f"""{_calendar('cal', 'SELECT CAST(ts AS DATE) AS d FROM events')},
member AS (
  SELECT 'AS' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS associado_id,
         c_mktsegment AS segmento,
         DATE '2024-01-01' - CAST((c_custkey * 37) % 7300 AS INTEGER) AS dt_adesao,
         CASE WHEN c_custkey % 11 <> 0
              THEN least(greatest((10000 - c_acctbal) / 11000, 0.0e0), 1.0e0) END AS score_risco,
         n_name AS uf_residencia
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), branch AS (
  SELECT 'AG' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS agencia_id, n_name AS municipio,
         r_name AS uf,
         CASE n_nationkey % 3 WHEN 0 THEN 'PEQUENO' WHEN 1 THEN 'MEDIO' ELSE 'GRANDE' END AS porte
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_SILVER = f"""{_DATED}, {_DIMS}, silver AS (
  SELECT t.*, m.* EXCLUDE (associado_id), b.* EXCLUDE (agencia_id), c.ano, c.mes, c.dia_util,
         c.feriado,
         hora < 6 OR hora >= 22 AS flag_fora_horario,
         NOT coalesce(c.dia_util, TRUE) AS flag_fim_de_semana,
         valor > 50000 AS flag_valor_alto,
         valor > 100000 AND canal <> 'AGENCIA' AS flag_alta_alcada
  FROM dated t
  LEFT JOIN member m USING (associado_id)
  LEFT JOIN branch b USING (agencia_id)
  LEFT JOIN cal c USING (dt)
)"""

_BRANCH_DAY = """
SELECT agencia_id, CAST(dt AS VARCHAR) AS dt, count(*) AS qtd_tx,
       round(sum(valor), 6) AS valor_total, round(avg(valor), 6) AS valor_medio,
       count(*) FILTER (WHERE flag_fora_horario) AS qtd_fora_horario,
       count(*) FILTER (WHERE flag_valor_alto) AS qtd_valor_alto
FROM silver GROUP BY agencia_id, dt"""

_BRONZE_SHOWN = """transacao_id, tipo, round(valor, 6) AS valor,
       strftime(dt_transacao, '%Y-%m-%d %H:%M:%S.%f') AS dt_transacao, conta_origem, conta_destino,
       associado_id, agencia_id, operador_id, canal, ip_origem, round(geo_lat, 6) AS geo_lat,
       round(geo_lon, 6) AS geo_lon,
       strftime(dt_ingestao, '%Y-%m-%d %H:%M:%S.%f') AS dt_ingestao, fraude_label, fraude_tipo"""

_SILVER_SHOWN = """transacao_id, associado_id, agencia_id, round(valor, 6) AS valor, CAST(dt AS VARCHAR) AS dt, hora,
       dia_semana, primeiro_digito, segmento, CAST(dt_adesao AS VARCHAR) AS dt_adesao,
       round(score_risco, 6) AS score_risco, uf_residencia, municipio, uf, porte, ano, mes,
       dia_util, feriado, flag_fora_horario, flag_fim_de_semana, flag_valor_alto, flag_alta_alcada"""


# --- detectors ---------------------------------------------------------------------------------


def _cusum(source: str, key: str, limit: float) -> str:
    """`source` selects key, dt, x. Yields cusum_rows with the two recursions."""
    return f"""
cu_in AS ({source}), cu_stat AS (
  SELECT *, avg(x) OVER (PARTITION BY {key}) AS mu0,
         CASE WHEN stddev_samp(x) OVER (PARTITION BY {key}) > 0
              THEN stddev_samp(x) OVER (PARTITION BY {key}) ELSE 1.0e0 END AS sigma,
         row_number() OVER (PARTITION BY {key} ORDER BY dt) AS i
  FROM cu_in
), cu_walk AS (
  SELECT {key}, i, greatest(0.0e0, x - mu0 - 0.5e0 * sigma) AS s_h,
         least(0.0e0, x - mu0 + 0.5e0 * sigma) AS s_l
  FROM cu_stat WHERE i = 1
  UNION ALL
  SELECT s.{key}, s.i, greatest(0.0e0, w.s_h + x - mu0 - 0.5e0 * sigma),
         least(0.0e0, w.s_l + x - mu0 + 0.5e0 * sigma)
  FROM cu_walk w JOIN cu_stat s ON s.{key} = w.{key} AND s.i = w.i + 1
), cusum_rows AS (
  SELECT s.{key}, s.dt, s.x, s.mu0, s.sigma, w.s_h, w.s_l,
         w.s_h > {limit}e0 * s.sigma OR w.s_l < -{limit}e0 * s.sigma AS alerta
  FROM cu_stat s JOIN cu_walk w ON s.{key} = w.{key} AND s.i = w.i
)"""


def _shown(value: str, exact: bool) -> str:
    return value if exact else f"round({value}, 6)"


def _cusum_findings(key: str, exact: bool = False) -> str:
    score = _shown(
        "least(greatest(abs(s_h - s_l) / greatest(sigma * 5.0e0, 1.0e0), 0.0e0), 1.0e0)", exact
    )
    return f"""
SELECT {key}, CAST(dt AS VARCHAR) AS dt, 'D1_CUSUM' AS regra_id, 'FRAUDE' AS familia, alerta,
       {score} AS score,
       CASE WHEN alerta THEN 'CUSUM fora dos limites em ' || {key} END AS motivo
FROM cusum_rows"""


def _ewma(source: str, key: str) -> str:
    return f"""
ew_in AS ({source}), ew_stat AS (
  SELECT *, avg(x) OVER (PARTITION BY {key}) AS mu0,
         CASE WHEN stddev_samp(x) OVER (PARTITION BY {key}) > 0
              THEN stddev_samp(x) OVER (PARTITION BY {key}) ELSE 1.0e0 END AS sigma,
         row_number() OVER (PARTITION BY {key} ORDER BY dt) AS i,
         count(*) OVER (PARTITION BY {key}) AS n
  FROM ew_in
), ew_walk AS (
  SELECT {key}, i, 0.2e0 * x + 0.8e0 * mu0 AS z FROM ew_stat WHERE i = 1 AND n >= 5
  UNION ALL
  SELECT s.{key}, s.i, 0.2e0 * s.x + 0.8e0 * w.z
  FROM ew_walk w JOIN ew_stat s ON s.{key} = w.{key} AND s.i = w.i + 1
), ew_limit AS (
  SELECT s.{key}, s.dt, s.x, s.i, w.z,
         mu0 + 3.0e0 * sigma * sqrt(0.2e0 / 1.8e0 * (1 - pow(0.8e0, 2 * s.i))) AS superior,
         mu0 - 3.0e0 * sigma * sqrt(0.2e0 / 1.8e0 * (1 - pow(0.8e0, 2 * s.i))) AS inferior
  FROM ew_stat s JOIN ew_walk w ON s.{key} = w.{key} AND s.i = w.i
), ewma_rows AS (SELECT *, z > superior OR z < inferior AS alerta FROM ew_limit)"""


def _ewma_findings(key: str, exact: bool = False) -> str:
    score = _shown(
        "least(abs(z - (superior + inferior) / 2) "
        "/ (greatest(superior - inferior, 1e-9) / 2), 1.0e0)",
        exact,
    )
    return f"""
SELECT {key}, CAST(dt AS VARCHAR) AS dt, 'D2_EWMA' AS regra_id, 'FRAUDE' AS familia, alerta,
       {score} AS score,
       CASE WHEN alerta THEN 'EWMA do ticket médio fora de controle' END AS motivo
FROM ewma_rows"""


_BRANCH_SERIES = "SELECT agencia_id, dt, count(*) AS x FROM dated GROUP BY agencia_id, dt"
_PIX_SERIES = (
    "SELECT associado_id, dt, avg(valor) AS x FROM dated WHERE tipo LIKE 'PIX%' "
    "GROUP BY associado_id, dt"
)

_HOURLY = """
hr AS (
  SELECT agencia_id, CAST(dt_transacao AS DATE) AS dt, hour(dt_transacao) AS hora, count(*) AS qtd
  FROM clean GROUP BY ALL
), hr_stat AS (
  SELECT *, avg(qtd) OVER (PARTITION BY agencia_id) AS mu,
         CASE WHEN stddev_samp(qtd) OVER (PARTITION BY agencia_id) = 0 THEN 1.0e0
              ELSE stddev_samp(qtd) OVER (PARTITION BY agencia_id) END AS sd
  FROM hr
), hourly_rows AS (
  SELECT *, coalesce(qtd > mu + 3 * sd OR qtd < greatest(0, mu - 3 * sd), FALSE) AS alerta
  FROM hr_stat
)"""


def _hourly_findings(exact: bool = False) -> str:
    score = _shown("least(abs(qtd - mu) / (3 * sd), 1.0e0)", exact)
    return f"""
SELECT agencia_id, CAST(dt AS VARCHAR) AS dt, hora, 'D3_3SIGMA_HORA' AS regra_id,
       'CONTROLE_INTERNO' AS familia, alerta,
       {score} AS score,
       CASE WHEN alerta THEN 'Volume horário fora de 3 desvios padrão' END AS motivo
FROM hourly_rows"""


def _benford(source: str, key: str, value: str) -> str:
    return f"""
bd AS (SELECT {key}, {_digit(value)} AS digito FROM {source}),
bd_tot AS (SELECT {key}, count(*) AS linhas, count(digito) AS total FROM bd GROUP BY {key}),
bd_cnt AS (SELECT {key}, digito, count(*) AS c FROM bd WHERE digito > 0 GROUP BY ALL),
bd_hist AS (
  SELECT t.{key}, linhas, total, d.digito, coalesce(c, 0) AS qtd,
         coalesce(c, 0) / total AS frequencia, log10(1 + 1.0e0 / d.digito) AS esperada
  FROM bd_tot t CROSS JOIN (SELECT unnest(range(1, 10)) AS digito) d
  LEFT JOIN bd_cnt n ON n.{key} = t.{key} AND n.digito = d.digito
), bd_stat AS (
  SELECT {key}, linhas, sum((qtd - esperada * total) * (qtd - esperada * total)
                            / (esperada * total)) AS chi2,
         avg(abs(frequencia - esperada)) AS mad
  FROM bd_hist GROUP BY {key}, linhas HAVING linhas >= 100
), bd_p AS (
  SELECT *, exp(-chi2 / 2) * (1 + chi2 / 2 + pow(chi2 / 2, 2) / 2 + pow(chi2 / 2, 3) / 6) AS p_value
  FROM bd_stat
), benford_rows AS (SELECT *, mad > 0.015e0 OR p_value < 0.01e0 AS alerta FROM bd_p)"""


def _benford_findings(key: str, exact: bool = False) -> str:
    score = _shown("least(greatest((mad - 0.006e0) / 0.020e0, 0.0e0), 1.0e0)", exact)
    return f"""
SELECT {key} AS chave, 'D4_BENFORD' AS regra_id, 'FRAUDE' AS familia, alerta,
       round(chi2, 6) AS chi2, round(p_value, 6) AS p_value, round(mad, 6) AS mad,
       {score} AS score,
       CASE WHEN alerta THEN 'Benford: MAD=' || printf('%.4f', mad) || ', p='
            || printf('%.4f', p_value) || ' ({key}=' || {key} || ')' END AS motivo
FROM benford_rows"""


_STRUCTURING = """
small AS (
  SELECT associado_id, dt_transacao, valor, epoch_us(dt_transacao) AS t
  FROM clean WHERE tipo IN ('PIX_OUT', 'TED') AND valor < 10000
), rolled AS (
  SELECT *, sum(valor) OVER w AS soma_janela, count(*) OVER w AS qtd_janela
  FROM small
  WINDOW w AS (PARTITION BY associado_id ORDER BY t
               RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)
), st_inst AS (
  SELECT associado_id, dt_transacao, count(*) AS qtd, sum(valor) AS soma,
         any_value(qtd_janela) AS qtd_janela, any_value(soma_janela) AS soma_janela,
         any_value(soma_janela) > 10000 AND any_value(qtd_janela) >= 3 AS suspeita
  FROM rolled GROUP BY ALL
), structuring_rows AS (
  SELECT associado_id, CAST(dt_transacao AS DATE) AS dt, CAST(sum(qtd) AS BIGINT) AS qtd_tx,
         sum(soma) AS soma
  FROM st_inst WHERE suspeita GROUP BY ALL
)"""


def _structuring_findings(exact: bool = False) -> str:
    score = _shown("least(soma / 10000, 2.0e0) / 2", exact)
    return f"""
SELECT associado_id, CAST(dt AS VARCHAR) AS dt, qtd_tx, round(soma, 6) AS soma,
       'D5_FRACIONAMENTO' AS regra_id, 'PLD' AS familia, TRUE AS alerta,
       {score} AS score,
       'Fracionamento: ' || qtd_tx || ' tx somando R$ ' || format('{{:,.2f}}', soma) || ' em 24h'
         AS motivo
FROM structuring_rows"""


# --- scores ------------------------------------------------------------------------------------

_WEIGHT = """CASE regra_id WHEN 'D1_CUSUM' THEN 0.10e0 WHEN 'D2_EWMA' THEN 0.10e0
  WHEN 'D3_3SIGMA_HORA' THEN 0.08e0 WHEN 'D4_BENFORD' THEN 0.07e0
  WHEN 'D5_FRACIONAMENTO' THEN 0.20e0 WHEN 'M1_ISOLATION_FOREST' THEN 0.25e0
  WHEN 'M2_AUTOENCODER' THEN 0.20e0 ELSE 0.0e0 END"""


def _severity(score: str, lowest: str = "0.5e0") -> str:
    return (
        f"CASE WHEN {score} >= 0.95e0 THEN 'CRITICA' WHEN {score} >= 0.85e0 THEN 'ALTA' "
        f"WHEN {score} >= 0.7e0 THEN 'MEDIA' WHEN {score} >= {lowest} THEN 'BAIXA' END"
    )


def _combine(lowest: str = "0.5e0") -> str:
    return f"""
weighed AS (SELECT *, {_WEIGHT} AS w FROM findings),
rolled_up AS (
  SELECT entidade, sum(coalesce(score, 0) * w) AS sw, sum(w) AS peso_total,
         array_to_string(list_sort(list_distinct(list(familia))), '|') AS familias,
         array_to_string(list_sort(list_distinct(list(regra_id))), '|') AS regras,
         coalesce(array_to_string(list_sort(list_distinct(
           list(motivo) FILTER (WHERE motivo IS NOT NULL))), ' | '), '') AS motivos,
         min(familia) AS familia
  FROM weighed GROUP BY entidade
), scored AS (
  SELECT *, CASE WHEN peso_total <> 0
                 THEN least(greatest(sw / peso_total, 0.0e0), 1.0e0) ELSE 0.0e0 END AS score
  FROM rolled_up
), combined AS (
  SELECT entidade, score, peso_total, familias, regras, motivos, severidade, familia
  FROM (SELECT *, {_severity('score', lowest)} AS severidade FROM scored) WHERE severidade IS NOT NULL
)"""

_ALERTS = """
SELECT sha256(entidade || '|' || regras) AS alerta_id, entidade AS transacao_id,
       '2024-02-15 00:00:00.000000' AS dt_alerta, regras AS regra_id, familia, severidade,
       round(score, 6) AS score, motivos AS motivo, 'ABERTO' AS status
FROM combined"""

_SCORES = """
long_scores AS (
  SELECT event_id, value, rule AS regra_id,
         CASE WHEN rule = 'M1_ISOLATION_FOREST' THEN least(1.0e0, value / 150.0e0)
              ELSE (event_id * p) % 100 / 100.0e0 END AS score
  FROM events CROSS JOIN (VALUES ('D1_CUSUM', 3), ('D2_EWMA', 7), ('D3_3SIGMA_HORA', 11),
    ('D4_BENFORD', 13), ('D5_FRACIONAMENTO', 17), ('M1_ISOLATION_FOREST', 1),
    ('M2_AUTOENCODER', 23)) AS r(rule, p)
)"""

_SCORE_FINDINGS = f"""{_SCORES}, findings AS (
  SELECT 'T' || event_id AS entidade, regra_id,
         CASE WHEN regra_id = 'D5_FRACIONAMENTO' THEN 'PLD' ELSE 'FRAUDE' END AS familia,
         score > 0.9e0 AS alerta, score,
         CASE WHEN score > 0.9e0 THEN 'Sinal de ' || regra_id END AS motivo
  FROM long_scores
)"""

_LABELLED = """
alerts AS (
  SELECT 'A' || event_id AS alerta_id, 'T' || event_id AS transacao_id, ts AS dt_alerta,
         CASE event_type WHEN 'click' THEN 'D2_EWMA|M1_ISOLATION_FOREST' WHEN 'view' THEN 'D1_CUSUM'
           WHEN 'purchase' THEN 'D5_FRACIONAMENTO' WHEN 'signup' THEN 'D3_3SIGMA_HORA'
           WHEN 'error' THEN 'D4_BENFORD|M2_AUTOENCODER' END AS regra_id,
         CASE event_type WHEN 'purchase' THEN 'PLD' WHEN 'signup' THEN 'CONTROLE_INTERNO'
           ELSE 'FRAUDE' END AS familia,
         CASE WHEN least(1.0e0, value / 150.0e0) < 0.7e0 THEN 'BAIXA'
              WHEN least(1.0e0, value / 150.0e0) < 0.85e0 THEN 'MEDIA'
              WHEN least(1.0e0, value / 150.0e0) < 0.95e0 THEN 'ALTA' ELSE 'CRITICA' END
           AS severidade,
         least(1.0e0, value / 150.0e0) AS score,
         'Regra ' || event_type AS motivo,
         CASE WHEN value > 60 THEN 'CONFIRMADO'
              WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 = 0 THEN 'ABERTO'
              WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 = 1 THEN 'EM_ANALISE'
              ELSE 'FALSO_POSITIVO' END AS status
  FROM events
)"""



def _training_set(exact: bool = False) -> str:
    columns = ", ".join(
        _shown(f"coalesce(max(l.score) FILTER (WHERE l.regra_id = '{c.removeprefix('score_')}'), 0.0e0)", exact) + f" AS {c}"
        for c in learned.SCORE_COLUMNS
    )
    return (
        f"SELECT alerta_id, CAST(any_value(status) = 'CONFIRMADO' AS BIGINT) AS confirmado, {columns} "
        "FROM alerts a JOIN long_scores l ON a.alerta_id = 'A' || l.event_id "
        "WHERE status IN ('CONFIRMADO', 'FALSO_POSITIVO') GROUP BY alerta_id"
    )


_FEATURES = f"""
WITH {_CLEAN}, {_DIMS}, base AS (
  SELECT c.*, m.dt_adesao, m.score_risco, epoch_us(dt_transacao) AS t
  FROM clean c LEFT JOIN member m USING (associado_id)
), used AS (
  SELECT *, CASE WHEN conta_destino IS NOT NULL AND row_number() OVER
      (PARTITION BY associado_id, conta_destino ORDER BY t, transacao_id) = 1
      THEN 1 ELSE 0 END AS novo
  FROM base
), med AS (
  SELECT associado_id, avg(valor) AS ticket, quantile_cont(geo_lat, 0.5) AS mlat,
         quantile_cont(geo_lon, 0.5) AS mlon
  FROM base GROUP BY associado_id
), seen AS (
  SELECT u.*, ticket, mlat, mlon,
    count(*) OVER (PARTITION BY u.associado_id ORDER BY t
                   RANGE BETWEEN 604799999999 PRECEDING AND CURRENT ROW) AS f7,
    count(*) OVER (PARTITION BY u.associado_id ORDER BY t
                   RANGE BETWEEN 2591999999999 PRECEDING AND CURRENT ROW) AS f30,
    sum(novo) OVER (PARTITION BY u.associado_id ORDER BY t
                    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dest
  FROM used u JOIN med USING (associado_id)
)
SELECT transacao_id, round(valor, 6) AS valor, round(ln(1 + greatest(valor, 0.01e0)), 6) AS log_valor,
       CAST(hour(dt_transacao) AS DOUBLE) AS hora,
       CAST(isodow(dt_transacao) - 1 AS DOUBLE) AS dia_semana,
       CAST(f7 AS DOUBLE) AS freq_7d, CAST(f30 AS DOUBLE) AS freq_30d,
       CAST(dest AS DOUBLE) AS destinos_unicos_30d,
       CAST(greatest(coalesce(date_diff('day', dt_adesao, CAST(dt_transacao AS DATE)), 0), 0)
            AS DOUBLE) AS idade_conta_dias,
       round(coalesce(score_risco, 0.3e0), 6) AS score_risco_assoc,
       round(coalesce(valor / nullif(ticket, 0), 1.0e0), 6) AS ratio_valor_ticket_medio,
       round(coalesce(sqrt(pow(coalesce(geo_lat, mlat) - mlat, 2)
                           + pow(coalesce(geo_lon, mlon) - mlon, 2)), 0), 6) AS distancia_geo_padrao
FROM seen"""

_PROFILE = f"""
WITH {_CLEAN}, prof AS (
  SELECT associado_id, strftime(dt_transacao, '%Y-%m') AS ano_mes, count(*) AS qtd_tx,
         sum(valor) AS valor_total, avg(valor) AS valor_medio, max(valor) AS valor_max,
         coalesce(stddev_samp(valor), 0) AS valor_std, avg(hour(dt_transacao)) AS hora_media,
         count(DISTINCT conta_destino) AS destinos_unicos, count(DISTINCT canal) AS canais,
         avg(CASE WHEN hour(dt_transacao) < 6 OR hour(dt_transacao) >= 22 THEN 1.0e0 ELSE 0 END)
           AS pct_madrugada
  FROM clean GROUP BY ALL
)"""


def _psi() -> str:
    edges = ", ".join(f"quantile_cont(score, {i}e-1) AS q{i}" for i in range(1, 10))
    slot = " + ".join(f"(CASE WHEN score > q{i} THEN 1 ELSE 0 END)" for i in range(1, 10))
    return f"""
WITH {_LABELLED}, base AS (SELECT * FROM alerts WHERE CAST(dt_alerta AS DATE) < DATE '2024-01-08'),
edges AS (SELECT {edges} FROM base),
act AS (
  SELECT CAST(date_trunc('week', dt_alerta) AS DATE) AS periodo, {slot} AS bin, count(*) AS n
  FROM alerts CROSS JOIN edges GROUP BY ALL
), expd AS (SELECT {slot} AS bin, count(*) AS n FROM base CROSS JOIN edges GROUP BY ALL),
tot AS (SELECT periodo, sum(n) AS qtd FROM act GROUP BY periodo),
share AS (
  SELECT periodo, qtd, greatest(coalesce(a.n, 0) / qtd, 1e-4) AS a,
         greatest(coalesce(e.n, 0) / (SELECT count(*) FROM base), 1e-4) AS e
  FROM tot CROSS JOIN (SELECT unnest(range(0, 10)) AS bin) b
  LEFT JOIN act a USING (periodo, bin) LEFT JOIN expd e USING (bin)
)
SELECT CAST(periodo AS VARCHAR) AS periodo, CAST(qtd AS BIGINT) AS qtd,
       round(sum((a - e) * ln(a / e)), 6) AS psi
FROM share GROUP BY periodo, qtd"""


def _psi_features() -> str:
    """Values are rounded before they are binned on neither side; edges are interpolated alike."""
    names = learned.FEATURE_COLUMNS
    exact = _FEATURES
    for c in ("valor", "ln(1 + greatest(valor, 0.01e0))", "coalesce(score_risco, 0.3e0)",
              "coalesce(valor / nullif(ticket, 0), 1.0e0)"):
        exact = exact.replace(f"round({c}, 6)", f"({c})")
    probs = ", ".join(f"{i}e-1" for i in range(1, 10))
    return f"""
WITH {_CLEAN}, feat AS ({exact}), timed AS (
  SELECT f.*, CAST(c.dt_transacao AS DATE) AS d FROM feat f JOIN clean c USING (transacao_id)
), cells AS (UNPIVOT (SELECT d, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in names)} FROM timed) ON {', '.join(names)} INTO NAME variavel VALUE v
), edges AS (
  SELECT variavel, quantile_cont(v, [{probs}]) AS q, count(*) AS base_n FROM cells WHERE d < DATE '2024-01-08' GROUP BY variavel
), slots AS (
  SELECT c.variavel, CAST(date_trunc('week', d) AS DATE) AS periodo, d < DATE '2024-01-08' AS base, base_n,
    len(list_filter(q, lambda e: e < v)) AS bin FROM cells c JOIN edges USING (variavel)
), act AS (SELECT variavel, periodo, bin, count(*) AS n FROM slots GROUP BY ALL),
expd AS (SELECT variavel, bin, count(*) / any_value(base_n) AS e FROM slots WHERE base GROUP BY variavel, bin),
tot AS (SELECT variavel, periodo, sum(n) AS qtd FROM act GROUP BY ALL)
SELECT variavel, CAST(periodo AS VARCHAR) AS periodo, CAST(qtd AS BIGINT) AS qtd, round(sum((a - e) * ln(a / e)), 6) AS psi FROM (
  SELECT t.variavel, t.periodo, qtd, greatest(coalesce(n, 0) / qtd, 1e-4) AS a, greatest(coalesce(x.e, 0), 1e-4) AS e
  FROM tot t CROSS JOIN (SELECT unnest(range(0, 10)) AS bin) b LEFT JOIN act USING (variavel, periodo, bin)
  LEFT JOIN expd x USING (variavel, bin)
) GROUP BY variavel, periodo, qtd"""


def _benford_cube() -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE digito = {d}) AS c{d}" for d in range(1, 10))
    total = " + ".join(f"c{d}" for d in range(1, 10))
    chi2 = " + ".join(f"pow(c{d} - total * log10(1 + 1.0e0 / {d}), 2) / (total * log10(1 + 1.0e0 / {d}))" for d in range(1, 10))
    mad = " + ".join(f"abs(c{d} / total - log10(1 + 1.0e0 / {d}))" for d in range(1, 10))
    return f"""
WITH {_CLEAN}, bd AS (
  SELECT tipo, strftime(dt_transacao, '%Y-%m') AS ano_mes, {_digit('valor')} AS digito FROM clean
), cells AS (
  SELECT grouping(tipo) AS gt, grouping(ano_mes) AS gm, tipo, ano_mes, count(*) AS linhas, {counts}
  FROM bd GROUP BY GROUPING SETS ((tipo, ano_mes), (tipo), (ano_mes), ())
), stat AS (
  SELECT *, {chi2} AS chi2, ({mad}) / 9 AS mad FROM (SELECT *, {total} AS total FROM cells
    WHERE linhas >= 100 AND (gt = 1 OR tipo IS NOT NULL) AND (gm = 1 OR ano_mes IS NOT NULL))
), tested AS (
  SELECT *, exp(-chi2 / 2) * (1 + chi2 / 2 + pow(chi2 / 2, 2) / 2 + pow(chi2 / 2, 3) / 6) AS p_value,
    concat_ws('+', CASE WHEN gt = 0 THEN 'tipo' END, CASE WHEN gm = 0 THEN 'ano_mes' END) AS nivel,
    concat_ws('|', CASE WHEN gt = 0 THEN tipo END, CASE WHEN gm = 0 THEN ano_mes END) AS chave FROM stat
)
SELECT nivel, chave, 'D4_BENFORD' AS regra_id, 'FRAUDE' AS familia, mad > 0.015e0 OR p_value < 0.01e0 AS alerta, linhas, total,
  round(chi2, 6) AS chi2, round(p_value, 6) AS p_value, round(mad, 6) AS mad,
  round(least(greatest((mad - 0.006e0) / 0.020e0, 0.0e0), 1.0e0), 6) AS score,
  CASE WHEN mad > 0.015e0 OR p_value < 0.01e0 THEN 'Benford: MAD=' || printf('%.4f', mad) || ', p=' || printf('%.4f', p_value)
    || ' (' || CASE WHEN nivel = '' THEN 'tudo' ELSE nivel || '=' || chave END || ')' END AS motivo
FROM tested"""


_TRUTH = f"""
WITH {_CLEAN}, {_LABELLED}, truth AS (
  SELECT c.transacao_id, fraude_label, fraude_tipo, score
  FROM clean c JOIN alerts USING (transacao_id)
)"""

_PROF = _PROFILE[_PROFILE.index("prof AS") :]

_FEEDBACK = """
feedback AS (
  SELECT event_id AS feedback_id, 'A' || (event_id - event_id % 3) AS alerta_id, 'auditor' || (event_id % 7) AS auditor,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 = 0 THEN 'EM_ANALISE'
              WHEN value * (1 + event_id % 2) > 60 THEN 'CONFIRMADO' ELSE 'FALSO_POSITIVO' END AS veredito,
         ts + INTERVAL 1 DAY AS dt_veredito
  FROM events
), verdicts AS (
  SELECT alerta_id, veredito AS status, auditor, dt_veredito, vereditos FROM (
    SELECT *, row_number() OVER (PARTITION BY alerta_id ORDER BY dt_veredito DESC, feedback_id DESC) AS nth,
           count(*) OVER (PARTITION BY alerta_id) AS vereditos FROM feedback) WHERE nth = 1
)"""

_ALERT_BRANCH = f"""
WITH {_CLEAN}, {_DIMS}, {_LABELLED}, placed AS (
  SELECT a.*, c.agencia_id, c.valor, c.canal, c.geo_lat, c.geo_lon, b.municipio
  FROM alerts a LEFT JOIN clean c USING (transacao_id) LEFT JOIN branch b USING (agencia_id)
)"""


def oracle() -> dict[str, str]:
    nations = (
        "SELECT CAST(c_nationkey AS VARCHAR) AS nacao, CAST(o_orderdate AS DATE) AS dt, "
        "count(*) AS x FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"
    )
    customers = (
        "SELECT o_custkey AS cliente, CAST(o_orderdate AS DATE) AS dt, avg(o_totalprice) AS x "
        "FROM orders GROUP BY ALL"
    )
    windows = (
        f"WITH {_CLEAN}, {_STRUCTURING} SELECT associado_id, "
        "strftime(dt_transacao, '%Y-%m-%d %H:%M:%S.%f') AS dt_transacao, qtd, "
        "round(soma, 6) AS soma, qtd_janela, round(soma_janela, 6) AS soma_janela, suspeita FROM st_inst"
    )
    detect = (
        f"WITH RECURSIVE {_DATED}, {_cusum(_BRANCH_SERIES, 'agencia_id', 5.0)}, "
        f"{_ewma(_PIX_SERIES, 'associado_id')}, {_HOURLY}, {_benford('clean', 'tipo', 'valor')}, "
        f"{_STRUCTURING}, "
    )
    common = "regra_id, familia, score, motivo"
    findings = (
        f"findings AS (SELECT agencia_id AS entidade, {common} "
        f"FROM ({_cusum_findings('agencia_id', True)}) "
        f"UNION ALL SELECT associado_id, {common} FROM ({_ewma_findings('associado_id', True)}) "
        f"UNION ALL SELECT agencia_id, {common} FROM ({_hourly_findings(True)}) "
        f"UNION ALL SELECT '-', {common} FROM ({_benford_findings('tipo', True)}) "
        f"UNION ALL SELECT associado_id, {common} FROM ({_structuring_findings(True)}))"
    )
    engine = f"{detect} {findings}, {_combine('0.0e0')} {_ALERTS}"
    located = (
        "SELECT e.*, coalesce(c.agencia_id, CASE WHEN e.transacao_id IN (SELECT agencia_id FROM {known}) "
        "THEN e.transacao_id END) AS agencia_id FROM engine e LEFT JOIN clean c USING (transacao_id)"
    )
    models = (
        f"{detect} {learned.forest(_FEATURES)}, {_PROF}, {learned.network()}, {findings[:-1]} "
        f"UNION ALL SELECT transacao_id, regra_id, 'FRAUDE', score, {learned.M1_TEXT} "
        "FROM (SELECT *, 'M1_ISOLATION_FOREST' AS regra_id FROM m1_rows) "
        f"UNION ALL SELECT associado_id, regra_id, 'FRAUDE', score, {learned.M2_TEXT} "
        "FROM (SELECT *, 'M2_AUTOENCODER' AS regra_id FROM ae_rows))"
    )
    behind = (
        f"{detect} {findings}, {_combine('0.0e0')}, proof AS ("
        "SELECT agencia_id AS e, 'AGENCIA' AS kind, 'D1_CUSUM' AS r, alerta, CAST(dt AS TIMESTAMP) AS a, "
        "CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY AS b FROM cusum_rows "
        "UNION ALL SELECT associado_id, 'ASSOCIADO', 'D2_EWMA', alerta, CAST(dt AS TIMESTAMP), "
        "CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY FROM ewma_rows "
        "UNION ALL SELECT agencia_id, 'AGENCIA', 'D3_3SIGMA_HORA', alerta, dt + to_hours(hora), dt + to_hours(hora + 1) "
        "FROM hourly_rows UNION ALL SELECT associado_id, 'ASSOCIADO', 'D5_FRACIONAMENTO', TRUE, "
        "CAST(dt AS TIMESTAMP) - INTERVAL 24 HOUR, CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY FROM structuring_rows"
        "), kept AS (SELECT * FROM proof WHERE alerta OR e NOT IN (SELECT e FROM proof WHERE alerta)) "
        "SELECT sha256(entidade || '|' || regras) AS alerta_id, kind AS tipo_entidade, transacao_id, associado_id, agencia_id, "
        "strftime(dt_transacao, '%Y-%m-%d %H:%M:%S.%f') AS dt_transacao, tipo, round(valor, 6) AS valor, canal, "
        "array_to_string(list_sort(list_distinct(list(r))), '|') AS regras FROM combined "
        "JOIN kept ON e = entidade JOIN clean c ON (kind = 'AGENCIA' AND c.agencia_id = e OR kind = 'ASSOCIADO' "
        "AND c.associado_id = e) AND dt_transacao >= a AND dt_transacao < b AND (r <> 'D2_EWMA' OR tipo LIKE 'PIX%') "
        "AND (r <> 'D5_FRACIONAMENTO' OR tipo IN ('PIX_OUT', 'TED') AND valor < 10000) "
        "GROUP BY entidade, combined.regras, kind, transacao_id, associado_id, agencia_id, dt_transacao, tipo, valor, canal"
    )
    judged = _training_set(True).replace("FROM alerts a", "FROM verdicts a")
    wide = judged.replace("JOIN long_scores", "RIGHT JOIN long_scores").split(" WHERE ")[0]
    wide = wide.replace("SELECT alerta_id", "SELECT 'A' || l.event_id AS alerta_id") + " GROUP BY l.event_id"
    queue = (
        f"WITH RECURSIVE {_CLEAN}, {_LABELLED}, {_SCORES}, {_FEEDBACK}, {learned.calibration(judged)}, "
        f"wide AS (SELECT alerta_id, [{', '.join(f'CAST({c} AS DOUBLE)' for c in learned.SCORE_COLUMNS)}] AS s FROM ({wide})), "
        "prob AS (SELECT alerta_id, 1 / (1 + exp(-list_inner_product(list_append(list_transform(range(1, len(s) + 1), "
        "lambda k: (s[k] - mean[k]) / dev[k]), 1.0e0), w))) AS p FROM wide CROSS JOIN cal_scale CROSS JOIN model) "
        "SELECT a.alerta_id, a.transacao_id, strftime(dt_alerta, '%Y-%m') AS ano_mes, c.canal, a.regra_id, a.familia, "
        "a.severidade, round(a.score, 6) AS score, round(p, 6) AS prob_confirmacao, coalesce(v.status, 'ABERTO') AS status "
        "FROM alerts a LEFT JOIN verdicts v USING (alerta_id) LEFT JOIN clean c ON c.transacao_id = a.transacao_id "
        "LEFT JOIN prob ON prob.alerta_id = a.alerta_id WHERE coalesce(v.status, 'ABERTO') IN ('ABERTO', 'EM_ANALISE')"
    )
    engine_branch = (
        f"WITH {_CLEAN}, {_DIMS}, engine AS (SELECT * FROM ({engine})), "
        f"placed AS ({located.format(known='clean')}), located AS ({located.format(known='branch')})"
    )
    return {
        "bronze_scan": f"WITH {_TX} SELECT {_BRONZE_SHOWN} FROM bronze WHERE dt_transacao >= TIMESTAMP '2024-01-03'",
        "bronze_roundtrip": f"WITH {_TX} SELECT {_BRONZE_SHOWN} FROM bronze",
        "stream_ingest": f"WITH {_TX} SELECT {_BRONZE_SHOWN} FROM labelled_tx",
        "silver_clean": f"WITH {_CLEAN} SELECT {_BRONZE_SHOWN} FROM clean",
        "silver_derive": f"WITH {_DATED} SELECT transacao_id, CAST(dt AS VARCHAR) AS dt, hora, "
        "dia_semana, primeiro_digito FROM dated",
        "first_digit": f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
        f"{_digit('l_extendedprice')} AS preco, {_digit('l_discount')} AS desconto FROM lineitem",
        "silver_enrich": f"WITH {_SILVER} SELECT {_SILVER_SHOWN} FROM silver",
        "silver_roundtrip": f"WITH {_SILVER} SELECT {_SILVER_SHOWN} FROM silver",
        "silver_flags": f"WITH {_SILVER} SELECT transacao_id, flag_fora_horario, "
        "flag_fim_de_semana, flag_valor_alto, flag_alta_alcada FROM silver",
        "dim_calendar": f"WITH {_calendar('cal', 'SELECT CAST(o_orderdate AS DATE) AS d FROM orders')}"
        " SELECT CAST(dt AS VARCHAR) AS dt, ano, mes, dia_semana, dia_util, feriado FROM cal",
        "gold_branch_day": f"WITH {_SILVER} {_BRANCH_DAY}",
        "gold_roundtrip": f"WITH {_SILVER} SELECT 'fato_agencia_dia' AS tabela, agencia_id AS chave, agencia_id, "
        "CAST(dt AS VARCHAR) AS quando, count(*) AS qtd_tx, round(sum(valor), 6) AS valor_total FROM silver GROUP BY agencia_id, dt "
        "UNION ALL SELECT 'fato_operador_dia', operador_id, agencia_id, CAST(dt AS VARCHAR), count(*), round(sum(valor), 6) "
        "FROM silver WHERE operador_id IS NOT NULL GROUP BY operador_id, agencia_id, dt "
        "UNION ALL SELECT 'fato_associado_mes', associado_id, NULL, strftime(dt, '%Y-%m'), count(*), round(sum(valor), 6) "
        "FROM silver GROUP BY associado_id, strftime(dt, '%Y-%m')",
        "gold_incremental_days": f"WITH {_SILVER} {_BRANCH_DAY}",
        "stream_to_silver": f"WITH {_SILVER} SELECT {_SILVER_SHOWN} FROM silver",
        "gold_operator_day": f"WITH {_SILVER} SELECT operador_id, agencia_id, "
        "CAST(dt AS VARCHAR) AS dt, count(*) AS qtd_tx, round(sum(valor), 6) AS valor_total, "
        "count(*) FILTER (WHERE flag_fora_horario) AS qtd_fora_horario FROM silver "
        "WHERE operador_id IS NOT NULL GROUP BY operador_id, agencia_id, dt",
        "gold_member_month": f"WITH {_DATED} SELECT associado_id, strftime(dt, '%Y-%m') AS ano_mes, "
        "count(*) AS qtd_tx, round(sum(valor), 6) AS valor_total, "
        "round(avg(valor), 6) AS ticket_medio, count(DISTINCT conta_destino) AS destinos_unicos, "
        "count(DISTINCT canal) AS canais_distintos FROM dated GROUP BY ALL",
        "gold_incremental": f"WITH {_DATED} SELECT associado_id, strftime(dt, '%Y-%m') AS ano_mes, "
        "count(*) AS qtd_tx, round(sum(valor), 6) AS valor_total, "
        "round(avg(valor), 6) AS ticket_medio, count(DISTINCT conta_destino) AS destinos_unicos, "
        "count(DISTINCT canal) AS canais_distintos FROM dated GROUP BY ALL",
        "cusum_series": f"WITH RECURSIVE {_DATED}, {_cusum(_BRANCH_SERIES, 'agencia_id', 3.0)} "
        "SELECT agencia_id, CAST(dt AS VARCHAR) AS dt, x AS qtd_tx, round(mu0, 6) AS mu0, "
        "round(sigma, 6) AS sigma, round(s_h, 6) AS s_h, round(s_l, 6) AS s_l, alerta "
        "FROM cusum_rows",
        "d1_cusum": f"WITH RECURSIVE {_DATED}, {_cusum(_BRANCH_SERIES, 'agencia_id', 5.0)} "
        f"{_cusum_findings('agencia_id')}",
        "cusum_orders_by_nation": f"WITH RECURSIVE {_cusum(nations, 'nacao', 5.0)} "
        f"{_cusum_findings('nacao')}",
        "ewma_series": f"WITH RECURSIVE {_DATED}, {_ewma(_PIX_SERIES, 'associado_id')} "
        "SELECT associado_id, CAST(dt AS VARCHAR) AS dt, round(x, 6) AS ticket_medio, i, "
        "round(z, 6) AS z, round(superior, 6) AS superior, round(inferior, 6) AS inferior, alerta "
        "FROM ewma_rows",
        "d2_ewma": f"WITH RECURSIVE {_DATED}, {_ewma(_PIX_SERIES, 'associado_id')} "
        f"{_ewma_findings('associado_id')}",
        "ewma_orders_by_customer": f"WITH RECURSIVE {_ewma(customers, 'cliente')} "
        f"{_ewma_findings('cliente')}",
        "d3_hourly": f"WITH {_CLEAN}, {_HOURLY} {_hourly_findings()}",
        "benford_histogram": f"WITH {_CLEAN}, {_benford('clean', 'tipo', 'valor')} SELECT tipo, "
        "linhas, total, digito, qtd, round(frequencia, 6) AS frequencia, "
        "round(esperada, 6) AS esperada FROM bd_hist",
        "d4_benford": f"WITH {_CLEAN}, {_benford('clean', 'tipo', 'valor')} "
        f"{_benford_findings('tipo')}",
        "d4_benford_cube": _benford_cube(),
        "psi_features": _psi_features(),
        "silver_rejects": f"WITH {_TX}, why AS (SELECT *, CASE WHEN transacao_id IS NULL THEN 'SEM_ID' "
        "WHEN dt_transacao IS NULL THEN 'SEM_DATA' WHEN valor IS NULL THEN 'VALOR_AUSENTE' "
        "WHEN valor <= 0 THEN 'VALOR_NAO_POSITIVO' END AS r FROM bronze), nth AS (SELECT *, CASE WHEN r IS NULL THEN "
        "row_number() OVER (PARTITION BY transacao_id, r ORDER BY dt_ingestao) END AS k FROM why) "
        "SELECT coalesce(r, CASE WHEN k > 1 THEN 'DUPLICADA' END, 'OK') AS motivo_rejeicao, count(*) AS qtd, "
        "count(DISTINCT transacao_id) AS ids, round(count(*) / (SELECT count(*) FROM bronze), 6) AS parte FROM nth GROUP BY 1",
        "benford_lineitem_by_flag": "WITH "
        f"{_benford('lineitem', 'l_returnflag', 'l_extendedprice')} "
        f"{_benford_findings('l_returnflag')}",
        "structuring_windows": windows,
        "structuring_sliced": windows,
        "d5_structuring": f"WITH {_CLEAN}, {_STRUCTURING} {_structuring_findings()}",
        "m1_features": _FEATURES,
        "m1_features_sliced": _FEATURES,
        "model_tables_roundtrip": f"WITH {_CLEAN} SELECT 'isolation_forest' AS modelo, count(*) AS linhas, "
        "0 AS diferentes FROM clean UNION ALL SELECT 'autoencoder', count(*), 0 FROM (SELECT DISTINCT "
        "associado_id, strftime(dt_transacao, '%Y-%m') FROM clean WHERE associado_id IS NOT NULL)",
        "m1_normalise": "WITH raw AS (SELECT 'T' || event_id AS transacao_id, "
        "value / (value + 50.0e0) AS bruto FROM events), span AS (SELECT min(bruto) AS lo, "
        "max(bruto) AS hi, quantile_cont(bruto, 0.99e0) AS p99 FROM raw) "
        "SELECT transacao_id, 'M1_ISOLATION_FOREST' AS regra_id, 'FRAUDE' AS familia, "
        "bruto >= p99 AS alerta, round((bruto - lo) / greatest(hi - lo, 1e-9), 6) AS score, "
        "CASE WHEN bruto >= p99 THEN 'Isolation Forest: padrão multivariado anômalo' END AS motivo "
        "FROM raw CROSS JOIN span",
        "m2_profile": f"{_PROFILE} SELECT associado_id, ano_mes, qtd_tx, "
        + ", ".join(
            f"round({c}, 6) AS {c}"
            for c in ("valor_total", "valor_medio", "valor_max", "valor_std", "hora_media")
        )
        + ", destinos_unicos, canais, round(pct_madrugada, 6) AS pct_madrugada FROM prof",
        "m2_threshold": f"{_PROFILE}, err AS (SELECT associado_id, ano_mes, "
        "valor_max / valor_total AS erro FROM prof), thr AS (SELECT quantile_cont(erro, 0.99e0) AS t "
        "FROM err) SELECT associado_id, ano_mes, 'M2_AUTOENCODER' AS regra_id, 'FRAUDE' AS familia, "
        "erro > t AS alerta, round(least(greatest(erro / greatest(2 * t, 1e-9), 0.0e0), 1.0e0), 6) "
        "AS score, CASE WHEN erro > t THEN 'Autoencoder: erro de reconstrução acima do p99' END "
        "AS motivo FROM err CROSS JOIN thr",
        "m1_forest_train": f"WITH RECURSIVE {_CLEAN}, {learned.forest(_FEATURES)} {learned.NODES}",
        "m1_forest_score": f"WITH RECURSIVE {_CLEAN}, {learned.forest(_FEATURES)} {learned.M1_FINDINGS}",
        "m1_forest_score_stored": f"WITH RECURSIVE {_CLEAN}, {learned.forest(_FEATURES)} {learned.M1_FINDINGS}",
        "m1_by_channel": f"WITH RECURSIVE {_CLEAN}, {learned.forest(_FEATURES, 'canal', 50)} {learned.M1_FINDINGS}",
        "m2_score_stored": f"{_PROFILE}, {learned.network()} {learned.M2_FINDINGS}",
        "m3_calibrated": f"WITH RECURSIVE {_LABELLED}, {_SCORES}, {learned.calibration(_training_set(True))} "
        "SELECT alerta_id, CAST(confirmado AS BIGINT) AS confirmado, "
        "round(1 / (1 + exp(-list_inner_product(x, w))), 6) AS prob_confirmacao FROM cal_z CROSS JOIN model",
        "m3_training_set": f"WITH {_LABELLED}, {_SCORES} {_training_set()}",
        "severity_bins": "SELECT event_id, round(least(1.0e0, value / 150.0e0), 6) AS score, "
        f"{_severity('least(1.0e0, value / 150.0e0)')} AS severidade FROM events",
        "combine_scores": f"WITH {_SCORE_FINDINGS}, {_combine()} SELECT entidade, "
        "round(score, 6) AS score, round(peso_total, 6) AS peso_total, familias, regras, motivos, "
        "severidade, familia FROM combined",
        "alerts_table": f"WITH {_SCORE_FINDINGS}, {_combine()} {_ALERTS}",
        "full_scoring": engine,
        "full_scoring_models": f"{models}, {_combine()} {_ALERTS}",
        "alert_transactions": behind,
        "feedback_latest": f"WITH {_FEEDBACK} SELECT alerta_id, status, auditor, "
        "strftime(dt_veredito, '%Y-%m-%d %H:%M:%S.%f') AS dt_veredito, vereditos FROM verdicts",
        "alert_queue_calibrated": queue,
        "top_branches_engine": f"{engine_branch}, vol AS (SELECT agencia_id, count(*) AS qtd_tx FROM clean "
        "GROUP BY agencia_id), opened AS (SELECT agencia_id, count(*) AS alertas_abertos FROM placed "
        "WHERE status = 'ABERTO' GROUP BY agencia_id), best AS (SELECT agencia_id, qtd_tx, alertas_abertos, "
        "round(alertas_abertos / (qtd_tx / 1000.0e0), 6) AS alertas_por_mil FROM vol JOIN opened "
        "USING (agencia_id) ORDER BY alertas_abertos / (qtd_tx / 1000.0e0) DESC, agencia_id LIMIT 10) "
        "SELECT * FROM best UNION ALL SELECT agencia_id, NULL, alertas_abertos, NULL FROM opened "
        "WHERE agencia_id IS NULL",
        "alerts_by_city_engine": f"{engine_branch}, named AS (SELECT p.*, b.municipio FROM located p "
        "LEFT JOIN branch b USING (agencia_id)) SELECT municipio, familia, count(*) AS qtd FROM named "
        "GROUP BY ALL",
        "severity_distribution": f"WITH {_SCORE_FINDINGS}, {_combine()} SELECT severidade, "
        "count(*) AS qtd FROM combined GROUP BY severidade",
        "alerts_roundtrip": f"WITH {_LABELLED} SELECT alerta_id, transacao_id, "
        "strftime(dt_alerta, '%Y-%m-%d %H:%M:%S.%f') AS dt_alerta, regra_id, familia, severidade, "
        "round(score, 6) AS score, motivo, status FROM alerts",
        "kpi_summary": f"WITH {_LABELLED} SELECT count(*) FILTER (WHERE status = 'ABERTO') "
        "AS alertas_abertos, count(*) FILTER (WHERE severidade = 'CRITICA') AS alertas_criticos, "
        "round(avg(score), 6) AS score_medio, "
        "round(count(*) FILTER (WHERE status = 'FALSO_POSITIVO') / "
        "count(*) FILTER (WHERE status <> ''), 6) AS pct_falso_positivo, "
        "round(avg(date_diff('day', CAST(dt_alerta AS DATE), DATE '2024-02-15')) "
        "FILTER (WHERE status <> 'ABERTO'), 6) AS dias_tratamento FROM alerts",
        "alerts_by_family_month": f"WITH {_LABELLED} SELECT familia, "
        "strftime(dt_alerta, '%Y-%m') AS ano_mes, count(*) AS qtd FROM alerts GROUP BY ALL",
        "top_branches": f"{_ALERT_BRANCH}, vol AS (SELECT agencia_id, count(*) AS qtd_tx FROM clean "
        "GROUP BY agencia_id), opened AS (SELECT agencia_id, count(*) AS alertas_abertos FROM placed "
        "WHERE status = 'ABERTO' GROUP BY agencia_id) SELECT agencia_id, qtd_tx, alertas_abertos, "
        "round(alertas_abertos / (qtd_tx / 1000.0e0), 6) AS alertas_por_mil FROM vol JOIN opened "
        "USING (agencia_id) ORDER BY alertas_abertos / (qtd_tx / 1000.0e0) DESC, agencia_id LIMIT 10",
        "alerts_by_city": f"{_ALERT_BRANCH} SELECT municipio, familia, count(*) AS qtd FROM placed "
        "GROUP BY ALL",
        "alert_drillthrough": f"{_ALERT_BRANCH} SELECT alerta_id, transacao_id, "
        "strftime(dt_alerta, '%Y-%m-%d %H:%M:%S.%f') AS dt_alerta, familia, severidade, "
        "round(score, 6) AS score, motivo, agencia_id, municipio, round(valor, 6) AS valor, canal, "
        "round(geo_lat, 6) AS geo_lat, round(geo_lon, 6) AS geo_lon FROM placed "
        "WHERE status = 'ABERTO' AND severidade IN ('BAIXA', 'CRITICA')",
        "star_branch_day": f"WITH {_SILVER} SELECT municipio, ano, mes, dia_util, "
        "count(*) AS qtd_tx, round(sum(valor), 6) AS valor_total, "
        "count(*) FILTER (WHERE flag_valor_alto) AS qtd_valor_alto FROM silver GROUP BY ALL",
        "star_operator_day": f"WITH {_SILVER}, op AS (SELECT DISTINCT operador_id, "
        "list_value('CAIXA', 'GERENTE', 'AUDITOR', 'SUPORTE')"
        "[1 + CAST(substr(operador_id, 3) AS INTEGER) % 4] AS funcao, "
        "'AG' || lpad(CAST(CAST(substr(operador_id, 3) AS INTEGER) % 25 AS VARCHAR), 4, '0') "
        "AS lotacao FROM tx WHERE operador_id IS NOT NULL) SELECT funcao, dia_util, "
        "agencia_id = lotacao AS na_lotacao, count(*) AS qtd_tx, "
        "round(sum(valor), 6) AS valor_total, "
        "count(*) FILTER (WHERE flag_fora_horario) AS qtd_fora_horario "
        "FROM silver JOIN op USING (operador_id) GROUP BY ALL",
        "score_histogram": f"WITH {_LABELLED}, top AS (SELECT quantile_cont(score, 0.99e0) AS p99 "
        "FROM alerts) SELECT CAST(least(floor(score * 20), 19) AS BIGINT) AS faixa, "
        "count(*) AS qtd, round(any_value(p99), 6) AS p99 FROM alerts CROSS JOIN top GROUP BY faixa",
        "confusion_matrix": f"WITH {_LABELLED} SELECT status, score >= 0.85e0 AS acima, "
        "count(*) AS qtd FROM alerts GROUP BY ALL",
        "fp_rate_by_rule": f"WITH {_LABELLED}, judged AS (SELECT unnest(string_split(regra_id, '|')) "
        "AS regra, status FROM alerts WHERE status IN ('CONFIRMADO', 'FALSO_POSITIVO')) "
        "SELECT regra, count(*) AS julgados, "
        "count(*) FILTER (WHERE status = 'FALSO_POSITIVO') AS falsos, "
        "round(count(*) FILTER (WHERE status = 'FALSO_POSITIVO') / count(*), 6) AS taxa_fp "
        "FROM judged GROUP BY regra",
        "psi_by_week": _psi(),
        "precision_at_k": f"{_TRUTH}, best AS (SELECT * FROM truth ORDER BY score DESC, "
        "transacao_id LIMIT 100) SELECT count(*) AS k, "
        "count(*) FILTER (WHERE fraude_label) AS acertos, "
        "round(count(*) FILTER (WHERE fraude_label) / count(*), 6) AS precisao FROM best",
        "recall_by_type": f"{_TRUTH} SELECT fraude_tipo, count(*) AS fraudes, "
        "count(*) FILTER (WHERE score >= 0.5e0) AS detectadas, "
        "round(count(*) FILTER (WHERE score >= 0.5e0) / count(*), 6) AS recall "
        "FROM truth WHERE fraude_label GROUP BY fraude_tipo",
    }
