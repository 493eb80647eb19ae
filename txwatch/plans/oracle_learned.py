"""SQL counterparts of the learned detectors: forest growth and walk, network layers, Newton steps.

Draws are digests, so SQL makes the same ones. Growth and walk are recursions over levels, the calibration a
recursion over Newton steps whose linear system is solved by eliminating one column after the other.
"""

from __future__ import annotations

from txwatch.operators.autoencoder import HIDDEN
from txwatch.operators.calibrator import SCORE_COLUMNS
from txwatch.operators.facts import PROFILE_COLUMNS
from txwatch.operators.features import FEATURE_COLUMNS
from txwatch.operators.isolation_forest import POOL, REST, SAMPLE, TREES

_SEED = 42


def _hex(digest: str, first: int, length: int) -> str:
    return f"CAST('0x' || substr({digest}, {first}, {length}) AS BIGINT)"


def _draw(text: str) -> str:
    return _hex(f"md5({text})", 1, 15)


def forest(features: str, group: str | None = None, trees: int = TREES, prefix: str = "") -> str:
    """Expressions from rows (`fx`) over nodes (`nodes`) to raw scores (`raw`), recursions included; needs `clean`."""
    rows = f"[{', '.join(FEATURE_COLUMNS)}]"
    columns = range(1, len(FEATURE_COLUMNS) + 1)
    ends = ", ".join(
        f"[{', '.join(f'{f}(x[{k}]) OVER w' for k in columns)}] AS {name}" for f, name in (("min", "lo"), ("max", "hi"))
    )
    grouped = (
        f"grp AS (SELECT transacao_id, {group} AS g0 FROM clean), grp_n AS (SELECT g0, count(*) AS n FROM grp GROUP BY g0), "
        f"grp_of AS (SELECT transacao_id, CASE WHEN g0 IS NULL OR n < {SAMPLE} THEN '{REST}' ELSE g0 END AS grupo "
        "FROM grp LEFT JOIN grp_n USING (g0))"
        if group else "grp_of AS (SELECT transacao_id, '' AS grupo FROM clean)"
    )
    digest = f"md5('{_SEED}:' || grupo || ':' || arvore || ':' || no)"
    return f"""
{grouped}, feat AS ({features}), fx AS (
  SELECT row_number() OVER () AS r, transacao_id, grupo, {rows} AS x FROM feat JOIN grp_of USING (transacao_id)
), pool AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grupo ORDER BY {_draw(f"'{_SEED}:' || transacao_id")},
    transacao_id) AS place FROM fx) WHERE place <= {POOL}
), picked AS (
  SELECT * FROM (SELECT grupo, arvore, transacao_id, x, row_number() OVER (PARTITION BY grupo, arvore
    ORDER BY {_draw(f"'{_SEED}:' || arvore || ':' || transacao_id")}, transacao_id) AS place
    FROM pool CROSS JOIN (SELECT unnest(range({trees})) AS arvore)) WHERE place <= {SAMPLE}
), deep AS (
  SELECT grupo, arvore, greatest(count(*), 2) AS n,
    CAST(ceil(log2(greatest(count(*), 2))) AS INTEGER) AS lim FROM picked GROUP BY grupo, arvore
), grow(profundidade, lim, grupo, arvore, no, x) AS (
  SELECT 0, lim, grupo, arvore, CAST(1 AS BIGINT), x FROM picked JOIN deep USING (grupo, arvore)
  UNION ALL
  SELECT profundidade + 1, lim, grupo, arvore, CASE WHEN x[c] <= cut THEN 2 * no ELSE 2 * no + 1 END, x FROM (
    SELECT *, CASE WHEN lo[c] + f * (hi[c] - lo[c]) >= hi[c] THEN lo[c] ELSE lo[c] + f * (hi[c] - lo[c]) END AS cut FROM (
      SELECT *, usable[1 + a % len(usable)] AS c FROM (
        SELECT *, list_filter(range(1, {len(FEATURE_COLUMNS) + 1}), lambda k: hi[k] > lo[k]) AS usable,
          {_hex(digest, 1, 8)} AS a, {_hex(digest, 9, 13)} / 4503599627370496.0e0 AS f
        FROM (SELECT *, {ends} FROM grow WHERE profundidade < lim WINDOW w AS (PARTITION BY grupo, arvore, no))
      ) WHERE len(usable) > 0))
), grown AS (
  SELECT grupo, arvore, no, any_value(profundidade) AS profundidade, any_value(lim) AS lim, count(*) AS tamanho,
    [{', '.join(f'min(x[{k}])' for k in columns)}] AS lo, [{', '.join(f'max(x[{k}])' for k in columns)}] AS hi
  FROM grow GROUP BY grupo, arvore, no
), chosen AS (
  SELECT *, list_filter(range(1, {len(FEATURE_COLUMNS) + 1}), lambda k: hi[k] > lo[k]) AS usable,
    {_hex(digest, 1, 8)} AS a, {_hex(digest, 9, 13)} / 4503599627370496.0e0 AS f FROM grown
), nodes AS (
  SELECT grupo, arvore, no, tamanho, profundidade, c, CASE WHEN c > 0 THEN
    CASE WHEN lo[c] + f * (hi[c] - lo[c]) >= hi[c] THEN lo[c] ELSE lo[c] + f * (hi[c] - lo[c]) END ELSE 0.0e0 END AS cut
  FROM (SELECT *, CASE WHEN profundidade < lim AND len(usable) > 0 THEN usable[1 + a % len(usable)] ELSE 0 END AS c FROM chosen)
), walk(r, grupo, arvore, no) AS (
  SELECT r, grupo, arvore, CAST(1 AS BIGINT) FROM fx CROSS JOIN (SELECT unnest(range({trees})) AS arvore)
  UNION ALL
  SELECT w.r, w.grupo, w.arvore, CASE WHEN x[c] <= cut THEN 2 * w.no ELSE 2 * w.no + 1 END
  FROM walk w JOIN nodes n ON n.grupo = w.grupo AND n.arvore = w.arvore AND n.no = w.no JOIN fx ON fx.r = w.r WHERE c > 0
), scale AS (
  SELECT grupo, count(*) * CASE WHEN max(tamanho) = 2 THEN 1.0e0 WHEN max(tamanho) < 2 THEN 0.0e0 ELSE
    2.0e0 * (ln(max(tamanho) - 1.0e0) + 0.5772156649015329e0) - 2.0e0 * (max(tamanho) - 1.0e0) / max(tamanho) END AS s
  FROM nodes WHERE no = 1 GROUP BY grupo
), lengths AS (
  SELECT w.r, w.grupo, sum(CAST(round_even((n.profundidade + CASE WHEN tamanho <= 1 THEN 0.0e0 WHEN tamanho = 2 THEN 1.0e0 ELSE
    2.0e0 * (ln(tamanho - 1.0e0) + 0.5772156649015329e0) - 2.0e0 * (tamanho - 1.0e0) / tamanho END) * 1e9, 0) AS BIGINT)) AS total
  FROM walk w JOIN nodes n ON n.grupo = w.grupo AND n.arvore = w.arvore AND n.no = w.no WHERE c = 0 GROUP BY w.r, w.grupo
), raw AS (
  SELECT transacao_id, fx.grupo, pow(2.0e0, -(total / 1e9) / greatest(s, 1e-9)) AS bruto
  FROM lengths JOIN scale USING (grupo) JOIN fx USING (r)
), m1_rows AS (
  SELECT *, bruto >= p99 AS alerta, (bruto - lo) / greatest(hi - lo, 1e-9) AS score FROM raw JOIN (
    SELECT grupo, min(bruto) AS lo, max(bruto) AS hi, quantile_cont(bruto, 0.99e0) AS p99 FROM raw GROUP BY grupo
  ) USING (grupo)
)"""


NODES = """
SELECT grupo, arvore, no, CAST(c - 1 AS BIGINT) AS coluna, round(cut, 6) AS corte,
  CASE WHEN c > 0 THEN 2 * no ELSE -1 END AS esquerda, CASE WHEN c > 0 THEN 2 * no + 1 ELSE -1 END AS direita,
  tamanho, profundidade FROM nodes"""

M1_TEXT = "CASE WHEN alerta THEN 'Isolation Forest: padrão multivariado anômalo' END AS motivo"
M1_FINDINGS = f"""
SELECT grupo, transacao_id, 'M1_ISOLATION_FOREST' AS regra_id, 'FRAUDE' AS familia, alerta, round(score, 6) AS score,
  {M1_TEXT} FROM m1_rows"""


def network() -> str:
    """Reconstruction errors (`ae_rows`) of the profiles `prof` by the starting weights, and their threshold."""
    widths = (len(PROFILE_COLUMNS), *HIDDEN, len(PROFILE_COLUMNS))
    names = [f"CAST({c} AS DOUBLE)" for c in PROFILE_COLUMNS]
    z = ", ".join(
        f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1.0e0 END" for c in names
    )
    parts, at = [], 0
    for k, (rows, cols) in enumerate(zip(widths[:-1], widths[1:])):
        spread = f"(2.0e0 * {_hex(f'''md5('{_SEED}:' || place)''', 1, 13)} / 4503599627370496.0e0 - 1) / sqrt({rows}.0e0)"
        inner = f"bias[j] + list_inner_product(x, kernel[j])"
        out = inner if k == len(widths) - 2 else f"greatest({inner}, 0.0e0)"
        parts.append(
            f"w{k} AS (SELECT list(ks ORDER BY j) AS kernel, list(b ORDER BY j) AS bias FROM (SELECT j, "
            f"list(v ORDER BY i) FILTER (WHERE i < {rows}) AS ks, max(v) FILTER (WHERE i = {rows}) AS b FROM ("
            f"SELECT i, j, {spread} AS v FROM (SELECT i, j, {at} + i * {cols} + j AS place FROM "
            f"(SELECT unnest(range({rows + 1})) AS i) CROSS JOIN (SELECT unnest(range({cols})) AS j))) GROUP BY j)), "
            f"h{k} AS (SELECT associado_id, ano_mes, z, list_transform(range(1, {cols + 1}), lambda j: {out}) AS x "
            f"FROM {'scaled' if k == 0 else f'h{k - 1}'} CROSS JOIN w{k})"
        )
        at += rows * cols + cols
    last = len(widths) - 2
    held = f"{_hex(f'''md5('{_SEED}:' || associado_id || ':' || ano_mes)''', 1, 8)} % 5 = 0"
    return f"""
known AS (SELECT * FROM prof WHERE associado_id IS NOT NULL),
scaled AS (SELECT *, z AS x FROM (SELECT associado_id, ano_mes, [{z}] AS z FROM known)),
{', '.join(parts)}, ae_err AS (
  SELECT associado_id, ano_mes, list_avg(list_transform(list_zip(x, z), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS erro FROM h{last}
), ae_rows AS (
  SELECT associado_id, ano_mes, erro > t AS alerta, least(greatest(erro / greatest(2 * t, 1e-9), 0.0e0), 1.0e0) AS score
  FROM ae_err CROSS JOIN (SELECT quantile_cont(erro, 0.99e0) AS t FROM ae_err WHERE {held})
)"""


M2_TEXT = "CASE WHEN alerta THEN 'Autoencoder: erro de reconstrução acima do p99' END AS motivo"
M2_FINDINGS = f"""
SELECT associado_id, ano_mes, 'M2_AUTOENCODER' AS regra_id, 'FRAUDE' AS familia, alerta, round(score, 6) AS score,
  {M2_TEXT} FROM ae_rows"""


def calibration(labelled: str, steps: int = 40) -> str:
    """`model` (mean, deviation, weights with the intercept last) fitted to `labelled` (alerta_id, confirmado, scores)."""
    size = len(SCORE_COLUMNS) + 1
    scores = ", ".join(f"CAST({c} AS DOUBLE)" for c in SCORE_COLUMNS)
    lot = f"CAST({_hex(f'''md5('{_SEED}:' || alerta_id)''', 1, 13)} AS DOUBLE)"
    # Row a of the system: curvature, penalty on the diagonal but for the intercept, slope on the right.
    system = ", ".join(
        "[" + ", ".join(
            f"sum(p * (1 - p) * x[{a}] * x[{b}])" + (" + 1" if a == b < size else "") for b in range(1, size + 1)
        ) + f", sum((p - y) * x[{a}])" + (f" + any_value(w[{a}])" if a < size else "") + "]"
        for a in range(1, size + 1)
    )
    solved = f"SELECT any_value(step) AS step, any_value(w) AS w, [{system}] AS m FROM (SELECT *, " \
             "1 / (1 + exp(-list_inner_product(x, w))) AS p FROM cal_train CROSS JOIN (SELECT * FROM newton WHERE step < " \
             f"{steps})) HAVING count(*) > 0"
    for k in range(1, size + 1):
        solved = (
            f"SELECT step, w, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / m[{k}][{k}]) "
            f"ELSE list_transform(r, lambda v, j: v - r[{k}] * m[{k}][j] / m[{k}][{k}]) END) AS m FROM ({solved})"
        )
    return f"""
cal_in AS (SELECT alerta_id, confirmado, {lot} AS lot, [{scores}] AS s FROM ({labelled})),
cal_scale AS (
  SELECT [{', '.join(f'avg(s[{k}])' for k in range(1, size))}] AS mean,
    [{', '.join(f'CASE WHEN stddev_pop(s[{k}]) > 0 THEN stddev_pop(s[{k}]) ELSE 1.0e0 END' for k in range(1, size))}] AS dev FROM cal_in
), cal_z AS (
  SELECT alerta_id, confirmado, lot, list_append(list_transform(range(1, {size}), lambda k: (s[k] - mean[k]) / dev[k]), 1.0e0) AS x
  FROM cal_in CROSS JOIN cal_scale
), cal_train AS (
  SELECT x, CAST(confirmado AS DOUBLE) AS y FROM cal_z JOIN (
    SELECT confirmado, quantile_cont(lot, 0.25e0) AS cut FROM cal_z GROUP BY confirmado) USING (confirmado) WHERE lot > cut
), newton(step, w) AS (
  SELECT 0, list_transform(range({size}), lambda k: 0.0e0)
  UNION ALL
  SELECT step + 1, list_transform(range(1, {size + 1}), lambda k: w[k] - m[k][{size + 1}]) FROM ({solved})
), model AS (SELECT w FROM newton WHERE step = {steps})"""
