"""DuckDB SQL text for the oracle twins of the long-form statistics.

Only string building: the SQL is handed to DuckDB by the correctness check; no
part of the Spark plans goes through here.
"""

from __future__ import annotations


def unpivot(source: str, columns: list[str], cast: str = "DOUBLE", ids: list[str] = ()) -> str:
    """(ids..., column_name, value) from ``source`` (NULLs dropped, as the Spark side filters them)."""
    sel = ", ".join([*ids, *[f"CAST({c} AS {cast}) AS {c}" for c in columns]])
    return (f"(SELECT {', '.join([*ids, 'column_name', 'value'])} FROM (SELECT {sel} FROM {source}) "
            f"UNPIVOT (value FOR column_name IN ({', '.join(columns)})))")


def not_nan(cast: str) -> str:
    return "value IS NOT NULL" + (" AND NOT isnan(value)" if cast == "DOUBLE" else "")


def null_profile(source: str, types: dict[str, str]) -> str:
    cols = list(types)
    miss = ", ".join(
        f"CAST(count_if({c} IS NULL{' OR isnan(' + c + ')' if types[c] in ('double', 'float') else ''}) AS BIGINT) AS {c}"
        for c in cols)
    case = " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in types.items())
    return (f"SELECT column_name, CASE column_name {case} END AS data_type, n_rows, n_null, "
            f"n_null / n_rows AS null_share FROM (SELECT count(*) AS n_rows, {miss} FROM {source}) "
            f"UNPIVOT (n_null FOR column_name IN ({', '.join(cols)}))")


def value_counts(source: str, cols: list[str]) -> str:
    lv = unpivot(source, cols, "VARCHAR")
    return (f"SELECT column_name, value, n, n / sum(n) OVER (PARTITION BY column_name) AS share FROM "
            f"(SELECT column_name, value, count(*) AS n FROM {lv} WHERE value IS NOT NULL GROUP BY ALL)")


def describe_numeric(source: str, cols: list[str]) -> str:
    lv = unpivot(source, cols)
    return (f"SELECT column_name, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, "
            f"min(value) AS min, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, "
            f"quantile_cont(value, 0.75) AS p75, max(value) AS max FROM {lv} "
            f"WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY column_name")


def describe_categorical(source: str, cols: list[str]) -> str:
    lv = unpivot(source, cols, "VARCHAR")
    return (f"SELECT column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\", "
            f"max(CASE WHEN rn = 1 THEN value END) AS top, max(n) AS freq FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rn FROM ("
            f"SELECT column_name, value, count(*) AS n FROM {lv} WHERE value IS NOT NULL GROUP BY ALL)) "
            f"GROUP BY column_name")


def correlation(source: str, cols: list[str], where: str = "TRUE") -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    aggs = []
    for a, b in pairs:
        xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
        xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
        aggs.append(f"covar_pop({xa}, {xb}) / NULLIF(stddev_pop({xa}) * stddev_pop({xb}), 0) AS \"{a}|{b}\"")
    names = ", ".join(f'"{a}|{b}"' for a, b in pairs)
    return (f"SELECT split_part(pair, '|', 1) AS col_a, split_part(pair, '|', 2) AS col_b, r FROM ("
            f"SELECT {', '.join(aggs)} FROM (SELECT {sel} FROM {source})) "
            f"UNPIVOT INCLUDE NULLS (r FOR pair IN ({names})) WHERE {where}")


def histogram(source: str, cols: list[str], bins: int, by: str | None = None) -> str:
    ids = [by] if by else []
    lv = unpivot(source, cols, ids=ids)
    byc = f"{by}, " if by else ""
    grp = f" JOIN (SELECT DISTINCT column_name, {by} FROM lv) USING (column_name)" if by else ""
    return (f"WITH lv AS (SELECT * FROM {lv} WHERE value IS NOT NULL AND NOT isnan(value)), "
            f"e AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM lv GROUP BY column_name), "
            f"c AS (SELECT column_name, {byc}CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE "
            f"least(floor((value - lo) / (hi - lo) * {bins}) + 1, {bins}) END AS INTEGER) AS bin, count(*) AS n "
            f"FROM lv JOIN e USING (column_name) GROUP BY ALL), "
            f"g AS (SELECT * FROM (SELECT column_name, lo, hi, CAST(b AS INTEGER) AS bin FROM e, range(1, {bins + 1}) t(b)){grp}) "
            f"SELECT column_name, {byc}bin, lo + (bin - 1) * ((hi - lo) / {bins}) AS bin_lo, "
            f"lo + bin * ((hi - lo) / {bins}) AS bin_hi, coalesce(n, 0) AS n "
            f"FROM g LEFT JOIN c USING (column_name, {byc}bin)")


def boxplot(source: str, cols: list[str], by: str | None, whis: float = 1.5) -> str:
    ids = [by] if by else []
    lv = unpivot(source, cols, ids=ids)
    keys = ", ".join(["column_name", *ids])
    inside = f"value >= q1 - {whis} * (q3 - q1) AND value <= q3 + {whis} * (q3 - q1)"
    return (f"WITH lv AS (SELECT * FROM {lv} WHERE value IS NOT NULL AND NOT isnan(value)), "
            f"q AS (SELECT {keys}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
            f"quantile_cont(value, 0.75) AS q3 FROM lv GROUP BY ALL) "
            f"SELECT {keys}, q1, median, q3, min(CASE WHEN {inside} THEN value END) AS whisker_lo, "
            f"max(CASE WHEN {inside} THEN value END) AS whisker_hi, CAST(count_if(NOT ({inside})) AS BIGINT) AS n_outliers, "
            f"count(*) AS n FROM lv JOIN q USING ({keys}) GROUP BY {keys}, q1, median, q3")


def kde(source: str, cols: list[str], grid: int = 200, per_bandwidth: int = 8, cut: float = 3.0) -> str:
    lv = unpivot(source, cols)
    return (f"WITH lv AS (SELECT * FROM {lv} WHERE value IS NOT NULL AND NOT isnan(value)), "
            f"st AS (SELECT column_name, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd, "
            f"count(value) AS n FROM lv GROUP BY column_name), "
            f"st2 AS (SELECT *, sd * pow(n, -0.2) AS h FROM st), "
            f"b AS (SELECT column_name, floor((value - lo) / (h / {per_bandwidth})) AS b, "
            f"count(*) AS c FROM lv JOIN st2 USING (column_name) WHERE h > 0 GROUP BY ALL), "
            f"g AS (SELECT column_name, CAST(g AS INTEGER) AS g, lo, hi, h, n, "
            f"(lo - {cut} * h) + g * ((hi - lo + 2 * {cut} * h) / {grid - 1}) AS x FROM st2, range(0, {grid}) t(g) WHERE h > 0) "
            f"SELECT column_name, g, x, sum(c * exp(-0.5 * ((x - (lo + (b + 0.5) * (h / {per_bandwidth}))) / h) "
            f"* ((x - (lo + (b + 0.5) * (h / {per_bandwidth}))) / h)) / (n * h * sqrt(2 * pi()))) AS density "
            f"FROM g JOIN b USING (column_name) GROUP BY column_name, g, x")


def grid_counts(source: str, x: str, y: str, bins: int) -> str:
    def cell(v, lo, hi):
        return (f"CAST(CASE WHEN {hi} - {lo} = 0 THEN 1 ELSE least(floor(({v} - {lo}) / ({hi} - {lo}) * {bins}) + 1, {bins}) END AS INTEGER)")
    return (f"WITH d AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source} "
            f"WHERE {x} IS NOT NULL AND {y} IS NOT NULL AND NOT isnan({x}) AND NOT isnan({y})), "
            f"e AS (SELECT min(x) AS xlo, max(x) AS xhi, min(y) AS ylo, max(y) AS yhi FROM d) "
            f"SELECT '{x}' AS x_column, '{y}' AS y_column, {cell('x', 'xlo', 'xhi')} AS x_bin, "
            f"{cell('y', 'ylo', 'yhi')} AS y_bin, count(*) AS n FROM d, e GROUP BY ALL")


def pair_grid(source: str, columns: list[str], bins: int) -> str:
    """Joint equal-width counts of all pairs of columns."""
    cells = ", ".join(f"CAST(CASE WHEN {c} IS NULL THEN NULL WHEN hi_{c} = lo_{c} THEN 1 ELSE least(floor(({c} - lo_{c}) / (hi_{c} - lo_{c}) * {bins}) + 1, {bins}) END AS INTEGER) AS {c}"
                      for c in columns)
    pairs = " UNION ALL ".join(f"SELECT '{x}' AS x_column, '{y}' AS y_column, {x} AS x_bin, {y} AS y_bin, count(*) AS n FROM binned "
                               f"WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY ALL" for i, x in enumerate(columns) for y in columns[i + 1:])
    return (f"WITH d AS (SELECT {', '.join(f'CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}' for c in columns)} "
            f"FROM {source}), e AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in columns)} FROM d), "
            f"binned AS (SELECT {cells} FROM d, e) {pairs}")


def data_drift(source: str, flag: str, numeric: list[str], categorical: list[str], threshold: float) -> str:
    """Per-column KS / Wasserstein (numeric) and Jensen-Shannon / chi2 (categorical); ``flag`` marks reference rows."""
    nsel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in numeric)
    csel = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in categorical)
    return f"""
WITH nlv AS (
  SELECT {flag} AS is_ref, column_name, value FROM (SELECT {flag}, {nsel} FROM {source})
  UNPIVOT (value FOR column_name IN ({', '.join(numeric)})) WHERE value IS NOT NULL AND NOT isnan(value)
), ncnt AS (SELECT column_name, value, count_if(is_ref) AS n_ref, count_if(NOT is_ref) AS n_cur FROM nlv GROUP BY ALL
), ntot AS (SELECT column_name, count_if(is_ref) AS tot_ref, count_if(NOT is_ref) AS tot_cur,
                   stddev_pop(CASE WHEN is_ref THEN value END) AS ref_std FROM nlv GROUP BY ALL
), ncdf AS (
  SELECT c.column_name, value, ref_std,
         sum(n_ref) OVER w / tot_ref AS f_ref, sum(n_cur) OVER w / tot_cur AS f_cur, lead(value) OVER w2 AS nxt
  FROM ncnt c JOIN ntot USING (column_name)
  WINDOW w AS (PARTITION BY c.column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w2 AS (PARTITION BY c.column_name ORDER BY value)
), num AS (
  SELECT column_name, max(abs(f_ref - f_cur)) AS ks,
         sum(coalesce(abs(f_ref - f_cur) * (nxt - value), 0)) AS wasserstein, ref_std
  FROM ncdf GROUP BY column_name, ref_std
), clv AS (
  SELECT {flag} AS is_ref, column_name, value FROM (SELECT {flag}, {csel} FROM {source})
  UNPIVOT (value FOR column_name IN ({', '.join(categorical)})) WHERE value IS NOT NULL
), ccnt AS (SELECT column_name, value, count_if(is_ref) AS n_ref, count_if(NOT is_ref) AS n_cur FROM clv GROUP BY ALL
), ctot AS (SELECT column_name, sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM ccnt GROUP BY ALL
), cterm AS (
  SELECT column_name, n_ref / tot_ref AS p, n_cur / tot_cur AS q,
         (n_ref + n_cur) * tot_ref / (tot_ref + tot_cur) AS e_ref, (n_ref + n_cur) * tot_cur / (tot_ref + tot_cur) AS e_cur,
         n_ref, n_cur
  FROM ccnt JOIN ctot USING (column_name)
), cat AS (
  SELECT column_name,
         sqrt(greatest(sum(0.5 * CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                         + 0.5 * CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END), 0)) AS jensen_shannon,
         sum(pow(n_ref - e_ref, 2) / e_ref + pow(n_cur - e_cur, 2) / e_cur) AS chi2
  FROM cterm GROUP BY column_name
), report AS (
  SELECT column_name, 'numeric' AS kind, ks, wasserstein, wasserstein / greatest(ref_std, 0.001) AS wasserstein_norm,
         CAST(NULL AS DOUBLE) AS jensen_shannon, CAST(NULL AS DOUBLE) AS chi2,
         wasserstein / greatest(ref_std, 0.001) AS score FROM num
  UNION ALL
  SELECT column_name, 'categorical', NULL, NULL, NULL, jensen_shannon, chi2, jensen_shannon FROM cat
)
SELECT *, score > {threshold} AS drifted FROM report"""
