"""DuckDB SQL for every ``queries()`` key that SQL can express.

Views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are registered by the caller.
Column names and rounding match the Spark side exactly.
"""

from __future__ import annotations

LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
TOKEN = "4-NOT SPECIFIED"


def r(expr: str, d: int = 6) -> str:
    return f"round(({expr}) * 1e{d}) / 1e{d}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _a7() -> str:
    parts = []
    for c in LINEITEM_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({x}) AS \"count\", {r(f'avg({x})', 8)} AS mean, "
            f"{r(f'stddev_samp({x})', 8)} AS std, {r(f'min({x})')} AS \"min\", "
            f"{r(f'quantile_cont({x}, 0.25)')} AS q25, {r(f'quantile_cont({x}, 0.5)')} AS q50, "
            f"{r(f'quantile_cont({x}, 0.75)')} AS q75, {r(f'max({x})')} AS \"max\" FROM lineitem")
    return _union(parts)


def _moment(fn: str, name: str) -> str:
    return _union([f"SELECT '{c}' AS \"column\", {r(f'{fn}(CAST({c} AS DOUBLE))', 9)} AS {name} FROM lineitem"
                   for c in LINEITEM_NUMERIC])


def _a12() -> str:
    parts = []
    for c in LINEITEM_NUMERIC:
        parts.append(f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS n_outliers,
  {r(f"count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0::DOUBLE / count(*)")} AS pct_outliers
FROM lineitem, (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
                       quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi
                FROM lineitem) f""")
    return _union(parts)


def _pairs(cols):
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def _pearson(cols, digits=9) -> str:
    return _union([f"SELECT '{x}' AS col_x, '{y}' AS col_y, {r(f'corr(CAST({y} AS DOUBLE), CAST({x} AS DOUBLE))', digits)} AS corr FROM lineitem"
                   for x, y in _pairs(cols)])


def _spearman() -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}"
        for c in LINEITEM_MEASURES)
    body = _union([f"SELECT '{x}' AS col_x, '{y}' AS col_y, {r(f'corr(r_{x}, r_{y})', 9)} AS corr FROM rk"
                   for x, y in _pairs(LINEITEM_MEASURES)])
    return f"WITH rk AS (SELECT {ranks} FROM lineitem)\n{body}"


def _kendall_pair(x: str, y: str) -> str:
    return f"""SELECT '{x}' AS col_x, '{y}' AS col_y, {r('''(
    (SELECT sum(a.n * b.n * sign(b.y - a.y)) FROM c a JOIN c b ON a.x < b.x)
  ) / sqrt(((SELECT sum(n) FROM c) * ((SELECT sum(n) FROM c) - 1) / 2.0 - (SELECT sum(t * (t - 1) / 2.0) FROM tx))
         * ((SELECT sum(n) FROM c) * ((SELECT sum(n) FROM c) - 1) / 2.0 - (SELECT sum(t * (t - 1) / 2.0) FROM ty)))''', 9)} AS corr
FROM (SELECT 1)"""


def _kendall() -> str:
    cols = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
    parts = []
    for x, y in _pairs(cols):
        parts.append(f"""SELECT * FROM (
WITH c AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2),
     tx AS (SELECT sum(n) AS t FROM c GROUP BY x),
     ty AS (SELECT sum(n) AS t FROM c GROUP BY y)
{_kendall_pair(x, y)})""")
    return _union(parts)


def _heatmap() -> str:
    cols = LINEITEM_MEASURES
    upper = _pearson(cols)
    lower = _union([f"SELECT '{y}' AS col_x, '{x}' AS col_y, {r(f'corr(CAST({y} AS DOUBLE), CAST({x} AS DOUBLE))', 9)} AS corr FROM lineitem"
                    for x, y in _pairs(cols)])
    diag = _union([f"SELECT '{c}' AS col_x, '{c}' AS col_y, CASE WHEN stddev_pop({c}) > 0 THEN 1.0::DOUBLE END AS corr FROM lineitem"
                   for c in cols])
    return _union([upper, lower, diag])


def _histogram() -> str:
    parts = []
    for c in ["l_extendedprice", "l_quantity"]:
        parts.append(f"""SELECT * FROM (
WITH s AS (
  SELECT count({c}) AS n, min({c})::DOUBLE AS mn, max({c})::DOUBLE AS mx,
         quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem),
p AS (
  SELECT n, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi,
         (mx - mn) / (log2(n::DOUBLE) + 1.0) AS sturges, 2.0 * (q3 - q1) * pow(n::DOUBLE, -1.0 / 3.0) AS fd
  FROM s),
q AS (
  SELECT lo, hi, CAST(CASE WHEN (CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END) > 0
       THEN ceil((hi - lo) / (CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END)) ELSE 1 END AS BIGINT) AS bins
  FROM p),
b AS (
  SELECT CAST(least(greatest(floor(({c} - lo) * (bins / (hi - lo))), 0), bins - 1) AS BIGINT) AS bin, count(*) AS cnt
  FROM lineitem, q WHERE {c} IS NOT NULL GROUP BY 1),
g AS (SELECT lo, hi, bins, unnest(range(0, bins)) AS bin FROM q)
SELECT '{c}' AS "column", g.bin AS bin, {r('lo + g.bin * ((hi - lo) / bins)')} AS lo,
       {r('CASE WHEN g.bin = bins - 1 THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / bins) END')} AS hi,
       coalesce(b.cnt, 0) AS cnt
FROM g LEFT JOIN b ON g.bin = b.bin)""")
    return _union(parts)


def _spearman_missing() -> str:
    """Each pair ranks the rows on which both of its columns are present."""
    parts = []
    for x, y in _pairs(LINEITEM_MEASURES):
        ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r{i}" for i, c in enumerate((x, y)))
        parts.append(f"SELECT '{x}' AS col_x, '{y}' AS col_y, {r('corr(r0, r1)', 9)} AS corr "
                     f"FROM (SELECT {ranks} FROM li WHERE {x} IS NOT NULL AND {y} IS NOT NULL)")
    return f"""WITH li AS (SELECT CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity, l_extendedprice,
  nullif(l_discount, 0.05::DOUBLE) AS l_discount, nullif(l_tax, 0.02::DOUBLE) AS l_tax FROM lineitem)
{_union(parts)}"""


def _box(cls: str = "l_returnflag") -> str:
    parts = []
    for c in ["l_extendedprice", "l_quantity"]:
        parts.append(f"""SELECT * FROM (
WITH q AS (
  SELECT {cls} AS class, count({c}) AS n, quantile_cont({c}::DOUBLE, 0.25) AS q1,
         quantile_cont({c}::DOUBLE, 0.5) AS median, quantile_cont({c}::DOUBLE, 0.75) AS q3
  FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT '{c}' AS "column", f.class AS class, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
       {r(f'min(CASE WHEN {c} >= lo_f AND {c} <= hi_f THEN {c}::DOUBLE END)')} AS whislo,
       {r(f'max(CASE WHEN {c} >= lo_f AND {c} <= hi_f THEN {c}::DOUBLE END)')} AS whishi,
       count(*) FILTER (WHERE NOT ({c} >= lo_f AND {c} <= hi_f)) AS n_fliers, f.n AS n
FROM lineitem JOIN f ON lineitem.{cls} = f.class
WHERE {c} IS NOT NULL
GROUP BY f.class, q1, median, q3, f.n)""")
    return _union(parts)


def _split_cte(cls: str | None, seed: int, rounding: str = "ceil", frac: float = 0.2,
               extra: list[str] | None = None) -> str:
    """Per-class test sizes by the largest-remainder rule, then row_number by md5.

    ``extra`` columns are carried through ``h``/``rk``; rows with equal hashes (repeated
    keys) are then ordered by the key, class and extra columns, as the split orders them.
    """
    cls_expr = cls if cls else "0"
    extra_sel = "".join(f", {c}" for c in extra) if extra else ""
    ties = f", {KEY}, cls{extra_sel}" if extra else ""
    n_first = f"CAST(ceil({frac} * n) AS BIGINT)" if rounding == "ceil" else f"CAST(floor({frac} * n) AS BIGINT)"
    return f"""h AS (
  SELECT {KEY}{extra_sel}, {cls_expr} AS cls, md5(concat_ws('|', '{seed}', {KEY})) AS hh FROM lineitem),
cc AS (SELECT cls, count(*) AS nc FROM h GROUP BY cls),
tot AS (SELECT sum(nc) AS n FROM cc),
sz AS (SELECT n, {n_first} AS n_test, n - {n_first} AS n_train FROM tot),
al AS (
  SELECT cls, nc, (nc * n_train) // n AS base, (nc * n_train) % n AS rem, n_train FROM cc, sz),
lr AS (
  SELECT cls, nc, base, row_number() OVER (ORDER BY rem DESC, cls) AS pos,
         n_train - sum(base) OVER () AS left_over FROM al),
te AS (SELECT cls, nc - (base + CASE WHEN pos <= left_over THEN 1 ELSE 0 END) AS n_test_c FROM lr),
rk AS (SELECT h.*, row_number() OVER (PARTITION BY cls ORDER BY hh{ties}) AS rn FROM h)"""


def _f8() -> str:
    return f"""WITH {_split_cte('l_returnflag', 42)}
SELECT {KEY}, cls AS l_returnflag, CASE WHEN rn <= n_test_c THEN 'test' ELSE 'train' END AS split
FROM rk JOIN te USING (cls)"""


def _f9() -> str:
    return f"""WITH {_split_cte(None, 42)}
SELECT {KEY}, CASE WHEN rn <= n_test_c THEN 'test' ELSE 'train' END AS split
FROM rk JOIN te USING (cls)"""


def _f11() -> str:
    return f"""WITH {_split_cte(None, 7, 'floor')}
SELECT {KEY}, rn <= n_test_c AS is_validation
FROM rk JOIN te USING (cls)"""


def _f8_hot() -> str:
    cte = _split_cte("l_returnflag", 42, extra=["l_quantity"]).replace(
        f"md5(concat_ws('|', '42', {KEY}))", "md5(concat_ws('|', '42', l_returnflag))")
    return f"""WITH {cte}
SELECT {KEY}, cls AS l_returnflag, l_quantity, CASE WHEN rn <= n_test_c THEN 'test' ELSE 'train' END AS split
FROM rk JOIN te USING (cls)"""


def _f13() -> str:
    return f"""WITH h AS (
  SELECT {KEY}, l_returnflag, md5(concat_ws('|', '42', {KEY})) AS hh FROM lineitem)
SELECT {KEY}, l_returnflag,
       CAST((row_number() OVER (PARTITION BY l_returnflag ORDER BY hh) - 1) % 3 AS INTEGER) AS fold
FROM h"""


_MODE = f"""(SELECT o_orderpriority FROM orders WHERE o_orderpriority <> '{TOKEN}'
          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""

_SUMMARY = f"""WITH t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, nullif(o_orderpriority, '{TOKEN}') AS o_orderpriority
  FROM orders),
m AS (
  SELECT count(*) AS n_rows,
         count(*) FILTER (WHERE o_orderkey IS NULL) AS m1, count(*) FILTER (WHERE o_custkey IS NULL) AS m2,
         count(*) FILTER (WHERE o_orderstatus IS NULL) AS m3,
         count(*) FILTER (WHERE o_totalprice IS NULL OR isnan(o_totalprice)) AS m4,
         count(*) FILTER (WHERE o_orderpriority IS NULL) AS m5,
         min(o_orderkey) IS NOT DISTINCT FROM max(o_orderkey) AS k1,
         min(o_custkey) IS NOT DISTINCT FROM max(o_custkey) AS k2,
         min(o_orderstatus) IS NOT DISTINCT FROM max(o_orderstatus) AS k3,
         min(o_totalprice) IS NOT DISTINCT FROM max(o_totalprice) AS k4,
         min(o_orderpriority) IS NOT DISTINCT FROM max(o_orderpriority) AS k5
  FROM t),
d AS (SELECT (SELECT count(*) FROM t) - count(*) AS n_duplicate_rows FROM (SELECT DISTINCT * FROM t))
SELECT n_rows, 5 AS n_columns, n_duplicate_rows,
  concat_ws(',', CASE WHEN m1 > 0 THEN 'o_orderkey' END, CASE WHEN m2 > 0 THEN 'o_custkey' END,
            CASE WHEN m3 > 0 THEN 'o_orderstatus' END, CASE WHEN m4 > 0 THEN 'o_totalprice' END,
            CASE WHEN m5 > 0 THEN 'o_orderpriority' END) AS columns_with_missing,
  concat_ws(',', CASE WHEN k1 THEN 'o_orderkey' END, CASE WHEN k2 THEN 'o_custkey' END,
            CASE WHEN k3 THEN 'o_orderstatus' END, CASE WHEN k4 THEN 'o_totalprice' END,
            CASE WHEN k5 THEN 'o_orderpriority' END) AS constant_columns
FROM m, d"""

_LINEITEM_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _a4() -> str:
    parts = [f"SELECT '{c}' AS \"column\", min({c}) IS NOT DISTINCT FROM max({c}) AS is_constant FROM lineitem"
             for c in _LINEITEM_ALL]
    parts.append("SELECT 'l_source' AS \"column\", true AS is_constant")
    return _union(parts)


def _freq(table: str, cols: list[str]) -> str:
    return _union([f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM {table} "
                   f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in cols])


def _one_hot() -> str:
    return f"""SELECT o_orderkey, o_custkey, o_totalprice,
  CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P,
  CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH",
  CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS "o_orderpriority_3-MEDIUM",
  CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS "o_orderpriority_4-NOT SPECIFIED",
  CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "o_orderpriority_5-LOW"
FROM orders"""


def _scale() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LINEITEM_MEASURES)
    cols = ", ".join(
        f"{r(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END')} AS {c}"
        for c in LINEITEM_MEASURES)
    return f"SELECT {KEY}, {cols} FROM lineitem, (SELECT {stats} FROM lineitem) s"



def _f7() -> str:
    """Scale the test split with statistics of the train split."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LINEITEM_MEASURES)
    cols = ", ".join(
        f"{r(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END')} AS {c}"
        for c in LINEITEM_MEASURES)
    return f"""WITH {_split_cte('l_returnflag', 42, extra=LINEITEM_MEASURES)},
d AS (SELECT {KEY}, {", ".join(LINEITEM_MEASURES)}, CASE WHEN rn <= n_test_c THEN 'test' ELSE 'train' END AS split
      FROM rk JOIN te USING (cls)),
s AS (SELECT {stats} FROM d WHERE split = 'train')
SELECT {KEY}, {cols} FROM d, s WHERE split = 'test'"""


_METRICS = f"""WITH c AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality <> 1 AND toxic = 1) AS fp,
         count(*) FILTER (WHERE quality = 1 AND toxic <> 1) AS fn, count(*) FILTER (WHERE quality <> 1 AND toxic <> 1) AS tn,
         count(*) FILTER (WHERE quality = toxic) AS correct
  FROM labels)
SELECT n, tp, fp, fn, tn,
  {r('coalesce(correct::DOUBLE / nullif(n, 0), 0)', 9)} AS accuracy,
  {r('coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0)', 9)} AS "precision",
  {r('coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)', 9)} AS recall,
  {r('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)', 9)} AS f1
FROM c"""

_CONFUSION = """WITH v AS (SELECT quality AS v FROM labels UNION SELECT toxic FROM labels),
c AS (SELECT quality AS label, toxic AS prediction, count(*) AS cnt FROM labels GROUP BY 1, 2)
SELECT a.v AS label, b.v AS prediction, coalesce(c.cnt, 0) AS cnt
FROM v a CROSS JOIN v b LEFT JOIN c ON c.label = a.v AND c.prediction = b.v"""

_REPORT = f"""WITH v AS (SELECT quality AS v FROM labels UNION SELECT toxic FROM labels),
per AS (
  SELECT v AS k,
         (SELECT count(*) FROM labels WHERE quality = v) AS support,
         (SELECT count(*) FROM labels WHERE toxic = v) AS npred,
         (SELECT count(*) FROM labels WHERE quality = v AND toxic = v) AS tp
  FROM v),
m AS (
  SELECT CAST(k AS VARCHAR) AS class, support, tp,
         coalesce(tp::DOUBLE / nullif(npred, 0), 0) AS p, coalesce(tp::DOUBLE / nullif(support, 0), 0) AS rc,
         coalesce(2.0 * tp / nullif(npred + support, 0), 0) AS f
  FROM per)
SELECT class, {r('p', 9)} AS "precision", {r('rc', 9)} AS recall, {r('f', 9)} AS f1, support FROM m
UNION ALL SELECT 'accuracy', {r('sum(tp)::DOUBLE / sum(support)', 9)}, {r('sum(tp)::DOUBLE / sum(support)', 9)},
                 {r('sum(tp)::DOUBLE / sum(support)', 9)}, sum(support) FROM m
UNION ALL SELECT 'macro avg', {r('avg(p)', 9)}, {r('avg(rc)', 9)}, {r('avg(f)', 9)}, sum(support) FROM m
UNION ALL SELECT 'weighted avg', {r('sum(p * support) / sum(support)', 9)}, {r('sum(rc * support) / sum(support)', 9)},
                 {r('sum(f * support) / sum(support)', 9)}, sum(support) FROM m"""


# The text patterns a reader accepts as integer / floating numbers.
INT_RE = r"^[+-]?[0-9]+$"
FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|Inf|INF|infinity|Infinity)$"
_TABLE_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


def _infer() -> str:
    parts = []
    for table, cols in _TABLE_COLUMNS.items():
        for c in cols:
            parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS "column", CASE
  WHEN count(v) = 0 THEN 'double'
  WHEN bool_and(v IS NULL OR (regexp_full_match(v, '{INT_RE}') AND try_cast(v AS BIGINT) IS NOT NULL)) THEN 'bigint'
  WHEN bool_and(v IS NULL OR regexp_full_match(v, '{FLOAT_RE}') OR v IN ('nan', 'NaN', '-nan', '-NaN')) THEN 'double'
  WHEN bool_and(v IS NULL OR v IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) THEN 'boolean'
  ELSE 'string' END AS inferred
FROM (SELECT CAST({c} AS VARCHAR) AS v FROM {table})""")
    return _union(parts)


SQRT_2PI = 2.5066282746310002


def _density() -> str:
    """The kernel sum over the raw rows."""
    c = "l_extendedprice"
    kernel = f"1e6 * sum(exp(-0.5 * ((x - v) / bw) * ((x - v) / bw)) / (n * bw * {SQRT_2PI}))"
    return f"""WITH p AS (
  SELECT count({c}) AS n, stddev_samp({c}) AS s, min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM lineitem),
q AS (SELECT n, lo, hi, s * pow(n::DOUBLE, -0.2) AS bw FROM p WHERE n > 1 AND s > 0),
raw AS (SELECT {c}::DOUBLE AS v FROM lineitem WHERE {c} IS NOT NULL),
g AS (SELECT CAST(i AS INTEGER) AS i, lo + i * (hi - lo) / 199 AS x FROM q, range(0, 200) t(i))
SELECT '{c}' AS "column", i, {r('x')} AS x,
  {r(kernel)} AS density
FROM g, raw, q GROUP BY i, x"""


_BUILD = f"""WITH t AS (
  SELECT DISTINCT o_orderkey, o_custkey, o_totalprice,
         CAST(coalesce(trim(o_orderstatus) = 'F', false) AS INTEGER) AS label,
         coalesce(nullif(o_orderpriority, '{TOKEN}'), {_MODE}) AS pr
  FROM orders),
h AS (SELECT *, md5(concat_ws('|', '42', o_orderkey)) AS hh FROM t),
cc AS (SELECT label AS cls, count(*) AS nc FROM h GROUP BY label),
tot AS (SELECT sum(nc) AS n FROM cc),
sz AS (SELECT n, CAST(ceil(0.2 * n) AS BIGINT) AS n_test, n - CAST(ceil(0.2 * n) AS BIGINT) AS n_train FROM tot),
al AS (SELECT cls, nc, (nc * n_train) // n AS base, (nc * n_train) % n AS rem, n_train FROM cc, sz),
lr AS (SELECT cls, nc, base, row_number() OVER (ORDER BY rem DESC, cls) AS pos,
              n_train - sum(base) OVER () AS left_over FROM al),
te AS (SELECT cls, nc - (base + CASE WHEN pos <= left_over THEN 1 ELSE 0 END) AS n_test_c FROM lr),
rk AS (SELECT h.*, row_number() OVER (PARTITION BY label ORDER BY hh) AS rn FROM h)
SELECT o_orderkey, o_custkey, o_totalprice, label,
  CAST(pr = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH",
  CAST(pr = '3-MEDIUM' AS INTEGER) AS "o_orderpriority_3-MEDIUM",
  CAST(pr = '5-LOW' AS INTEGER) AS "o_orderpriority_5-LOW",
  CASE WHEN rn <= n_test_c THEN 'test' ELSE 'train' END AS split
FROM rk JOIN te ON rk.label = te.cls"""


# Same rules as _rule_models() in __spark_entry__.py, in run order.
RULES = [
    ("discount_ge_005", "l_discount >= 0.05"),
    ("quantity_gt_25", "l_quantity > 25"),
    ("tax_lt_004", "l_tax < 0.04"),
    ("never_positive", "false"),
]


def _ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 0.0)"


def _rule_counts() -> str:
    preds = ", ".join(f"CAST({e} AS INTEGER) AS p{i}" for i, (_, e) in enumerate(RULES))
    parts = [
        f"""SELECT {i} AS run_order, '{n}' AS model, count(*) AS n,
  count(*) FILTER (WHERE y = 1 AND p{i} = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND p{i} = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND p{i} <> 1) AS fn, count(*) FILTER (WHERE y <> 1 AND p{i} <> 1) AS tn FROM s"""
        for i, (n, _) in enumerate(RULES)]
    return f"""s AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, {preds} FROM lineitem),
c AS ({_union(parts)}),
m AS (SELECT run_order, model, n, tp, fp, fn, tn, {_ratio('tp + tn', 'n')} AS accuracy,
  {_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'tp + fn')} AS recall,
  {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM c)"""


_E7 = f"""WITH {_rule_counts()}
SELECT run_order, model, n, tp, fp, fn, tn, {r('accuracy', 9)} AS accuracy, {r('precision', 9)} AS precision,
  {r('recall', 9)} AS recall, {r('f1', 9)} AS f1 FROM m"""

_V7 = f"""WITH {_rule_counts()}
SELECT model, 0 AS label, 0 AS prediction, tn AS cnt FROM m
UNION ALL SELECT model, 0, 1, fp FROM m
UNION ALL SELECT model, 1, 0, fn FROM m
UNION ALL SELECT model, 1, 1, tp FROM m"""

_O4 = f"""WITH {_rule_counts()}
SELECT run_order, model, {r('f1', 9)} AS f1 FROM m ORDER BY f1 DESC, run_order LIMIT 1"""


def _mode(table: str, cols: list[str]) -> str:
    return _union([f"""SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS cnt
  FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)""" for c in cols])


# Python's str.isspace() set (what the strip removes): the Unicode White_Space
# characters plus U+001C..U+001F.
_WS = [9, 10, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x1F, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
       0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WS_SQL = " || ".join(f"chr({c})" for c in _WS)


def _trim(c: str) -> str:
    return f"trim({c}, {_WS_SQL})"

ORACLE: dict[str, str] = {
    "a7_summary": _a7(),
    "a8_skew": _moment("skewness", "skew"),
    "a9_kurt": _moment("kurtosis", "kurtosis"),
    "s3_null_tokens": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  nullif(o_orderpriority, '{TOKEN}') AS o_orderpriority FROM orders""",
    "s6_infer_types": _infer(),
    "a1_missing": f"""SELECT 'o_orderpriority' AS "column",
  count(*) FILTER (WHERE o_orderpriority = '{TOKEN}') AS missing_count,
  {r(f"count(*) FILTER (WHERE o_orderpriority = '{TOKEN}') * 100.0::DOUBLE / count(*)")} AS missing_pct
FROM orders""",
    "c2_mode_impute": f"""SELECT o_orderkey, coalesce(nullif(o_orderpriority, '{TOKEN}'), {_MODE}) AS o_orderpriority
FROM orders""",
    "c5_dedup_events": "SELECT DISTINCT event_type, user_id FROM events",
    "c5_dedup_lineitem": "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem",
    "a2_dup_count_events": """SELECT (SELECT count(*) FROM events)
  - (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id FROM events)) AS n_duplicate_rows""",
    "a2_dup_count_lineitem": """SELECT (SELECT count(*) FROM lineitem)
  - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem))
  AS n_duplicate_rows""",
    "a3_cardinality": _union([f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values FROM part"
                              for c in ["p_name", "p_brand", "p_type"]]),
    "a4_constant": _a4(),
    "a5_summary": _SUMMARY,
    "a10_top_n": f"""SELECT "column", value, cnt, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS rank FROM (
{_freq('part', ['p_brand', 'p_type'])})) WHERE rank <= 5""",
    "v4_category_freq": _freq("part", ["p_brand", "p_type"]),
    "a11_outliers": """SELECT event_id, value FROM events,
  (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) q
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
    "a12_outlier_summary": _a12(),
    "a13_pearson": _pearson(LINEITEM_NUMERIC),
    "a14_spearman": _spearman(),
    "a15_kendall": _kendall(),
    "v5_heatmap": _heatmap(),
    "a16_distribution": f"""SELECT CAST(quality AS VARCHAR) AS value, count(*) AS cnt,
  {r('count(*)::DOUBLE / sum(count(*)) OVER ()', 9)} AS share FROM labels WHERE quality IS NOT NULL GROUP BY quality""",
    "v6_balance": f"""SELECT CAST(toxic AS VARCHAR) AS value, count(*) AS cnt,
  {r('count(*)::DOUBLE / sum(count(*)) OVER ()', 9)} AS share FROM labels WHERE toxic IS NOT NULL GROUP BY toxic""",
    "v1_histogram": _histogram(),
    "v2_density": _density(),
    "v3_box_stats": _box(),
    "f1_target": "SELECT o_orderkey, CAST(coalesce(trim(o_orderstatus) = 'F', false) AS INTEGER) AS label FROM orders",
    "f2_one_hot": _one_hot(),
    "f3_vector_one_hot": """SELECT o_orderkey, concat_ws(',',
  CAST(o_orderstatus = 'O' AS INTEGER), CAST(o_orderstatus = 'P' AS INTEGER),
  CAST(o_orderpriority = '2-HIGH' AS INTEGER), CAST(o_orderpriority = '3-MEDIUM' AS INTEGER),
  CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER), CAST(o_orderpriority = '5-LOW' AS INTEGER)) AS onehot
FROM orders""",
    "f6_scale": _scale(),
    "f8_split": _f8(),
    "f9_split_plain": _f9(),
    "f11_holdout": _f11(),
    "f13_folds": _f13(),
    "e1_e4_metrics": _METRICS,
    "e6_confusion": _CONFUSION,
    "e5_report": _REPORT,
    "w2_build_table": _BUILD,
    "f7_scale_holdout": _f7(),
    "s10_split_sink": f"""WITH {_split_cte('l_returnflag', 42)}
SELECT {KEY}, cls AS l_returnflag FROM rk JOIN te USING (cls) WHERE rn <= n_test_c""",
    "e7_compare": _E7,
    "v7_confusion_models": _V7,
    "o4_best_model": _O4,
    "c3_mode": _mode("part", ["p_brand", "p_type", "p_size", "p_name"]),
    "a17_missing_one": f"""SELECT 'o_orderpriority' AS "column",
  count(*) FILTER (WHERE o_orderpriority = '{TOKEN}') AS missing_count,
  {r(f"count(*) FILTER (WHERE o_orderpriority = '{TOKEN}') * 100.0::DOUBLE / count(*)")} AS missing_pct
FROM orders""",
    "s5_strip": f"""SELECT doc_id, {_trim('text')} AS text, {_trim('lang')} AS lang, {_trim('source')} AS source,
  n_chars FROM documents""",
    "s2_csv_scan": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  nullif(o_orderpriority, '{TOKEN}') AS o_orderpriority FROM orders""",
    "f8_split_hot_key": _f8_hot(),
    "f13_folds_repeated_key": f"""SELECT {KEY}, l_returnflag, l_quantity, CAST((row_number() OVER (PARTITION BY l_returnflag
  ORDER BY md5(concat_ws('|', '42', l_suppkey)), {KEY}, l_quantity) - 1) % 3 AS INTEGER) AS fold FROM lineitem""",
    "j1_pair_by_key": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
    "c4_fill_constant": """SELECT event_id, CASE WHEN event_id % 7 = 0 OR value IS NULL OR isnan(value) THEN -1.0
  ELSE value END::DOUBLE AS value FROM events""",
    "w1_clean": f"""SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  coalesce(nullif(o_orderpriority, '{TOKEN}'), {_MODE}) AS o_orderpriority FROM orders""",
    "a7_special_values": f"""WITH v AS (SELECT CASE event_id % 50 WHEN 0 THEN 'Infinity'::DOUBLE
  WHEN 1 THEN '-Infinity'::DOUBLE ELSE value END AS x FROM events),
k AS (SELECT x FROM v WHERE x IS NOT NULL AND NOT isnan(x))
SELECT 'value' AS "column", count(x) AS "count", min(x) AS min, {r('quantile_cont(x, 0.25)')} AS q25,
  {r('quantile_cont(x, 0.5)')} AS q50, {r('quantile_cont(x, 0.75)')} AS q75, max(x) AS max FROM k""",
    "p2_column_roles": """SELECT DISTINCT table_name, column_name AS "column",
  CASE WHEN data_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS role
FROM information_schema.columns WHERE table_name IN ('lineitem', 'orders', 'part')
  AND (data_type IN ('VARCHAR', 'TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE') OR data_type LIKE 'DECIMAL%')""",
    "s4_header_strip": "SELECT p_partkey, p_name, p_brand FROM part",
    "s8_load_counts": _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
                              for t in ("orders", "lineitem", "documents")]),
    "s9_table_sink": "SELECT * EXCLUDE (o_orderdate) FROM orders",
    "s12_predictions": f"SELECT {KEY}, CAST(l_quantity > 25 AS INTEGER) AS prediction FROM lineitem",
    "s14_run_log": f"""WITH {_rule_counts()}
""" + _union([f"SELECT model AS run_name, 'baseline' AS version, '{k}' AS name, {r(k, 9)} AS value FROM m"
              for k in ("accuracy", "precision", "recall", "f1")]),
    "s15_report_sink": _union(
        [f"SELECT 'cardinality' AS section, column_name AS \"column\", NULL::VARCHAR AS value, n AS cnt FROM "
         f"(SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n FROM part)" for c in ["p_name", "p_brand", "p_type"]]
        + [f"SELECT 'levels', '{c}', {c}, count(*) FROM part WHERE {c} IS NOT NULL GROUP BY {c}"
           for c in ("p_brand", "p_type")]),
    "w3_explore": _union(
        ["""SELECT 'level' AS section, 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS cnt
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""",
         """SELECT 'class', 'o_orderstatus', o_orderstatus, count(*) FROM orders
WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus"""]
        + [f"SELECT '{s}', '{c}', NULL, count({c}) FROM orders" for s in ("numeric", "histogram")
           for c in ("o_orderkey", "o_custkey", "o_totalprice")]),
    "w5_score_bundle": f"""WITH {_split_cte('l_returnflag', 42)}
SELECT {KEY}, true AS p_in_range, true AS threshold_holds, true AS same_as_unsaved
FROM rk JOIN te USING (cls) WHERE rn <= n_test_c""",
    "c6_removed_rows": """SELECT (SELECT count(*) FROM events)
  - (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id FROM events)) AS removed""",
    "f5_unseen_levels": """SELECT o_orderkey,
  CAST(coalesce(o_orderpriority = '3-MEDIUM', false) AS INTEGER) AS "o_orderpriority_3-MEDIUM",
  CAST(coalesce(o_orderpriority = '4-NOT SPECIFIED', false) AS INTEGER) AS "o_orderpriority_4-NOT SPECIFIED",
  CAST(coalesce(o_orderpriority = '5-LOW', false) AS INTEGER) AS "o_orderpriority_5-LOW" FROM orders""",
    "s2_csv_quoted": "SELECT doc_id, text FROM documents",
    "s2_csv_split": "SELECT doc_id, text, lang FROM documents",
    "v3_box_stats_by_order": _box("l_orderkey"),
    "a14_spearman_missing": _spearman_missing(),
    **{k: f"""WITH {_split_cte("CAST(l_returnflag = 'R' AS INTEGER)", 42)}
SELECT {KEY}, cls AS label, true AS p_in_range, true AS threshold_holds FROM rk JOIN te USING (cls) WHERE rn <= n_test_c"""
       for k in ("m2_gbt_score", "m2_xgboost_score_30_rounds", "m3_mlp_score")},
    "m7_tune_gbt_grid_of_2": """SELECT candidate::INTEGER AS candidate, params, true AS f1_in_range FROM (VALUES
  (0, 'max_depth=2 n_estimators=5'), (1, 'max_depth=3 n_estimators=5')) v(candidate, params) WHERE EXISTS (FROM lineitem)""",
    "m8_tune_mlp_grid_of_2": """SELECT candidate::INTEGER AS candidate, params, true AS f1_in_range FROM (VALUES
  (0, 'batch_size=64 hidden_layer_sizes=(8,) learning_rate_init=0.01'),
  (1, 'batch_size=64 hidden_layer_sizes=(16, 8) learning_rate_init=0.01')) v(candidate, params) WHERE EXISTS (FROM lineitem)""",
    "w4_train": """SELECT m || '_' || v AS run_name, m AS model_key, v AS version, name, true AS in_range, true AS best_has_greatest_f1
FROM (VALUES ('xgboost'), ('mlp')) a(m), (VALUES ('baseline'), ('tuned')) b(v),
  (VALUES ('accuracy'), ('precision'), ('recall'), ('f1')) c(name) WHERE EXISTS (FROM lineitem)""",
    "x5_rounded_report": _union([f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 2) AS mean,
  round(stddev_samp({c}), 2) AS std FROM lineitem""" for c in ("l_quantity", "l_linenumber")]),
    "c5_dedup_by_digest": "SELECT DISTINCT * EXCLUDE (l_shipdate) FROM lineitem",
    "a2_dup_count_by_digest": """WITH r AS (SELECT * EXCLUDE (l_shipdate) FROM lineitem
  UNION ALL SELECT * EXCLUDE (l_shipdate) FROM lineitem WHERE l_orderkey % 7 = 0)
SELECT (SELECT count(*) FROM r) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r)) AS n_duplicate_rows""",
    "s7_missing_path": _union([f"SELECT '{t}' AS table_name, 'parquet' AS suffix, count(*) AS n_rows FROM {t} "
                               f"UNION ALL SELECT '{t}', 'absent', NULL" for t in ("orders", "lineitem", "part")]),
}
