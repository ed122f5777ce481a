"""DuckDB twins of the registered queries (independent SQL formulations).

Each string runs on the pre-registered parquet views. The fixture view and the
batch numbering are shared CTEs; column lists are written out from the fixed
fixture schema.
"""

from __future__ import annotations

from tidemark.plans import catalog
from tidemark.sources.tables import BASE_SQL

BATCH_SIZE = 2000

TX_COLS = [
    "Transaction_ID", "Customer_ID", "Transaction_Date", "Transaction_Amount", "Account_Balance", "Age",
    "Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type", "State", "Gender",
    "Bank_Branch", "Is_Fraud",
]
NUM_COLS = ["Transaction_ID", "Customer_ID", "Transaction_Amount", "Account_Balance", "Age", "Is_Fraud"]
CAT_COLS = ["Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type", "State", "Gender", "Bank_Branch"]

TXN = f"""WITH {BASE_SQL},
transactions AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE Transaction_ID % 50 = 7),
batched AS MATERIALIZED (
  SELECT * EXCLUDE (__rn), CAST(__rn - 1 AS BIGINT) AS row_idx,
         CAST((__rn - 1) // {BATCH_SIZE} AS INTEGER) AS batch_index
  FROM (SELECT *, row_number() OVER (ORDER BY Transaction_Date ASC NULLS LAST, Transaction_ID ASC NULLS LAST) AS __rn
        FROM transactions))"""

ALL = ", ".join(TX_COLS)
MISSING_CELLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in TX_COLS)


def mode_cte(name: str, table: str, col: str, key: str = "batch_index") -> str:
    """Most frequent non-NULL value per key, smallest on ties."""
    return f"""{name} AS (
  SELECT {key}, v AS {name}_v FROM (
    SELECT {key}, {col} AS v,
           row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {col} ASC) AS rn
    FROM {table} WHERE {col} IS NOT NULL GROUP BY {key}, {col}) WHERE rn = 1)"""


DUP = f"""dup AS (
  SELECT batch_index, CAST(sum(c - 1) AS BIGINT) AS duplicates
  FROM (SELECT batch_index, count(*) AS c FROM batched GROUP BY batch_index, {ALL}) GROUP BY batch_index)"""

Q = {}

Q["assign_batches"] = f"""{TXN}
SELECT * FROM batched"""

Q["batch_meta"] = f"""{TXN},
{DUP},
{mode_cte('tt', 'batched', 'Transaction_Type')},
{mode_cte('dv', 'batched', 'Device_Type')},
agg AS (
  SELECT batch_index, CAST(count(*) AS BIGINT) AS n_rows, CAST({len(TX_COLS)} AS INTEGER) AS n_cols,
         min(Transaction_Date) AS date_min, max(Transaction_Date) AS date_max,
         CAST(sum({MISSING_CELLS}) AS BIGINT) AS missing_total,
         CAST(sum(Is_Fraud) AS BIGINT) AS fraud_count,
         round(avg(Is_Fraud) * 100.0, 2) AS fraud_rate,
         round(avg(Transaction_Amount), 2) AS amount_mean,
         round(stddev_samp(Transaction_Amount), 2) AS amount_std,
         round(avg(Account_Balance), 2) AS balance_mean,
         CAST(count(DISTINCT State) AS BIGINT) AS unique_states
  FROM batched GROUP BY batch_index)
SELECT a.batch_index, n_rows, n_cols, date_min, date_max, missing_total,
       round(CAST(missing_total AS DOUBLE) / (n_rows * n_cols) * 100.0, 2) AS missing_pct,
       CAST(coalesce(d.duplicates, 0) AS BIGINT) AS duplicates, fraud_count, fraud_rate,
       amount_mean, amount_std, balance_mean, tt_v AS top_transaction_type, dv_v AS top_device_type, unique_states
FROM agg a LEFT JOIN dup d USING (batch_index) LEFT JOIN tt USING (batch_index) LEFT JOIN dv USING (batch_index)"""

QUALITY = f"""{TXN},
{DUP},
agg AS (
  SELECT batch_index, CAST(count(*) AS BIGINT) AS n_rows,
         CAST(sum({MISSING_CELLS}) AS BIGINT) AS missing,
         round(avg(Is_Fraud) * 100.0, 2) AS fraud_rate,
         CAST(sum(Is_Fraud) AS BIGINT) AS fraud_count,
         CAST(count(*) FILTER (WHERE Is_Fraud = 0) AS BIGINT) AS legit_count,
         round(avg(Transaction_Amount), 2) AS amount_mean,
         round(stddev_samp(Transaction_Amount), 2) AS amount_std,
         round(avg(Account_Balance), 2) AS balance_mean
  FROM batched GROUP BY batch_index),
rep AS (
  SELECT a.batch_index, n_rows,
         round(CAST(missing AS DOUBLE) / (n_rows * {len(TX_COLS)}) * 100.0, 2) AS missing_pct_total,
         CAST(coalesce(duplicates, 0) AS BIGINT) AS duplicates_count,
         round(CAST(coalesce(duplicates, 0) AS DOUBLE) / n_rows * 100.0, 2) AS duplicates_pct,
         fraud_rate, fraud_count, legit_count, amount_mean, amount_std, balance_mean
  FROM agg a LEFT JOIN dup USING (batch_index)),
gated AS (
  SELECT *, coalesce(missing_pct_total <= 30.0, false) AS missing_ok,
         coalesce(duplicates_pct <= 5.0, false) AS duplicates_ok,
         coalesce(fraud_rate <= 50.0, false) AS fraud_rate_ok
  FROM rep)"""

Q["quality_report"] = f"""{QUALITY}
SELECT *, missing_ok AND duplicates_ok AND fraud_rate_ok AS passed FROM gated"""

Q["quality_gate"] = f"""{QUALITY}
SELECT batch_index, missing_ok, duplicates_ok, fraud_rate_ok, missing_ok AND duplicates_ok AND fraud_rate_ok AS passed
FROM gated"""

Q["missing_per_column"] = f"""{TXN}
SELECT batch_index, column_name, CAST(missing_count AS BIGINT) AS missing_count FROM (
""" + "\nUNION ALL\n".join(
    f"  SELECT batch_index, '{c}' AS column_name, sum(CAST({c} IS NULL AS INTEGER)) AS missing_count FROM batched GROUP BY batch_index"
    for c in TX_COLS
) + ")"


def oracle_sql() -> dict[str, str]:
    return dict(Q)


# ---------------------------------------------------------------- cleaning
TYPES = {
    "Transaction_ID": "BIGINT", "Customer_ID": "BIGINT", "Transaction_Amount": "DOUBLE",
    "Account_Balance": "DOUBLE", "Age": "INTEGER", "Is_Fraud": "INTEGER",
}


def _fill_expr(c: str) -> str:
    if c in NUM_COLS:
        # integers widen to doubles (a median may lie between two); 64-bit ids keep their type
        v = f"CAST(d.{c} AS DOUBLE), p.f_{c}" if TYPES[c] != "BIGINT" else f"d.{c}, CAST(round(p.f_{c}) AS BIGINT)"
        return f"CASE WHEN p.d_{c} THEN NULL ELSE coalesce({v}) END AS {c}"
    if c in CAT_COLS:
        return f"CASE WHEN p.d_{c} THEN NULL ELSE coalesce(d.{c}, p.f_{c}) END AS {c}"
    return f"CASE WHEN p.d_{c} THEN NULL ELSE d.{c} END AS {c}"


VALID = (
    "(d_Transaction_Amount OR coalesce(Transaction_Amount >= 0, false)) AND "
    "(d_Account_Balance OR coalesce(Account_Balance >= 0, false)) AND "
    "(d_Age OR coalesce(Age BETWEEN 0 AND 120, false))"
)

CLEAN = f"""{TXN},
miss AS (SELECT batch_index, count(*) AS rows_before,
  {", ".join(f"sum(CAST({c} IS NULL AS INTEGER)) AS m_{c}" for c in TX_COLS)}
  FROM batched GROUP BY batch_index),
dedup AS MATERIALIZED (SELECT {ALL}, batch_index, min(row_idx) AS row_idx FROM batched GROUP BY batch_index, {ALL}),
st AS (SELECT batch_index, count(*) AS rows_dedup,
  {", ".join(f"median({c}) AS f_{c}" for c in NUM_COLS)}
  FROM dedup GROUP BY batch_index),
{",".join(mode_cte('mo_' + c, 'dedup', c) for c in CAT_COLS)},
params AS MATERIALIZED (SELECT m.batch_index, rows_before, rows_dedup,
  {", ".join(f"coalesce(CAST(m_{c} AS DOUBLE) / rows_dedup * 100.0 > 30.0, false) AS d_{c}" for c in TX_COLS)},
  {", ".join(f"f_{c}" for c in NUM_COLS)},
  {", ".join(f"mo_{c}_v AS f_{c}" for c in CAT_COLS)}
  FROM miss m JOIN st USING (batch_index) {" ".join(f"LEFT JOIN mo_{c} USING (batch_index)" for c in CAT_COLS)}),
filled AS (SELECT d.batch_index, d.row_idx, {", ".join(_fill_expr(c) for c in TX_COLS)},
  {", ".join(f"p.d_{c}" for c in TX_COLS)}
  FROM dedup d JOIN params p USING (batch_index)),
cleaned AS MATERIALIZED (SELECT {ALL}, row_idx, batch_index FROM filled WHERE {VALID})"""

Q["dedupe"] = f"""{CLEAN}
SELECT * FROM dedup"""

Q["sparse_columns"] = f"""{CLEAN}
SELECT batch_index, column_name, missing_count, rows_after_dedupe,
       round(CAST(missing_count AS DOUBLE) / rows_after_dedupe * 100.0, 4) AS missing_pct,
       coalesce(CAST(missing_count AS DOUBLE) / rows_after_dedupe * 100.0 > 30.0, false) AS dropped
FROM (""" + "\nUNION ALL\n".join(
    f"SELECT batch_index, '{c}' AS column_name, CAST(m_{c} AS BIGINT) AS missing_count, "
    f"CAST(rows_dedup AS BIGINT) AS rows_after_dedupe FROM miss JOIN st USING (batch_index)"
    for c in TX_COLS
) + ")"

Q["fill_missing"] = f"""{CLEAN}
SELECT {ALL}, row_idx, batch_index FROM filled"""

Q["invalid_rows"] = f"""{CLEAN}
SELECT {ALL}, row_idx, batch_index FROM filled WHERE NOT ({VALID})"""

Q["clean"] = f"""{CLEAN}
SELECT * FROM cleaned"""

Q["clean_audit"] = f"""{CLEAN},
aft AS (SELECT batch_index, count(*) AS rows_after FROM cleaned GROUP BY batch_index)
SELECT batch_index, CAST(rows_before AS BIGINT) AS rows_before,
       CAST(rows_before - rows_dedup AS BIGINT) AS duplicates_removed,
       CAST(rows_dedup AS BIGINT) AS rows_after_dedupe,
       CAST(rows_dedup - coalesce(rows_after, 0) AS BIGINT) AS invalid_removed,
       CAST(coalesce(rows_after, 0) AS BIGINT) AS rows_after
FROM params LEFT JOIN aft USING (batch_index)"""


# ---------------------------------------------------------------- EDA
DROPPED = "dropped AS (" + "\nUNION ALL ".join(
    f"SELECT batch_index, '{c}' AS column_name FROM params WHERE d_{c}" for c in TX_COLS
) + ")"


def _not_dropped(alias: str, col: str = "column_name") -> str:
    return f"NOT EXISTS (SELECT 1 FROM dropped x WHERE x.batch_index = {alias}.batch_index AND x.column_name = {alias}.{col})"


EDA = f"""{CLEAN},
{DROPPED}"""

Q["profile_header"] = f"""{EDA},
agg AS (SELECT batch_index, CAST(count(*) AS BIGINT) AS n_rows, round(avg(Is_Fraud) * 100.0, 2) AS fraud_rate
        FROM cleaned GROUP BY batch_index)
SELECT a.batch_index, a.n_rows,
       CAST({len(TX_COLS)} - ({" + ".join(f"CAST(p.d_{c} AS INTEGER)" for c in TX_COLS)}) AS INTEGER) AS n_cols,
       concat_ws(',', {", ".join(f"CASE WHEN NOT p.d_{c} THEN '{c}' END" for c in NUM_COLS)}) AS numeric_cols,
       concat_ws(',', {", ".join(f"CASE WHEN NOT p.d_{c} THEN '{c}' END" for c in CAT_COLS)}) AS cat_cols,
       a.fraud_rate
FROM agg a JOIN params p USING (batch_index)"""

Q["describe_numeric"] = f"""{EDA},
d AS (""" + "\nUNION ALL\n".join(
    f"""  SELECT batch_index, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count,
         round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std,
         round(min(CAST({c} AS DOUBLE)), 4) AS min,
         round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
         round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50,
         round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75,
         round(max(CAST({c} AS DOUBLE)), 4) AS max
  FROM cleaned GROUP BY batch_index""" for c in NUM_COLS
) + f""")
SELECT * FROM d WHERE {_not_dropped('d')}"""

CAT_COUNTS = "cc AS (" + "\nUNION ALL\n".join(
    f"SELECT batch_index, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS count "
    f"FROM cleaned WHERE {c} IS NOT NULL GROUP BY batch_index, {c}" for c in CAT_COLS
) + ")"

Q["top_categories"] = f"""{EDA},
{CAT_COUNTS}
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY batch_index, column_name ORDER BY count DESC, value ASC) AS INTEGER) AS rank
               FROM cc) WHERE rank <= 3"""

Q["category_counts"] = f"""{EDA},
{CAT_COUNTS}
SELECT batch_index, column_name, value, count FROM (
  SELECT *, count(*) OVER (PARTITION BY batch_index, column_name) AS nd FROM cc) WHERE nd <= 20"""


def _corr(a: str, b: str) -> str:
    x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END"


_pairs = []
for _i, _a in enumerate(NUM_COLS):
    for _b in NUM_COLS[_i:]:
        _pairs.append((_a, _b))
        if _a != _b:
            _pairs.append((_b, _a))

Q["correlation"] = f"""{EDA},
m AS (""" + "\nUNION ALL\n".join(
    f"SELECT batch_index, '{a}' AS col_a, '{b}' AS col_b, round({_corr(a, b)}, 2) AS corr FROM cleaned GROUP BY batch_index"
    for a, b in _pairs
) + f""")
SELECT * FROM m WHERE {_not_dropped('m', 'col_a')} AND {_not_dropped('m', 'col_b')}"""

Q["histogram"] = f"""{EDA},
lv AS (""" + "\nUNION ALL\n".join(
    f"SELECT batch_index, '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM cleaned WHERE {c} IS NOT NULL"
    for c in NUM_COLS if c != "Is_Fraud"
) + f"""),
l AS (SELECT * FROM lv WHERE {_not_dropped('lv')}),
r0 AS (SELECT batch_index, column_name, min(v) AS lo0, max(v) AS hi0 FROM l GROUP BY batch_index, column_name),
r AS (SELECT batch_index, column_name,
             CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
b AS (SELECT l.batch_index, l.column_name, r.lo, r.hi,
             CAST(least(floor((l.v - r.lo) * (CAST(30 AS DOUBLE) / (r.hi - r.lo))), 29) AS INTEGER) AS bin
      FROM l JOIN r USING (batch_index, column_name))
SELECT r.batch_index, r.column_name, CAST(g.i AS INTEGER) AS bin,
       round(r.lo + g.i * ((r.hi - r.lo) / CAST(30 AS DOUBLE)), 4) AS bin_lo,
       round(r.lo + (g.i + 1) * ((r.hi - r.lo) / CAST(30 AS DOUBLE)), 4) AS bin_hi,
       CAST(count(b.bin) AS BIGINT) AS count
FROM r JOIN range(30) g(i) ON true
LEFT JOIN b ON b.batch_index = r.batch_index AND b.column_name = r.column_name AND b.bin = g.i
GROUP BY r.batch_index, r.column_name, g.i, r.lo, r.hi"""

Q["target_rate_by_category"] = f"""{EDA}
""" + "\nUNION ALL\n".join(
    f"SELECT batch_index, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, "
    f"round(avg(Is_Fraud) * 100.0, 4) AS target_rate, CAST(count(*) AS BIGINT) AS n "
    f"FROM cleaned WHERE {c} IS NOT NULL GROUP BY batch_index, {c}"
    for c in ["Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type"]
)

# ---------------------------------------------------------------- drift
FEATURES = f"""{EDA},
{CAT_COUNTS},
fv AS MATERIALIZED (""" + "\nUNION ALL\n".join(
    [f"SELECT batch_index, '{c}' AS column_name, '{c}_mean' AS feature, avg(CAST({c} AS DOUBLE)) AS value FROM cleaned GROUP BY batch_index"
     for c in NUM_COLS]
    + [f"SELECT batch_index, '{c}' AS column_name, '{c}_std' AS feature, stddev_samp(CAST({c} AS DOUBLE)) AS value FROM cleaned GROUP BY batch_index"
       for c in NUM_COLS]
    + ["SELECT batch_index, 'Is_Fraud' AS column_name, 'fraud_rate' AS feature, avg(CAST(Is_Fraud AS DOUBLE)) AS value FROM cleaned GROUP BY batch_index",
       "SELECT batch_index, column_name, column_name || '=' || value || '_share' AS feature, "
       "CAST(count AS DOUBLE) / CAST(sum(count) OVER (PARTITION BY batch_index, column_name) AS DOUBLE) AS value FROM cc"]
) + f"""),
feat AS MATERIALIZED (SELECT batch_index, feature, value FROM fv WHERE {_not_dropped('fv')}),
ref AS (SELECT feature, value AS reference FROM feat WHERE batch_index = 0),
deltas AS (
  SELECT f.batch_index, f.feature, r.reference, f.value AS current,
         CASE WHEN r.reference = 0 THEN abs(f.value) ELSE abs(f.value - r.reference) / abs(r.reference) END AS delta
  FROM feat f JOIN ref r USING (feature) WHERE f.batch_index <> 0)"""

Q["drift_features"] = f"""{FEATURES}
SELECT batch_index, feature, round(value, 4) AS value FROM feat"""

Q["drift_deltas"] = f"""{FEATURES}
SELECT batch_index, feature, round(reference, 4) AS reference, round(current, 4) AS current,
       round(delta * 100.0, 2) AS delta_pct, coalesce(delta > 0.2, false) AS drifted
FROM deltas"""

Q["drift_summary"] = f"""{FEATURES}
SELECT batch_index, CAST(count(*) FILTER (WHERE coalesce(delta > 0.2, false)) AS BIGINT) AS n_drifted,
       bool_or(coalesce(delta > 0.2, false)) AS drift_detected,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE coalesce(delta > 0.2, false)), '') AS drifted_features
FROM deltas GROUP BY batch_index"""


# ---------------------------------------------------------------- association rules
BASKET_COLS = ["Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type", "State", "Gender"]
_ATTRS = [f"CASE WHEN c.{b} IS NOT NULL THEN '{b}=' || c.{b} END" for b in BASKET_COLS] + [
    "CASE WHEN c.Transaction_Amount > m.ma THEN 'Amount_high' WHEN c.Transaction_Amount <= m.ma THEN 'Amount_low' END",
    "CASE WHEN c.Account_Balance > m.mb THEN 'Balance_high' WHEN c.Account_Balance <= m.mb THEN 'Balance_low' END",
    "CASE WHEN c.Is_Fraud = 1 THEN 'Is_Fraud=1' WHEN c.Is_Fraud = 0 THEN 'Is_Fraud=0' END",
]
_A = [f"a{i}" for i in range(len(_ATTRS))]

def rules_cte(support: float, confidence: float, where: str = "true") -> str:
    """Itemsets by CUBE over the attributes, and the rules split from those that ``where`` keeps."""
    return f"""{CLEAN},
med AS (SELECT batch_index, median(Transaction_Amount) AS ma, median(Account_Balance) AS mb FROM cleaned GROUP BY batch_index),
attrs AS (SELECT c.batch_index, c.row_idx, {", ".join(f"{e} AS {a}" for e, a in zip(_ATTRS, _A))}
          FROM cleaned c JOIN med m USING (batch_index)),
nb AS (SELECT batch_index, count(*) AS n FROM cleaned GROUP BY batch_index),
cub AS (SELECT batch_index, {", ".join(_A)}, {", ".join(f"grouping({a}) AS g{a}" for a in _A)}, count(*) AS c
        FROM attrs GROUP BY batch_index, CUBE({", ".join(_A)})),
isets AS (SELECT batch_index, list_sort(list_filter([{", ".join(f"CASE WHEN g{a} = 0 THEN {a} END" for a in _A)}], lambda x: x IS NOT NULL)) AS items, c
          FROM cub WHERE {" AND ".join(f"(g{a} = 1 OR {a} IS NOT NULL)" for a in _A)}
            AND NOT ({" AND ".join(f"g{a} = 1" for a in _A)})),
freq AS MATERIALIZED (SELECT i.batch_index, items, CAST(c AS BIGINT) AS count, CAST(c AS DOUBLE) / n AS support
         FROM isets i JOIN nb USING (batch_index) WHERE CAST(c AS DOUBLE) / n >= {support}),
rules0 AS (SELECT i.batch_index, a.items AS ante, list_filter(i.items, lambda x: NOT list_contains(a.items, x)) AS cons,
                  i.support, a.support AS sa
           FROM freq i JOIN freq a ON a.batch_index = i.batch_index AND len(a.items) < len(i.items)
                                  AND list_has_all(i.items, a.items)
           WHERE len(i.items) >= 2 AND {where}),
rules AS (SELECT r.batch_index, ante, cons, sa, cc.support AS sc, r.support,
                 r.support / sa AS confidence, (r.support / sa) / cc.support AS lift,
                 array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents
          FROM rules0 r JOIN freq cc ON cc.batch_index = r.batch_index AND cc.items = r.cons
          WHERE r.support / sa >= {confidence} AND (r.support / sa) / cc.support >= 1.0)"""


RULES = rules_cte(0.05, 0.3)

# Scores are exact ratios computed with the same float formulas: compared unrounded.
_RULE_OUT = """batch_index, antecedents, consequents, sa AS antecedent_support, sc AS consequent_support,
       support, confidence, lift"""

Q["baskets"] = f"""{RULES}
SELECT batch_index, row_idx, array_to_string(list_sort(list_filter([{", ".join(_A)}], lambda x: x IS NOT NULL)), ', ') AS items
FROM attrs"""

Q["frequent_itemsets"] = f"""{RULES}
SELECT batch_index, array_to_string(items, ', ') AS itemset, count, support FROM freq"""

Q["table_itemsets"] = f"""{CLEAN},
one AS (SELECT * REPLACE (0 AS batch_index) FROM cleaned){RULES[len(CLEAN):].replace("cleaned", "one")}
SELECT batch_index, array_to_string(items, ', ') AS itemset, count, support FROM freq"""
Q["table_itemsets_fpgrowth"] = Q["table_itemsets"]

Q["association_rules"] = f"""{RULES}
SELECT {_RULE_OUT} FROM rules"""

Q["top_rules"] = f"""{RULES}
SELECT {_RULE_OUT}, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY batch_index ORDER BY lift DESC, support DESC, antecedents, consequents) AS INTEGER) AS rank
  FROM rules) WHERE rank <= 10"""

Q["target_rules"] = f"""{rules_cte(0.01, 0.1, "list_contains(i.items, 'Is_Fraud=1')")}
SELECT {_RULE_OUT}, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY batch_index ORDER BY lift DESC, support DESC, antecedents, consequents) AS INTEGER) AS rank
  FROM rules WHERE list_contains(cons, 'Is_Fraud=1')) WHERE rank <= 5"""


# ---------------------------------------------------------------- feature preparation
FEAT_NUM = ["Transaction_Amount", "Account_Balance", "Age"]
FEAT_CAT = ["Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type", "State", "Gender"]

PREP = f"""{CLEAN},
fit AS (SELECT * FROM cleaned WHERE batch_index = 0),
imp AS (SELECT {", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in FEAT_NUM)} FROM fit),
{",".join(mode_cte('fm_' + c, 'fit', c) for c in FEAT_CAT)},
modes AS (SELECT {", ".join(f"(SELECT fm_{c}_v FROM fm_{c}) AS o_{c}" for c in FEAT_CAT)}),
x AS (SELECT c.batch_index, c.row_idx, CAST(c.Is_Fraud AS DOUBLE) AS label,
             {", ".join(f"coalesce(CAST(c.{n} AS DOUBLE), imp.m_{n}) AS {n}" for n in FEAT_NUM)},
             {", ".join(f"coalesce(CAST(c.{n} AS VARCHAR), modes.o_{n}) AS {n}" for n in FEAT_CAT)}
      FROM cleaned c JOIN imp ON true JOIN modes ON true),
xf AS (SELECT * FROM x WHERE batch_index = 0),
{",".join(f"voc_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT {c} AS v FROM xf WHERE {c} IS NOT NULL))" for c in FEAT_CAT)},
std AS (SELECT {", ".join(f"avg({c}) AS a_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS b_{c}" for c in FEAT_NUM)} FROM xf),
mm AS (SELECT {", ".join(f"min({c}) AS a_{c}, CASE WHEN max({c}) - min({c}) = 0 THEN 1.0 ELSE max({c}) - min({c}) END AS b_{c}" for c in FEAT_NUM)} FROM xf)"""

Q["impute"] = f"""{PREP}
""" + "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS column_name, m_{c} AS numeric_fill, CAST(NULL AS VARCHAR) AS text_fill FROM imp" for c in FEAT_NUM]
    + [f"SELECT '{c}' AS column_name, CAST(NULL AS DOUBLE) AS numeric_fill, o_{c} AS text_fill FROM modes" for c in FEAT_CAT]
)

Q["features_ordinal_standard"] = f"""{PREP}
""" + "\nUNION ALL\n".join(
    [f"SELECT batch_index, row_idx, label, '{c}' AS feature, round((x.{c} - s.a_{c}) / s.b_{c}, 4) AS value FROM x JOIN std s ON true"
     for c in FEAT_NUM]
    + [f"SELECT batch_index, row_idx, label, '{c}' AS feature, coalesce(v.code, -1.0) AS value FROM x LEFT JOIN voc_{c} v ON x.{c} = v.v"
       for c in FEAT_CAT]
)

Q["features_onehot_minmax"] = f"""{PREP}
""" + "\nUNION ALL\n".join(
    [f"SELECT batch_index, row_idx, label, '{c}' AS feature, round((x.{c} - s.a_{c}) / s.b_{c}, 4) AS value FROM x JOIN mm s ON true"
     for c in FEAT_NUM]
    + [f"SELECT x.batch_index, x.row_idx, x.label, '{c}_' || v.v AS feature, CASE WHEN x.{c} = v.v THEN 1.0 ELSE 0.0 END AS value "
       f"FROM x JOIN voc_{c} v ON true" for c in FEAT_CAT]
)

_NUM_LIST = ", ".join(f"'{c}'" for c in FEAT_NUM)
Q["features_onehot_sparse"] = f"""SELECT batch_index, row_idx, feature, value FROM ({Q["features_onehot_minmax"]}) WHERE value = 1.0 OR feature IN ({_NUM_LIST})"""


# ---------------------------------------------------------------- validation (deterministic scorers)
VALID_BASE = f"""{CLEAN},
pos AS (SELECT *, row_number() OVER (PARTITION BY batch_index ORDER BY row_idx) - 1 AS p,
               count(*) OVER (PARTITION BY batch_index) AS n FROM cleaned),
ho AS (SELECT *, p >= floor(n * (CAST(1.0 AS DOUBLE) - CAST(0.2 AS DOUBLE))) AS is_holdout FROM pos),
sc AS (
  SELECT batch_index, row_idx, 'amount' AS model, Is_Fraud AS label,
         least(greatest(Transaction_Amount / CAST(500000.0 AS DOUBLE), CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS p1,
         CAST(0.9 AS DOUBLE) AS thr FROM ho WHERE is_holdout
  UNION ALL
  SELECT batch_index, row_idx, 'status' AS model, Is_Fraud AS label,
         CASE Transaction_Type WHEN 'F' THEN CAST(0.6 AS DOUBLE) WHEN 'O' THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS p1,
         CAST(0.5 AS DOUBLE) AS thr FROM ho WHERE is_holdout),
scp AS (SELECT *, CASE WHEN p1 >= thr THEN 1 ELSE 0 END AS prediction FROM sc),
cm AS (SELECT batch_index, model,
              CAST(count(*) FILTER (WHERE prediction = 1 AND label = 1) AS BIGINT) AS tp,
              CAST(count(*) FILTER (WHERE prediction = 1 AND label <> 1) AS BIGINT) AS fp,
              CAST(count(*) FILTER (WHERE prediction <> 1 AND label = 1) AS BIGINT) AS fn,
              CAST(count(*) AS BIGINT) AS n
       FROM scp GROUP BY batch_index, model),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision,
                 CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall FROM cm),
met AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr),
rk AS (SELECT batch_index, model, label, rank() OVER (PARTITION BY batch_index, model ORDER BY p1) AS r_lo,
              count(*) OVER (PARTITION BY batch_index, model, p1) AS ties FROM scp),
au AS (SELECT batch_index, model, CAST(sum(label) AS BIGINT) AS n_pos, CAST(count(*) - sum(label) AS BIGINT) AS n_neg,
              sum(CASE WHEN label = 1 THEN 2 * r_lo + ties - 1 ELSE 0 END) AS two_r
       FROM rk GROUP BY batch_index, model),
auc AS (SELECT batch_index, model, n_pos, n_neg,
               CASE WHEN n_pos > 0 AND n_neg > 0
                    THEN CAST(two_r - n_pos * (n_pos + 1) AS DOUBLE) / CAST(2 * n_pos * n_neg AS DOUBLE) END AS roc_auc FROM au),
ev AS (SELECT m.batch_index, m.model, round(f1, 4) AS f1, round(roc_auc, 4) AS roc_auc,
              round(precision, 4) AS precision, round(recall, 4) AS recall, tp, fp, fn, n
       FROM met m JOIN auc a USING (batch_index, model) WHERE roc_auc IS NOT NULL)"""

Q["holdout"] = f"""{VALID_BASE}
SELECT batch_index, row_idx, is_holdout FROM ho"""

Q["cv_folds"] = f"""{CLEAN},
pos AS (SELECT batch_index, row_idx, row_number() OVER (PARTITION BY batch_index ORDER BY row_idx) - 1 AS p,
               count(*) OVER (PARTITION BY batch_index) AS n FROM cleaned),
sz AS (SELECT *, n // 4 AS size, n - 3 * (n // 4) AS first FROM pos)
SELECT batch_index, row_idx,
       CASE WHEN size > 0 AND p >= first THEN CAST((p - first) // size AS INTEGER) END AS test_fold
FROM sz"""

Q["binary_metrics"] = f"""{VALID_BASE}
SELECT batch_index, model, tp, fp, fn, n, precision, recall, f1 FROM met"""

Q["roc_auc"] = f"""{VALID_BASE}
SELECT * FROM auc"""

Q["holdout_evaluation"] = f"""{VALID_BASE}
SELECT * FROM ev"""

Q["best_model"] = f"""{VALID_BASE}
SELECT model AS model_name, batch_index, f1 AS score, 'f1' AS metric FROM ev
WHERE batch_index >= 0
ORDER BY f1 DESC, batch_index DESC, CASE model WHEN 'amount' THEN 0 WHEN 'status' THEN 1 ELSE 2 END DESC LIMIT 1"""


# ---------------------------------------------------------------- class weights, store, stream, CSV
Q["class_weights"] = f"""{CLEAN},
l AS (SELECT CAST(Is_Fraud AS DOUBLE) AS label FROM cleaned WHERE batch_index = 0),
c AS (SELECT label, CAST(count(*) AS BIGINT) AS count FROM l GROUP BY label)
SELECT label, count,
       CAST((SELECT count(*) FROM l) AS DOUBLE) / (CAST((SELECT count(*) FROM c) AS DOUBLE) * CAST(count AS DOUBLE)) AS weight
FROM c"""

Q["read_all_batches"] = Q["assign_batches"]

Q["pending_batches"] = f"""{TXN}
SELECT DISTINCT batch_index FROM batched WHERE batch_index > (SELECT min(batch_index) FROM batched)"""

Q["stream_quality"] = Q["quality_report"]

Q["stream_clean"] = Q["clean"]

Q["meta_history"] = Q["batch_meta"]

Q["csv_source"] = f"""WITH {BASE_SQL}
SELECT *, CAST(Transaction_ID % 7 AS BIGINT) AS Channel_Code
FROM (SELECT * FROM base UNION ALL SELECT * FROM base WHERE Transaction_ID % 50 = 7)"""

Q["quality_history"] = Q["quality_report"]
Q["drift_history"] = Q["drift_deltas"]
Q["update_reports"] = Q["category_counts"]
Q["features_reloaded"] = Q["features_ordinal_standard"]
Q["registered_model"] = Q["best_model"]
Q["scoring_log_summary"] = """
SELECT CAST(count(*) AS BIGINT) AS n_calls, round(avg(o_totalprice), 2) AS avg_elapsed_ms, round(max(o_totalprice), 2) AS max_elapsed_ms
FROM orders"""

# ---------------------------------------------------------------- events
EV = """WITH ev AS (SELECT *, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS batch_index FROM events)"""
EV_NUM = ["event_id", "user_id", "value"]
EV_TXT = ["event_type", "props"]

Q["event_profile"] = f"""{EV},
{",".join(mode_cte('top_' + c, 'ev', c) for c in EV_TXT)},
{",".join(f"tc_{c} AS (SELECT batch_index, {c} AS v, CAST(count(*) AS BIGINT) AS k FROM ev WHERE {c} IS NOT NULL GROUP BY batch_index, {c})" for c in EV_TXT)}
""" + "\nUNION ALL\n".join(
    [f"""SELECT batch_index, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count,
       CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct,
       round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std,
       round(min(CAST({c} AS DOUBLE)), 4) AS min, round(max(CAST({c} AS DOUBLE)), 4) AS max,
       round(median(CAST({c} AS DOUBLE)), 4) AS median,
       CAST(NULL AS VARCHAR) AS top_value, CAST(NULL AS BIGINT) AS top_count
FROM ev GROUP BY batch_index""" for c in EV_NUM]
    + [f"""SELECT a.batch_index, '{c}' AS column_name, a.count, a.n_missing, a.n_distinct,
       CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
       CAST(NULL AS DOUBLE) AS median, t.top_{c}_v AS top_value, k.k AS top_count
FROM (SELECT batch_index, CAST(count({c}) AS BIGINT) AS count, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing,
             CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM ev GROUP BY batch_index) a
LEFT JOIN top_{c} t USING (batch_index)
LEFT JOIN tc_{c} k ON k.batch_index = a.batch_index AND k.v = t.top_{c}_v""" for c in EV_TXT]
)

Q["event_drift"] = f"""{EV},
fv AS MATERIALIZED (""" + "\nUNION ALL\n".join(
    [f"SELECT batch_index, '{c}_mean' AS feature, avg(CAST({c} AS DOUBLE)) AS value FROM ev GROUP BY batch_index" for c in EV_NUM]
    + [f"SELECT batch_index, '{c}_std' AS feature, stddev_samp(CAST({c} AS DOUBLE)) AS value FROM ev GROUP BY batch_index" for c in EV_NUM]
    + [f"SELECT batch_index, '{c}=' || {c} || '_share' AS feature, "
       f"CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY batch_index) AS DOUBLE) AS value "
       f"FROM ev WHERE {c} IS NOT NULL GROUP BY batch_index, {c}" for c in EV_TXT]
) + """),
ref AS (SELECT feature, value AS reference FROM fv WHERE batch_index = (SELECT min(batch_index) FROM ev)),
d AS (SELECT f.batch_index, f.feature, r.reference, f.value AS current,
             CASE WHEN r.reference = 0 THEN abs(f.value) ELSE abs(f.value - r.reference) / abs(r.reference) END AS delta
      FROM fv f JOIN ref r USING (feature) WHERE f.batch_index <> (SELECT min(batch_index) FROM ev))
SELECT batch_index, feature, round(reference, 4) AS reference, round(current, 4) AS current,
       round(delta * 100.0, 2) AS delta_pct, coalesce(delta > 0.2, false) AS drifted FROM d"""


# ---------------------------------------------------------------- models in table form
def _forest(nodes: list[tuple], rows: str) -> str:
    """Walk every tree from its root; ``rows`` gives ``rid`` and the list ``f`` of features."""
    values = ", ".join(f"({t}, {n}, {f}, {thr!r}, {left}, {right}, {w[0]!r}, {w[1]!r})" for t, n, f, thr, left, right, w in nodes)
    return f"""nodes(tree, node, feature, threshold, l, r, w0, w1) AS (VALUES {values}),
fx AS ({rows}),
walk AS (
  SELECT rid, tree, 0 AS node FROM fx, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.rid, w.tree, CASE WHEN coalesce(fx.f[n.feature + 1] <= n.threshold, false) THEN n.l ELSE n.r END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.l >= 0 JOIN fx ON fx.rid = w.rid),
scored AS (
  SELECT w.rid, sum(n.w1 / (n.w0 + n.w1)) / {catalog.FIXED_TREES} AS p1
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.l < 0 GROUP BY w.rid)"""


NUMBERED = "numbered AS (SELECT *, row_number() OVER () AS rid FROM transactions)"
RECURSIVE_TXN = TXN.replace("WITH ", "WITH RECURSIVE ", 1)

Q["forest_table_scores"] = f"""{RECURSIVE_TXN},
{NUMBERED},
{_forest(catalog.fixed_forest(catalog.RAW_THRESHOLDS), "SELECT rid, [Transaction_Amount, Account_Balance, CAST(Age AS DOUBLE)] AS f FROM numbered")}
SELECT Transaction_ID, p1, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS prediction FROM numbered JOIN scored USING (rid)"""


def _network(weights: list[tuple]) -> str:
    """The layers one after the other, each unit written out."""
    out, inputs = [], ["coalesce(Transaction_Amount / 250000.0, 0.0)", "coalesce(Account_Balance / 5000.0, 0.0)", "coalesce(Age / 60.0, 0.0)"]
    layers = sorted({w[0] for w in weights})
    of = {w[:3]: w[3] for w in weights}
    source = "transactions"
    for k in layers:
        units = sorted({w[1] for w in weights if w[0] == k})
        nets = [f"{of[k, j, -1]!r} + " + " + ".join(f"{of[k, j, i]!r} * {x}" for i, x in enumerate(inputs)) for j in units]
        cells = nets if k == layers[-1] else [f"1.0 / (1.0 + exp(-({n})))" for n in nets]
        out.append(f"layer{k} AS (SELECT Transaction_ID, {', '.join(f'{c} AS u{j}' for j, c in zip(units, cells))} FROM {source})")
        source, inputs = f"layer{k}", [f"u{j}" for j in units]
    return ",\n".join(out)


Q["mlp_table_scores"] = f"""{TXN},
{_network(catalog.fixed_mlp())},
soft AS (SELECT Transaction_ID, 1.0 / (1.0 + exp(u0 - u1)) AS p1 FROM layer2)
SELECT Transaction_ID, p1, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS prediction FROM soft"""

_PREPARED = "SELECT n.rid, [" + ", ".join(
    [f"(coalesce(CAST(n.{c} AS DOUBLE), imp.m_{c}) - s.a_{c}) / s.b_{c}" for c in FEAT_NUM]
    + [f"coalesce((SELECT code FROM voc_{c} v WHERE v.v = coalesce(n.{c}, modes.o_{c})), -1.0)" for c in FEAT_CAT]
) + "] AS f FROM numbered n JOIN imp ON true JOIN modes ON true JOIN std s ON true"

Q["table_inference"] = f"""{PREP.replace("WITH ", "WITH RECURSIVE ", 1)},
{NUMBERED},
{_forest(catalog.fixed_forest(catalog.PREPARED_THRESHOLDS), _PREPARED)}
SELECT Transaction_ID, Transaction_Amount, Transaction_Type, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS predict FROM numbered JOIN scored USING (rid)"""

Q["stream_batches"] = Q["assign_batches"]
Q["stream_update_drift"] = Q["drift_deltas"]
Q["stream_csv_source"] = f"""WITH {BASE_SQL},
transactions AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE Transaction_ID % 50 = 7)
SELECT * FROM transactions"""
Q["stream_inference"] = f"""SELECT t.*, {catalog.SLICES} AS n_calls, CAST(count(*) OVER () AS BIGINT) AS n_rows FROM ({Q["table_inference"]}) t"""

Q["quality_documents"] = f"""SELECT q.batch_index, q.n_rows, q.missing_pct_total AS pct_total, m.column_name, m.missing_count,
  q.duplicates_count AS count, q.fraud_rate AS rate, q.amount_std AS std, q.missing_ok, q.passed
FROM ({Q["quality_report"]}) q JOIN ({Q["missing_per_column"]}) m ON m.batch_index = q.batch_index"""
Q["rule_documents"] = Q["top_rules"]

_PROBS = "(SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS prob)"
Q["event_quantiles"] = f"""{EV},
q AS (SELECT batch_index, quantile_cont(value, [0.25, 0.5, 0.75]) AS q FROM ev WHERE value IS NOT NULL GROUP BY batch_index)
SELECT batch_index, unnest([0.25, 0.5, 0.75])::DOUBLE AS prob, round(unnest(q), 4) AS quantile FROM q"""
Q["event_quantile_sketches"] = f"""{EV},
n AS (SELECT batch_index, count(value) AS n FROM ev GROUP BY batch_index HAVING count(value) > 0 UNION ALL SELECT -1, count(value) FROM ev)
SELECT batch_index, 'value' AS column_name, prob, n, true AS near FROM n, {_PROBS}"""
