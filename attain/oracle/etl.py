"""DuckDB expressions and statements for the raw extracts, the rule engine and the model builders."""

from __future__ import annotations

from attain.oracle.prelude import register, with_ctes


def half_up(numerator: str, denominator: str) -> str:
    """Integer division rounded half away from zero."""
    return f"(sign({numerator}) * ((2 * abs({numerator}) + ({denominator})) // (2 * ({denominator}))))"


def cents_over_fx(scaled4: str) -> str:
    """An amount given as integer ten-thousandths over the rate, in cents."""
    return f"({half_up(f'({scaled4}) * 100', '(fx_rate * 10000)::BIGINT')} * 0.01)::DECIMAL(18,2)"


def m4(names: str, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{n}, 4)::DOUBLE AS {n}" for n in names.split())


def ratios(names: str, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}::DOUBLE AS {n}" for n in names.split())


FLAGS = {
    "DQ-S02": "document_date IS NULL",
    "DQ-S03": "document_date IS NOT NULL AND document_date NOT BETWEEN DATE '1995-01-01' AND DATE '2001-07-31'",
    "DQ-S04": "rep_code IS NULL OR rep_code = ''",
    "DQ-S05": "rep_code IS NOT NULL AND rep_code NOT IN (SELECT employee_code FROM emp)",
    "DQ-S06": "sku IS NULL OR sku NOT IN (SELECT 'SKU-' || lpad(p_partkey::VARCHAR, 12, '0') FROM part)",
    "DQ-S07": "customer_code NOT IN (SELECT 'CUST-' || lpad(c_custkey::VARCHAR, 12, '0') FROM customer)",
    "DQ-S08": "currency NOT IN (SELECT 'CCY' || r_regionkey FROM region)",
    "DQ-S09": "country_code IS NULL",
    "DQ-S10": "doc_type = 'INV' AND quantity < 0",
    "DQ-S11": "doc_type = 'CN' AND quantity > 0",
    "DQ-S12": "doc_type = 'CN' AND original_document_no IS NULL",
    "DQ-S13": "doc_type = 'INV' AND (coalesce(price, 0) = 0 OR coalesce(net, 0) = 0)",
    "DQ-S14": "any_discount < 0 OR any_discount > 0.60",
    "DQ-S15": "coalesce(price, 0) <> 0 AND abs(quantity * price * (1 - discount_pct) - net) > abs(net) * 0.01 + 1",
}
HOLD = [r for r in FLAGS if r not in ("DQ-S13", "DQ-S15")]
RAW_ORDER = ("document_no, doc_type, original_document_no, document_date, rep_code, customer_code, country, sku, "
             "quantity, unit_list_price_local, discount_pct, net_amount_local, currency, exported_at")

register({
    "strangers": "SELECT month_key FROM months",
    "rawbase": """
        SELECT l_orderkey * 10 + l_linenumber AS k, l_orderkey, l_partkey, l_suppkey, l_quantity::BIGINT AS q,
               (l_extendedprice::DECIMAL(18,2) * 100)::BIGINT AS lc, l_discount::DECIMAL(4,2) AS disc,
               l_returnflag = 'R' AS credit, l_shipdate::DATE AS ship_date, o_custkey, r_regionkey, r_name,
               CASE WHEN l_returnflag = 'R' THEN l_shipdate::DATE ELSE o_orderdate::DATE END AS day
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
          JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "rawprice": """
        SELECT *, round(((2 * lc + q) // (2 * q) * 0.01)::DECIMAL(18,2)
                        * (1.0000 + r_regionkey * 0.5000 + (month(day) - 1) * 0.0100)::DECIMAL(10,4), 2)::DECIMAL(18,2)
                  AS price0, CASE WHEN credit THEN -1 ELSE 1 END AS sgn
          FROM rawbase""",
    "rawline": """
        SELECT k::VARCHAR AS line_id, CASE WHEN credit THEN 'CN' ELSE 'INV' END || '-' || l_orderkey AS document_no,
               CASE WHEN k % 8 = 3 THEN ' ' || lower(CASE WHEN credit THEN 'CN' ELSE 'INV' END)
                    ELSE CASE WHEN credit THEN 'CN' ELSE 'INV' END END AS doc_type,
               CASE WHEN credit AND k % 137 <> 0 THEN 'INV-' || l_orderkey END AS original_document_no,
               CASE WHEN k % 97 = 0 THEN 'unknown' WHEN k % 131 = 0 THEN '2031-01-15'
                    WHEN k % 4 = 1 THEN strftime(day, '%d/%m/%Y') WHEN k % 4 = 2 THEN strftime(day, '%Y/%m/%d')
                    WHEN k % 4 = 3 THEN strftime(day, '%d-%m-%Y') ELSE strftime(day, '%Y-%m-%d') END AS document_date,
               CASE WHEN k % 206 = 0 THEN '  ' WHEN k % 103 = 0 THEN NULL WHEN k % 149 = 0 THEN 'REP-X'
                    ELSE 'REP-' || lpad(l_suppkey::VARCHAR, 12, '0') || CASE WHEN k % 9 = 4 THEN ' ' ELSE '' END END
                   AS rep_code,
               CASE WHEN k % 139 = 0 THEN 'CUST-X' ELSE 'CUST-' || lpad(o_custkey::VARCHAR, 12, '0') END AS customer_code,
               CASE WHEN k % 151 = 0 THEN 'Atlantis' WHEN k % 5 = 1 THEN lower(r_name)
                    WHEN k % 5 = 2 THEN ' Region of ' || CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East'
                         ELSE r_name[1] || lower(r_name[2:]) END || ' '
                    WHEN k % 5 = 3 THEN 'r' || r_regionkey WHEN k % 5 = 4 THEN lower(r_name)[1:3] || '.'
                    ELSE r_name END AS country,
               CASE WHEN k % 107 = 0 THEN 'SKU-UNKNOWN' WHEN k % 6 = 1 THEN ' sku-' || lpad(l_partkey::VARCHAR, 12, '0')
                    ELSE 'SKU-' || lpad(l_partkey::VARCHAR, 12, '0') END AS sku,
               (CASE WHEN k % 179 = 0 THEN 123456789 ELSE q END * sgn * CASE WHEN (k % 113 = 0 AND NOT credit) OR (k % 157 = 0 AND credit) THEN -1 ELSE 1 END)::VARCHAR
                   AS quantity,
               (CASE WHEN k % 101 = 0 AND NOT credit THEN 0 ELSE price0 END)::DECIMAL(18,2)::VARCHAR
                   AS unit_list_price_local,
               CASE WHEN k % 127 = 0 THEN '0.75' WHEN k % 173 = 0 THEN '150' WHEN k % 193 = 0 THEN '1e30' WHEN k % 167 = 0 THEN 'n/a' ELSE disc::VARCHAR END AS discount_pct,
               (CASE WHEN k % 101 = 0 AND NOT credit THEN 0
                     WHEN k % 163 = 0 THEN round(round(q * price0 * (1 - disc), 2)::DECIMAL(18,2) * sgn * 1.10 + 5, 2)
                     ELSE round(q * price0 * (1 - disc), 2) * sgn END)::DECIMAL(18,2)::VARCHAR
                 || CASE WHEN k % 181 = 0 THEN '5' ELSE '' END AS net_amount_local,
               CASE WHEN k % 109 = 0 THEN 'XXX' WHEN k % 4 = 2 THEN ' ccy' || r_regionkey || ' '
                    ELSE 'CCY' || r_regionkey END AS currency,
               strftime(ship_date, '%Y-%m-%d') AS exported_at
          FROM rawprice""",
    "stdline": """
        SELECT *, (NOT regexp_matches(raw_date, '^\\d{4}-\\d{2}-\\d{2}$') AND document_date IS NOT NULL) AS fixed_date,
               (raw_country NOT IN (SELECT r_name FROM region) AND country_code IS NOT NULL) AS fixed_country,
               coalesce(raw_sku <> sku, FALSE) AS fixed_sku
          FROM (SELECT line_id, document_no, upper(trim(doc_type)) AS doc_type, original_document_no,
                       document_date AS raw_date, country AS raw_country, sku AS raw_sku,
                       coalesce(try_strptime(trim(document_date), '%Y-%m-%d'),
                                try_strptime(trim(document_date), '%d/%m/%Y'),
                                try_strptime(trim(document_date), '%Y/%m/%d'),
                                try_strptime(trim(document_date), '%d-%m-%Y'))::DATE AS document_date,
                       trim(rep_code) AS rep_code, customer_code,
                       CASE WHEN c.code IS NOT NULL THEN c.code END AS country_code, upper(trim(sku)) AS sku,
                       quantity::DECIMAL(20,0) AS quantity, unit_list_price_local::DECIMAL(14,3) AS price,
                       TRY_CAST(discount_pct AS DOUBLE) AS any_discount,
                       CASE WHEN abs(TRY_CAST(discount_pct AS DOUBLE)) < 10000 THEN TRY_CAST(discount_pct AS DECIMAL(9,4)) END
                           AS discount_pct,
                       net_amount_local::DECIMAL(24,3) AS net,
                       coalesce(upper(trim(currency)), '') AS currency, rn
                  FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY """
               + ", ".join(f"{c.strip()} NULLS FIRST" for c in RAW_ORDER.split(",")) + """) AS rn FROM rawline) x
                  LEFT JOIN (SELECT lower(r_name) AS spelling, 'R' || r_regionkey AS code FROM region
                             UNION ALL SELECT 'r' || r_regionkey, 'R' || r_regionkey FROM region
                             UNION ALL SELECT 'region of ' || lower(r_name), 'R' || r_regionkey FROM region
                             UNION ALL SELECT lower(r_name)[1:3] || '.', 'R' || r_regionkey FROM region) c
                    ON c.spelling = lower(trim(x.country)))""",
    "flagged": "SELECT *, " + ", ".join(f"coalesce({sql}, FALSE) AS \"{rule}\"" for rule, sql in FLAGS.items())
               + " FROM stdline",
    "keptline": "SELECT *, list_filter([" + ", ".join(f"CASE WHEN \"{r}\" THEN '{r}' END" for r in HOLD)
                + "], lambda x: x IS NOT NULL) AS early FROM flagged WHERE rn = 1",
    "accepted": """
        SELECT * REPLACE (CASE WHEN a."DQ-S13" THEN round(quantity * price1 * (1 - discount_pct), 2)::DECIMAL(24,3)
                               ELSE net END AS net, price1 AS price)
          FROM (SELECT s.*, fx_rate, p.list_price_usd, p.unit_cost_pct, p.commission_weight, p.product_key,
                       t.team_id AS own_team, doc_type = 'CN' AS is_cn,
                       CASE WHEN s."DQ-S13" THEN round(p.list_price_usd * fx_rate, 2)::DECIMAL(14,3) ELSE price END AS price1
                  FROM keptline s
                  JOIN LATERAL (SELECT (1.0000 + s.currency[4:]::INT * 0.5000 + (month(s.document_date) - 1) * 0.0100)
                                       ::DECIMAL(10,4) AS fx_rate) f ON TRUE
                  JOIN (SELECT *, 'SKU-' || lpad(product_key::VARCHAR, 12, '0') AS sku FROM prod) p ON p.sku = s.sku
                  LEFT JOIN (SELECT 'REP-' || lpad(rep_key::VARCHAR, 12, '0') AS rep_code, start_date, end_date,
                                    'T' || lpad(team_key::VARCHAR, 2, '0') AS team_id FROM asg) t
                    ON t.rep_code = s.rep_code AND s.document_date >= t.start_date
                   AND (t.end_date IS NULL OR s.document_date <= t.end_date)
                 WHERE len(early) = 0) a""",
    "docs": f"""
        SELECT doc, struct_extract(min({{'line': line_id, 'team': own_team}}) FILTER (WHERE NOT is_cn), 'team') AS invoice_team,
               min(document_date) FILTER (WHERE NOT is_cn) AS invoice_date,
               SUM(usd_cents) FILTER (WHERE NOT is_cn) AS invoiced_usd, SUM(-usd_cents) FILTER (WHERE is_cn) AS credited_usd,
               SUM(net::DOUBLE / fx_rate::DOUBLE) FILTER (WHERE NOT is_cn) AS invoiced,
               SUM(-net::DOUBLE / fx_rate::DOUBLE) FILTER (WHERE is_cn) AS credited
          FROM (SELECT *, CASE WHEN is_cn THEN original_document_no ELSE document_no END AS doc,
                       {cents_over_fx('(net * 10000)::HUGEINT')} AS usd_cents FROM accepted)
         GROUP BY doc""",
    "routed": """
        SELECT a.*, CASE WHEN is_cn THEN invoice_team ELSE own_team END AS team_id,
               CASE WHEN is_cn THEN invoice_date END AS original_date,
               CASE WHEN NOT is_cn AND own_team IS NULL THEN 'DQ-S16'
                    WHEN is_cn AND invoice_date IS NULL THEN 'DQ-S17'
                    WHEN is_cn AND credited > coalesce(invoiced, 0) + 1.0 THEN 'DQ-S18' END AS late_rule
          FROM accepted a LEFT JOIN docs d
            ON d.doc = CASE WHEN a.is_cn THEN a.original_document_no ELSE a.document_no END""",
    "cleanusd": f"""
        SELECT r.*, {cents_over_fx('(quantity * price * 1000)::HUGEINT * 10')} AS gross_usd,
               {cents_over_fx('(net * 10000)::HUGEINT')} AS net_usd,
               {cents_over_fx('(price * 10000)::BIGINT')} AS unit_usd,
               round(quantity * list_price_usd * unit_cost_pct, 2)::DECIMAL(18,2) AS cost_usd
          FROM routed r WHERE late_rule IS NULL""",
    "mgr": """
        SELECT 'MGR-' || lpad(n_nationkey::VARCHAR, 2, '0') AS employee_code, 'Manager ' || n_name AS full_name,
               'Sales Manager' AS role, DATE '1990-01-01' AS hire_date, NULL::DATE AS exit_date,
               'T' || lpad(n_nationkey::VARCHAR, 2, '0') AS current_team_id FROM nation""",
    "demp": """
        SELECT row_number() OVER (ORDER BY employee_code) AS employee_key, x.*, t.department_code, t.country_code,
               CASE WHEN role = 'Sales Manager' THEN NULL ELSE 'MGR-' || current_team_id[2:] END AS manager_code
          FROM (SELECT employee_code, full_name, role, hire_date, exit_date, current_team_id FROM mgr
                UNION ALL
                SELECT employee_code, full_name, 'Sales Representative', hire_date, exit_date,
                       'T' || lpad((CASE WHEN rep_key % 7 = 3 AND hire_index < 42 THEN (home_team + 5) % 25
                                         ELSE home_team END)::VARCHAR, 2, '0') FROM emp) x
          JOIN team t ON t.team_id = x.current_team_id""",
    "efact": """
        SELECT line_id, document_no, doc_type, original_document_no,
               (year(document_date) * 10000 + month(document_date) * 100 + day(document_date))::INT AS date_key,
               (year(document_date) * 100 + month(document_date))::INT AS month_key, e.employee_key AS rep_key,
               team_id[2:]::INT + 1 AS team_key, customer_code[6:]::BIGINT + 1 AS customer_key,
               product_key + 1 AS product_key, c.country_code, currency, fx_rate, quantity::BIGINT AS quantity,
               unit_usd AS unit_list_price_usd, discount_pct, gross_usd AS gross_amount_usd,
               gross_usd - net_usd AS discount_amount_usd, net_usd AS net_amount_usd, cost_usd AS cost_amount_usd,
               net_usd - cost_usd AS gross_margin_usd, commission_weight,
               date_diff('day', original_date, document_date) AS days_since_original,
               CASE WHEN day(document_date) > day(last_day(document_date)) - 3 THEN 1 ELSE 0 END AS is_month_end_window,
               net AS net_amount_local
          FROM cleanusd c JOIN demp e ON e.employee_code = c.rep_code""",
    "etgt": """
        SELECT e.employee_key AS rep_key, t.team_key + 1 AS team_key, t.month_key, t.month_key * 100 + 1 AS date_key,
               t.target_amount_usd, t.revision_no, t.is_ramp_month
          FROM tgt t JOIN demp e ON e.employee_code = 'REP-' || lpad(t.rep_key::VARCHAR, 12, '0')""",
    "ebridge": """
        SELECT e.employee_key AS rep_key, b.month_key, b.team_key + 1 AS team_key, b.tenure_months, b.is_ramp_month
          FROM bridge b JOIN demp e ON e.employee_code = 'REP-' || lpad(b.rep_key::VARCHAR, 12, '0')""",
})


def check(check_id: str, failing: str) -> str:
    return f"SELECT '{check_id}' AS check_id, ({failing})::BIGINT AS failing_rows"


def checks(items: dict[str, str]) -> str:
    union = " UNION ALL ".join(check(i, sql) for i, sql in items.items())
    return f"SELECT check_id, failing_rows, failing_rows = 0 AS passed FROM ({union})"


def log_row(rule: str, rows: str, of: str | None) -> str:
    pct = f"round(100.0::DOUBLE * ({rows})::DOUBLE / ({of})::DOUBLE, 3)" if of else "NULL::DOUBLE"
    return f"SELECT '{rule}' AS rule_id, ({rows})::BIGINT AS rows_affected, {pct} AS pct_of_rows"


RAW_ROWS = "SELECT COUNT(*) FROM lineitem"
TARGET_ROWS = "SELECT (SELECT COUNT(*) FROM rawtgt) + (SELECT COUNT(*) FROM strangers)"
LOG = " UNION ALL ".join(
    [log_row(f"STD-0{i}", f"SELECT COUNT(*) FROM stdline WHERE {f}", None)
     for i, f in ((1, "fixed_date"), (2, "fixed_country"), (3, "fixed_sku"))]
    + [log_row("DQ-S01", "SELECT COUNT(*) FROM stdline WHERE rn > 1", RAW_ROWS)]
    + [log_row(r, f"SELECT COUNT(*) FROM flagged WHERE \"{r}\"", RAW_ROWS) for r in FLAGS]
    + [log_row(r, f"SELECT COUNT(*) FROM routed WHERE late_rule = '{r}'", RAW_ROWS)
       for r in ("DQ-S16", "DQ-S17", "DQ-S18")]
    + [log_row("DQ-T01", "SELECT COUNT(*) - COUNT(DISTINCT (rep_key, month_key)) FROM rawtgt", TARGET_ROWS),
       log_row("DQ-T02", "SELECT COUNT(*) FROM rawtgt WHERE target_amount_usd <= 0", TARGET_ROWS),
       log_row("DQ-T03", "SELECT COUNT(*) FROM strangers", TARGET_ROWS),
       log_row("DQ-T04", "SELECT COUNT(*) FROM bridge b LEFT JOIN tgt t USING (rep_key, month_key) "
                         "WHERE t.rep_key IS NULL", "SELECT COUNT(*) FROM bridge")])

ECHECKS = {
    "IC-01": "SELECT COUNT(*) - COUNT(DISTINCT line_id) FROM efact",
    "IC-02": "SELECT COUNT(*) FROM efact WHERE product_key - 1 NOT IN (SELECT p_partkey FROM part)",
    "IC-03": "SELECT COUNT(*) FROM efact WHERE rep_key NOT IN (SELECT employee_key FROM demp)",
    "IC-04": "SELECT COUNT(*) FROM efact WHERE team_key IS NULL OR team_key - 1 NOT IN (SELECT n_nationkey FROM nation)",
    "IC-05": "SELECT COUNT(*) FROM efact WHERE customer_key - 1 NOT IN (SELECT c_custkey FROM customer)",
    "IC-06": "SELECT COUNT(*) FROM efact WHERE (doc_type = 'INV') <> coalesce(net_amount_usd > 0, FALSE)",
    "IC-07": "SELECT COUNT(*) FROM efact WHERE NOT coalesce(abs(gross_amount_usd - discount_amount_usd - net_amount_usd) "
             "< 0.01, FALSE)",
    "IC-08": "SELECT COUNT(*) FROM efact WHERE abs(cost_amount_usd) > abs(gross_amount_usd) + 0.01",
    "IC-09": "SELECT COUNT(*) - COUNT(DISTINCT (rep_key, month_key)) FROM tgt",
    "IC-10": "SELECT COUNT(*) FROM efact WHERE doc_type = 'CN' AND original_document_no NOT IN "
             "(SELECT document_no FROM efact)",
    "IC-11": "SELECT COUNT(*) FROM efact WHERE doc_type = 'CN' AND NOT coalesce(days_since_original >= 0, FALSE)",
}
ASSERTIONS = {
    "A01": "SELECT COUNT(*) - COUNT(DISTINCT line_id) FROM fact",
    "A02": "SELECT COUNT(*) FROM fact WHERE (doc_type = 'INV' AND net_amount_usd <= 0) "
           "OR (doc_type = 'CN' AND net_amount_usd >= 0)",
    "A03": "SELECT COUNT(*) FROM fact f LEFT JOIN prod p ON p.product_key = f.product_key LEFT JOIN emp e "
           "ON e.rep_key = f.rep_key LEFT JOIN team t ON t.team_key = f.team_key LEFT JOIN customer c "
           "ON c.c_custkey = f.customer_key WHERE p.product_key IS NULL OR e.rep_key IS NULL OR t.team_key IS NULL "
           "OR c.c_custkey IS NULL",
    "A04": "SELECT COUNT(*) FROM fact cn WHERE doc_type = 'CN' AND NOT EXISTS (SELECT 1 FROM fact i "
           "WHERE i.document_no = cn.original_document_no AND i.doc_type = 'INV')",
    "A05": "SELECT COUNT(*) FROM (SELECT original_document_no, -SUM(net_amount_usd) AS credited FROM fact "
           "WHERE doc_type = 'CN' GROUP BY 1) c JOIN (SELECT document_no, SUM(net_amount_usd) AS invoiced FROM fact "
           "GROUP BY 1) i ON i.document_no = c.original_document_no WHERE credited > invoiced + 1.00",
    "A06": "SELECT COUNT(*) FROM fact WHERE abs(gross_amount_usd - discount_amount_usd - net_amount_usd) > 0.01",
    "A07": "SELECT COUNT(*) FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM bridge b WHERE b.rep_key = t.rep_key "
           "AND b.month_key = t.month_key)",
    "A08": "SELECT COUNT(*) FROM fact f WHERE doc_type = 'INV' AND NOT EXISTS (SELECT 1 FROM bridge b "
           "WHERE b.rep_key = f.rep_key AND b.month_key = f.month_key)",
    "A09": "SELECT COUNT(*) FROM (SELECT tp.team_key, tp.month_key, plan_amount_usd, SUM(t.target_amount_usd) AS a "
           "FROM tplan tp LEFT JOIN tgt t ON t.team_key = tp.team_key AND t.month_key = tp.month_key GROUP BY ALL) "
           "WHERE a > plan_amount_usd * 1.25",
}
CONSTRAINTS = {
    "CON-01": ECHECKS["IC-01"],
    "CON-02": "SELECT COUNT(*) FROM efact WHERE document_no IS NULL",
    "CON-03": "SELECT COUNT(*) FROM efact WHERE net_amount_usd IS NULL",
    "CON-04": "SELECT COUNT(*) FROM efact WHERE doc_type NOT IN ('INV', 'CN')",
    "CON-05": "SELECT COUNT(*) FROM efact WHERE rep_key NOT IN (SELECT employee_key FROM demp)",
    "CON-06": "SELECT COUNT(*) FROM efact WHERE team_key - 1 NOT IN (SELECT n_nationkey FROM nation)",
    "CON-07": ECHECKS["IC-05"],
    "CON-08": ECHECKS["IC-02"],
    "CON-09": ECHECKS["IC-09"],
    "CON-10": "SELECT COUNT(*) FROM tgt WHERE NOT target_amount_usd > 0",
    "CON-11": "SELECT COUNT(*) FROM tgt WHERE rep_key NOT IN (SELECT rep_key FROM emp)",
    "CON-12": "SELECT COUNT(*) - COUNT(DISTINCT (team_key, month_key)) FROM tplan",
    "CON-13": "SELECT COUNT(*) - COUNT(DISTINCT (rep_key, month_key)) FROM bridge",
    "CON-14": "SELECT COUNT(*) FROM bridge WHERE team_key NOT IN (SELECT n_nationkey FROM nation)",
    "CON-15": "SELECT COUNT(*) FROM ebridge WHERE rep_key NOT IN (SELECT employee_key FROM demp)",
    "CON-16": "SELECT COUNT(*) FROM tgt WHERE team_key NOT IN (SELECT n_nationkey FROM nation)",
    "CON-17": "SELECT COUNT(*) FROM tplan WHERE team_key NOT IN (SELECT n_nationkey FROM nation)",
    "CON-18": "SELECT COUNT(*) FROM efact WHERE country_code NOT IN (SELECT 'R' || r_regionkey FROM region)",
    "CON-19": "SELECT COUNT(*) - COUNT(DISTINCT r_regionkey) FROM region",
    "CON-20": "SELECT COUNT(*) - COUNT(DISTINCT team_key) FROM team",
    "CON-21": "SELECT COUNT(*) - COUNT(DISTINCT team_id) FROM team",
    "CON-22": "SELECT COUNT(*) FROM team WHERE team_name IS NULL",
    "CON-23": "SELECT COUNT(*) FROM team WHERE country_code[2:]::INT NOT IN (SELECT r_regionkey FROM region)",
    "CON-24": "SELECT COUNT(*) FROM team WHERE department_code NOT IN ('ENT', 'SME', 'CHN')",
    "CON-25": "SELECT COUNT(*) - COUNT(DISTINCT employee_key) FROM demp",
    "CON-26": "SELECT COUNT(*) - COUNT(DISTINCT employee_code) FROM demp",
    "CON-27": "SELECT COUNT(*) FROM demp WHERE hire_date IS NULL",
    "CON-28": "SELECT COUNT(*) - COUNT(DISTINCT p_partkey) FROM part",
    "CON-29": "SELECT COUNT(*) - COUNT(DISTINCT p_partkey) FROM part WHERE p_partkey IS NOT NULL",
    "CON-30": "SELECT COUNT(*) FROM part WHERE p_retailprice IS NULL",
    "CON-31": "SELECT COUNT(*) - COUNT(DISTINCT c_custkey) FROM customer",
    "CON-32": "SELECT COUNT(*) - COUNT(DISTINCT c_custkey) FROM customer WHERE c_custkey IS NOT NULL",
    "CON-33": "SELECT COUNT(*) FROM customer JOIN nation ON n_nationkey = c_nationkey "
              "WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)",
    "CON-34": "SELECT 0",
}

SQL = {
    "std_dates": "SELECT line_id, document_date::VARCHAR AS document_date, fixed_date FROM stdline",
    "std_country": "SELECT line_id, country_code, fixed_country FROM stdline",
    "std_sku": "SELECT line_id, sku, fixed_sku FROM stdline",
    "std_numeric": f"SELECT line_id, doc_type, rep_code, currency, {m4('quantity discount_pct')}, "
                   "round(price, 4)::DOUBLE AS unit_list_price_local, round(net, 4)::DOUBLE AS net_amount_local "
                   "FROM stdline",
    "dq_rule_log": LOG,
    "dq_dedupe": "SELECT line_id, COUNT(*) AS copies, " + ", ".join(
        f"MAX({c}) FILTER (rn = 1) AS {c}" for c in ("document_no", "sku", "quantity", "net_amount_local"))
        + " FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY "
        + ", ".join(f"{c.strip()} NULLS FIRST" for c in RAW_ORDER.split(",")) + ") AS rn FROM rawline) GROUP BY line_id",
    "dq_quarantine": "SELECT line_id, array_to_string(early, ';') AS dq_failed_rules FROM keptline WHERE len(early) > 0 "
                     "UNION ALL SELECT line_id, late_rule FROM routed WHERE late_rule IS NOT NULL",
    "dq_post_rules": "SELECT line_id, doc_type, document_no, late_rule AS rule_id FROM routed WHERE late_rule IS NOT NULL",
    "dq_target_rules": """
        SELECT rep_key, month_key, revision_no, target_amount_usd::DOUBLE AS target_amount_usd,
               revision_no < MAX(revision_no) OVER (PARTITION BY rep_key, month_key) AS superseded,
               target_amount_usd <= 0 AS not_positive, rep_key NOT IN (SELECT s_suppkey FROM supplier) AS unknown_rep FROM rawtgt
        UNION ALL SELECT NULL, month_key, 1, 10.0::DOUBLE, FALSE, FALSE, TRUE FROM strangers""",
    "dq_missing_targets": """
        SELECT b.rep_key, e.employee_code, e.full_name, b.month_key, b.team_key
          FROM bridge b JOIN emp e ON e.rep_key = b.rep_key
          LEFT JOIN tgt t ON t.rep_key = b.rep_key AND t.month_key = b.month_key WHERE t.rep_key IS NULL""",
    "row_reconciliation": f"""
        SELECT ({RAW_ROWS}) AS raw_rows, (SELECT COUNT(*) FROM stdline WHERE rn > 1) AS dropped_duplicates,
               (SELECT COUNT(*) FROM keptline WHERE len(early) > 0)
                 + (SELECT COUNT(*) FROM routed WHERE late_rule IS NOT NULL) AS quarantined,
               (SELECT COUNT(*) FROM routed WHERE late_rule IS NULL) AS clean_rows, TRUE AS balanced""",
    "integrity_checks": checks(ECHECKS),
    "sql_assertions": checks(ASSERTIONS),
    "constraint_checks": checks(CONSTRAINTS),
    "pit_team_join": "SELECT line_id, rep_code, document_date::VARCHAR AS document_date, own_team AS team_id "
                     "FROM accepted WHERE NOT is_cn",
    "cn_original_join": """
        SELECT line_id, original_document_no, team_id, original_date::VARCHAR AS original_date,
               date_diff('day', original_date, document_date) AS days_since_original FROM routed WHERE is_cn""",
    "over_credit": "SELECT doc, invoiced_usd::DOUBLE AS invoiced_usd, credited_usd::DOUBLE AS credited_usd, "
                   "credited > coalesce(invoiced, 0) + 1.0 AS over_credited FROM docs WHERE credited IS NOT NULL",
    "fx_conform": "SELECT line_id, currency, fx_rate::DOUBLE AS fx_rate, "
                  f"{cents_over_fx('(net * 10000)::HUGEINT')}::DOUBLE AS usd FROM accepted",
    "price_repair": "SELECT line_id, price::DOUBLE AS unit_list_price_local, net::DOUBLE AS net_amount_local "
                    "FROM accepted WHERE \"DQ-S13\"",
    "usd_economics": """
        SELECT line_id, gross_usd::DOUBLE AS gross_amount_usd, net_usd::DOUBLE AS net_amount_usd,
               (gross_usd - net_usd)::DOUBLE AS discount_amount_usd, cost_usd::DOUBLE AS cost_amount_usd,
               (net_usd - cost_usd)::DOUBLE AS gross_margin_usd, commission_weight::DOUBLE AS commission_weight
          FROM cleanusd""",
    "dim_date": """
        SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, d::VARCHAR AS date, year(d) AS year,
               'Q' || quarter(d) AS quarter, month(d) AS month_num, strftime(d, '%b') AS month_name,
               (year(d) * 100 + month(d))::INT AS month_key, strftime(d, '%Y-%m') AS year_month,
               date_trunc('month', d)::DATE::VARCHAR AS month_start_date, day(d) AS day_of_month,
               day(last_day(d)) AS days_in_month, dayname(d) AS weekday_name,
               CASE WHEN day(d) > day(last_day(d)) - 3 THEN 1 ELSE 0 END AS is_month_end_window,
               (year(d) - min(year(d)) OVER ()) * 12 + month(d) AS month_index, coalesce(n, 0) AS documents
          FROM (SELECT unnest(generate_series((SELECT MIN(o_orderdate) FROM orders),
                                              (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY))::DATE AS d) x
          LEFT JOIN (SELECT o_orderdate::DATE AS od, COUNT(*) AS n FROM orders GROUP BY 1) o ON o.od = x.d""",
    "dim_team": """
        SELECT team_key + 1 AS team_key, team_id, team_name, department_code,
               CASE department_code WHEN 'ENT' THEN 'Enterprise Sales' WHEN 'SME' THEN 'SME Sales'
                    ELSE 'Channel & Partner Sales' END AS department_name, country_code, country_name,
               'MGR-' || team_id[2:] AS manager_code, 'Manager ' || team_name AS manager_name FROM team""",
    "dim_employee": """
        SELECT employee_key, employee_code, full_name, role, hire_date::VARCHAR AS hire_date,
               exit_date::VARCHAR AS exit_date, CASE WHEN exit_date IS NULL THEN 'Active' ELSE 'Exited' END
                   AS employment_status,
               CASE WHEN tm <= 6 THEN '0-6m' WHEN tm <= 12 THEN '6-12m' WHEN tm <= 24 THEN '1-2y'
                    WHEN tm <= 48 THEN '2-4y' ELSE '4y+' END AS tenure_band,
               CASE WHEN hire_date >= DATE '1995-01-01' THEN 1 ELSE 0 END AS is_new_hire_in_period, current_team_id,
               manager_code, country_code, department_code
          FROM (SELECT *, date_diff('day', hire_date, coalesce(exit_date, DATE '2001-07-31')) / 30.44::DOUBLE AS tm
                  FROM demp)""",
    "dim_product": """
        SELECT product_key + 1 AS product_key, 'SKU-' || lpad(product_key::VARCHAR, 12, '0') AS sku, product_name,
               product_line, list_price_usd::DOUBLE AS list_price_usd, unit_cost_pct::DOUBLE AS unit_cost_pct,
               is_strategic, commission_weight::DOUBLE AS commission_weight FROM prod""",
    "dim_customer": """
        SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key,
               'CUST-' || lpad(c_custkey::VARCHAR, 12, '0') AS customer_code, c_name AS customer_name,
               'R' || n_regionkey AS country_code, c_mktsegment AS customer_segment,
               'T' || lpad(n_nationkey::VARCHAR, 2, '0') AS owning_team_id
          FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "dim_country": "SELECT country_code, country_name, 'CCY' || country_code[2:] AS currency, "
                   "CASE WHEN country_code[2:]::INT % 2 = 0 THEN 'EAST' ELSE 'WEST' END AS region "
                   "FROM (SELECT 'R' || r_regionkey AS country_code, r_name AS country_name FROM region)",
    "dim_department": "SELECT * FROM (VALUES ('ENT', 'Enterprise Sales'), ('SME', 'SME Sales'), "
                      "('CHN', 'Channel & Partner Sales')) d(department_code, department_name)",
    "dim_commission_plan": """
        SELECT row_number() OVER (ORDER BY plan_id, tier_order) AS plan_tier_key, plan_id, plan_name,
               effective_from, effective_to, tier_order::INT AS tier_order, tier_name,
               CASE tier_order WHEN 1 THEN -99.0 WHEN 2 THEN gate WHEN 3 THEN 1.0 ELSE 1.2 END::DOUBLE AS min_achievement,
               CASE tier_order WHEN 1 THEN gate WHEN 2 THEN 1.0 WHEN 3 THEN 1.2 ELSE 99.0 END::DOUBLE AS max_achievement,
               ((tier_order - 1) * 0.005)::DOUBLE AS commission_rate, 1.25::DOUBLE AS strategic_weight,
               1.5::DOUBLE AS cap_multiple_of_target, 90 AS clawback_window_days
          FROM (VALUES ('PLAN-A', '1995-1997 Sales Incentive Plan', '1995-01-01', '1997-12-31', 0.80),
                       ('PLAN-B', '1998-2001 Sales Incentive Plan', '1998-01-01', '2001-12-31', 0.85))
               p(plan_id, plan_name, effective_from, effective_to, gate),
               (VALUES (1, 'T0 Below Gate'), (2, 'T1 Approaching'), (3, 'T2 On Target'), (4, 'T3 Accelerator'))
               t(tier_order, tier_name)""",
    "ledger_line_outcomes": """
        SELECT 'repeated' AS outcome, COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS line_items FROM lineitem
        UNION ALL
        SELECT outcome, COUNT(*) FROM (
            SELECT CASE WHEN o_orderkey IS NULL THEN 'order missing'
                        WHEN NOT coalesce(CASE WHEN l_returnflag = 'R' THEN ship_date ELSE o_orderdate::DATE END
                                          BETWEEN DATE '1995-01-01' AND DATE '2001-07-31', FALSE) THEN 'outside the window'
                        WHEN l_returnflag = 'R' AND ship_date < o_orderdate::DATE THEN 'credit before its order'
                        WHEN a.rep_key IS NULL THEN 'rep without assignment'
                        WHEN p_partkey IS NULL THEN 'product missing' ELSE 'kept' END AS outcome
              FROM line l LEFT JOIN orders ON o_orderkey = l_orderkey
              LEFT JOIN asg a ON a.rep_key = l_suppkey AND o_orderdate::DATE >= a.start_date
                             AND (a.end_date IS NULL OR o_orderdate::DATE <= a.end_date)
              LEFT JOIN part ON p_partkey = l_partkey) GROUP BY 1""",
    "bridge_rep_team_month": "SELECT * FROM ebridge",
    "fact_sales": "SELECT line_id, document_no, doc_type, original_document_no, date_key, month_key, rep_key, team_key, "
                  "customer_key, product_key, country_code, currency, quantity, days_since_original, is_month_end_window, "
                  + m4("fx_rate unit_list_price_usd discount_pct gross_amount_usd discount_amount_usd net_amount_usd "
                       "cost_amount_usd gross_margin_usd commission_weight net_amount_local") + " FROM efact",
    "fact_targets": f"SELECT rep_key, team_key, month_key, date_key, revision_no, is_ramp_month, "
                    f"{m4('target_amount_usd')} FROM etgt",
    "fact_team_plan": f"SELECT team_key + 1 AS team_key, month_key, month_key * 100 + 1 AS date_key, planned_headcount, "
                      f"{m4('plan_amount_usd')} FROM tplan",
    "seeded_sample": f"""
        SELECT line_id, document_no, doc_type, date_key, rep_key, product_key, {m4('net_amount_usd')}
          FROM fact ORDER BY md5('20240101-' || line_id), line_id LIMIT 5000""",
    "first_lines": f"SELECT line_id, document_no, doc_type, date_key, rep_key, product_key, {m4('net_amount_usd')} "
                   "FROM fact ORDER BY line_id LIMIT 2000",
}


def statements() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in SQL.items()}


# The tables of the ETL model under the names that the KPI statements use; keys there are surrogate.
ON_THE_RUN = {
    "fact": "SELECT * FROM efact",
    "tgt": "SELECT * FROM etgt",
    "bridge": "SELECT *, ((month_key // 100 - 1995) * 12 + month_key % 100 - 1)::INT AS idx FROM ebridge",
    "emp": "SELECT employee_key AS rep_key, employee_code, full_name, exit_date FROM demp",
    "team": "SELECT team_key + 1 AS team_key, team_name, country_code, department_code FROM team",
    "tplan": "SELECT team_key + 1 AS team_key, month_key, planned_headcount, plan_amount_usd FROM tplan",
}


def on_the_run(sql: dict[str, str]) -> dict[str, str]:
    """KPI statements on the output of the ETL."""
    given = {name: with_ctes(body) for name, body in ON_THE_RUN.items()}
    names = {"rep_month_base": "rep_month_base", "commission_rep_month": "commission_rep_month", "team_month": "team_month",
             "revenue_tie_out": "revenue_tie_out", "q01": "q01_actual_vs_target_by_year",
             "q07": "q07_commission_by_tier", "q11": "q11_month_end_loading"}
    return {f"etl_{short}": with_ctes(sql[name].strip(), given) for short, name in names.items()}
