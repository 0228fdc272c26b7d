"""DuckDB oracle SQL for the query catalogue.

Each entry recomputes a catalogue query from the driver's tables with plain SQL, written
independently of the Spark code: adapters as CTEs, the Java-regex yes/no rule as explicit
string predicates, the non-ANSI integer reading of ages as a full-match pattern, discrete
quantiles with ``quantile_disc`` and curve areas with window sums.
"""

from __future__ import annotations

K = "TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER)"

A = f"""a AS (
  SELECT e.event_id,
    CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE strftime(CAST(e.ts AS DATE)
         - to_years(CAST(22 + e.event_id % 9 AS INTEGER)), '%Y-%m-%d') END AS date,
    CASE WHEN e.event_id % 17 = 0 THEN NULL WHEN e.event_id % 53 = 0 THEN 'NA'
         ELSE strftime(e.ts, '%H:%M:%S') END AS time,
    CASE WHEN e.event_id % 41 = 0 THEN NULL WHEN e.event_id % 37 = 0 THEN 'nan'
         WHEN e.event_id % 31 = 0 THEN n.n_name || ' County,'
         WHEN e.event_id % 29 = 0 THEN '  ' || n.n_name || ' County'
         ELSE n.n_name || ' County' END AS county_name,
    c.c_mktsegment AS subject_race,
    CASE WHEN e.user_id % 2 = 0 THEN 'M' ELSE 'F' END AS subject_sex,
    CASE WHEN e.event_id % 97 = 0 THEN '15.5' WHEN e.event_id % 89 = 0 THEN 'NA'
         ELSE CAST(10 + (e.event_id * 37) % 100 AS VARCHAR) END AS subject_age,
    CASE WHEN e.event_id % 43 = 0 THEN NULL WHEN e.event_id % 47 = 0 THEN ''
         ELSE 'Dept ' || CAST({K} % 20 AS VARCHAR) END AS department_name,
    'event' AS type,
    e.event_type AS outcome,
    'reason ' || CAST({K} % 7 AS VARCHAR) AS reason_for_stop,
    CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE n.n_name END AS location,
    CASE WHEN e.event_id % 59 = 0 THEN NULL WHEN e.event_id % 61 = 0 THEN 'NA'
         WHEN e.event_type = 'purchase' THEN 'TRUE' ELSE 'FALSE' END AS citation_issued,
    CASE WHEN e.event_type = 'error' THEN 'Y' ELSE 'N' END AS arrest_made,
    CASE WHEN e.event_type = 'view' THEN '1' ELSE '0' END AS warning_issued
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

TEXT_COLS = ("location", "county_name", "subject_race", "subject_sex", "department_name",
             "type", "outcome", "reason_for_stop")


def _std(c):
    return f"CASE WHEN lower(trim({c})) IN ('nan', '') THEN NULL ELSE trim({c}) END AS {c}"


def _yn(c):
    return (f"CASE WHEN starts_with({c}, '1') OR contains(lower({c}), 'y') "
            f"OR ends_with(lower({c}), 'true') THEN 1 ELSE 0 END AS {c}")


AGE_INT = ("CASE WHEN regexp_full_match(trim(subject_age), '[+-]?[0-9]+([.][0-9]*)?') "
           "THEN TRY_CAST(regexp_extract(trim(subject_age), '^[+-]?[0-9]+') AS INTEGER) END")

A_STD = f"a_std AS (SELECT * REPLACE ({', '.join(_std(c) for c in TEXT_COLS)}) FROM a)"
A_BOOL = ("a_bool AS (SELECT * REPLACE ("
          + ", ".join(_yn(c) for c in ("citation_issued", "arrest_made", "warning_issued"))
          + ") FROM a_std)")
A_AGE = (f"a_age AS (SELECT * REPLACE (CASE WHEN {AGE_INT} < 16 OR {AGE_INT} > 100 THEN NULL "
         f"ELSE TRY_CAST(subject_age AS DOUBLE) END AS subject_age) FROM a_bool)")
A_TIME = """a_t0 AS (SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM a_age),
a_t1 AS (SELECT *, try_strptime(concat_ws(' ', CAST(date AS VARCHAR), time), '%Y-%m-%d %H:%M:%S') AS stop_ts,
                CAST(year(date) AS INTEGER) AS year,
                CASE WHEN time IS NOT NULL THEN 1 ELSE 0 END AS time_available FROM a_t0),
a_t2 AS (SELECT *, CASE WHEN time_available = 1 THEN CAST(hour(stop_ts) AS INTEGER) END AS hour_of_day,
                CASE WHEN time_available = 1 THEN CAST(dayofweek(stop_ts) + 1 AS INTEGER) END AS day_of_week
         FROM a_t1),
a_time AS (SELECT *,
    CASE WHEN time_available = 1 THEN sin(2 * pi() * hour_of_day / CAST(24 AS DOUBLE)) END AS hour_sin,
    CASE WHEN time_available = 1 THEN cos(2 * pi() * hour_of_day / CAST(24 AS DOUBLE)) END AS hour_cos,
    CASE WHEN time_available = 1 AND day_of_week IN (1, 7) THEN 1 WHEN time_available = 1 THEN 0 END AS is_weekend
  FROM a_t2)"""
COUNTY_NORM = "lower(regexp_replace(regexp_replace(county_name, '\\s*County$', ''), ',$', ''))"
A_FLAGS = f"""a_flags AS (SELECT * REPLACE (lower(subject_race) AS subject_race, lower(subject_sex) AS subject_sex),
    citation_issued AS citation_yn, arrest_made AS arrest_yn,
    CASE WHEN arrest_made = 1 THEN 'arrest' WHEN citation_issued = 1 THEN 'citation'
         WHEN warning_issued = 1 THEN 'warning' ELSE 'other' END AS outcome_multiclass,
    CASE WHEN location IS NOT NULL THEN 1 ELSE 0 END AS location_known,
    CASE WHEN county_name IS NOT NULL THEN 1 ELSE 0 END AS county_known,
    {COUNTY_NORM} AS county_name_norm
  FROM a_time)"""


def _b(supplier=False, part=False):
    cols = ["l.l_orderkey", "l.l_linenumber", "lower(n.n_name) AS county_name_norm",
            "CAST(year(l.l_shipdate) AS INTEGER) AS year", "lower(c.c_mktsegment) AS grp",
            "CASE WHEN c.c_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS sex",
            "CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS label",
            "CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END AS pred",
            "l.l_discount AS score", "l.l_quantity"]
    joins = ["JOIN orders o ON l.l_orderkey = o.o_orderkey",
             "JOIN customer c ON o.o_custkey = c.c_custkey",
             "JOIN nation n ON c.c_nationkey = n.n_nationkey"]
    if supplier:
        cols.append("s.s_name AS department_name")
        joins.append("JOIN supplier s ON l.l_suppkey = s.s_suppkey")
    if part:
        cols.append("p.p_type")
        joins.append("JOIN part p ON l.l_partkey = p.p_partkey")
    return f"b AS (SELECT {', '.join(cols)} FROM lineitem l {' '.join(joins)})"


B = _b()
R = """r_src AS (
  SELECT lower(n.n_name) AS county_name_norm, CAST(year(o.o_orderdate) AS INTEGER) AS acs_year,
         lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0') AS state,
         lpad(CAST(n.n_nationkey AS VARCHAR), 3, '0') AS county_fips3,
         o.o_orderstatus, o.o_orderpriority, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE year(o.o_orderdate) >= 1997 AND n.n_nationkey % 7 <> 3),
r AS (
  SELECT county_name_norm, acs_year, state, county_fips3,
         quantile_disc(o_totalprice, 0.5) AS median_income,
         CAST(100 AS DOUBLE) * count_if(o_orderstatus = 'F') / count(*) AS poverty_rate,
         CAST(100 AS DOUBLE) * count_if(o_orderstatus = 'P') / count(*) AS unemployment_rate,
         CAST(100 AS DOUBLE) * count_if(o_orderpriority = '1-URGENT') / count(*) AS edu_bachelor_pct
  FROM r_src GROUP BY county_name_norm, acs_year, state, county_fips3)"""
R_EVERY = R.replace("  WHERE year(o.o_orderdate) >= 1997 AND n.n_nationkey % 7 <> 3),", "  ),")
REF_COLS = "state, county_fips3, median_income, poverty_rate, unemployment_rate, edu_bachelor_pct"

B_REF = f"""b_ref AS (
  SELECT b.*, CASE WHEN b.year < 1997 THEN 1997 ELSE b.year END AS acs_year
  FROM b),
b_joined AS (SELECT * FROM b_ref LEFT JOIN r USING (county_name_norm, acs_year))"""

SHARE = """share AS (
  SELECT county_name_norm, avg(CAST(grp <> 'household' AS DOUBLE)) AS minority_share_stop,
         count(*) AS n_stops_county
  FROM {src} GROUP BY county_name_norm)"""


def _quartile(col, brk, out):
    return (f"CASE WHEN {col} <= {brk}.q1 THEN 'Q1_lowest' WHEN {col} <= {brk}.q2 THEN 'Q2' "
            f"WHEN {col} <= {brk}.q3 THEN 'Q3' ELSE 'Q4_highest' END AS {out}")


def _breaks(name, col, src):
    return (f"{name} AS (SELECT quantile_disc({col}, 0.25) AS q1, quantile_disc({col}, 0.5) AS q2, "
            f"quantile_disc({col}, 0.75) AS q3 FROM {src} WHERE {col} IS NOT NULL)")


SES = f"""{B_REF},
{SHARE.format(src='b_joined')},
b_share AS (SELECT * FROM b_joined LEFT JOIN share USING (county_name_norm)),
{_breaks('ib', 'median_income', 'b_share')},
{_breaks('sb', 'minority_share_stop', 'b_share')},
ses AS (SELECT b_share.*, {_quartile('median_income', 'ib', 'income_quartile')},
               {_quartile('minority_share_stop', 'sb', 'minority_share_bucket')}
        FROM b_share, ib, sb)"""

FAIR_COLS = """CAST(count_if(label = 1 AND pred = 1) AS BIGINT) AS TP,
  CAST(count_if(label = 1) AS BIGINT) AS P,
  CAST(count_if(label = 0 AND pred = 1) AS BIGINT) AS FP,
  CAST(count_if(label = 0) AS BIGINT) AS N,
  CAST(count_if(pred = 1) AS BIGINT) AS Pos"""
RATES = """CASE WHEN P > 0 THEN CAST(TP AS DOUBLE) / P END AS TPR,
  CASE WHEN N > 0 THEN CAST(FP AS DOUBLE) / N END AS FPR,
  CASE WHEN P + N > 0 THEN CAST(Pos AS DOUBLE) / (P + N) END AS Rate"""

ENRICH = f"""{A},
{A_STD},
{A_BOOL},
{A_AGE},
{A_TIME},
{A_FLAGS},
freq AS (SELECT department_name, count(*) AS dept_freq FROM a_flags GROUP BY department_name),
a_freq AS (SELECT * FROM a_flags LEFT JOIN freq USING (department_name)),
{R},
a_enriched AS (
  SELECT * FROM (SELECT *, CASE WHEN year < 1997 THEN 1997 ELSE year END AS acs_year FROM a_freq)
  LEFT JOIN r USING (county_name_norm, acs_year))"""
ENRICH_SELECT = """SELECT event_id, CAST(date AS VARCHAR) AS date, time, county_name, subject_race,
  subject_sex, subject_age, department_name, type, outcome, reason_for_stop, location,
  citation_issued, arrest_made, warning_issued, CAST(stop_ts AS VARCHAR) AS stop_ts, year,
  time_available, hour_of_day, round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos,
  day_of_week, is_weekend, citation_yn, arrest_yn, outcome_multiclass, location_known,
  county_known, county_name_norm, dept_freq, acs_year, state, county_fips3, median_income,
  poverty_rate, unemployment_rate, edu_bachelor_pct FROM a_enriched"""

CURVE = """per AS (SELECT score + 0.0 AS s, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
        FROM b GROUP BY score + 0.0),
cum AS (SELECT s, pos, neg,
        sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
        sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn
        FROM per),
pts AS (SELECT *, cp - pos AS pp, cn - neg AS pn FROM cum),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM per)"""


HASH_100 = "(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100)"


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {
    "clean_names": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",

    "string_standardize": w(A, A_STD) + "SELECT event_id, " + ", ".join(TEXT_COLS) + " FROM a_std",

    "bool_normalize": w(A, A_STD, A_BOOL)
        + "SELECT event_id, citation_issued, arrest_made, warning_issued FROM a_bool",

    "range_null_out": w(A, A_STD, A_BOOL, A_AGE) + "SELECT event_id, subject_age FROM a_age",

    "time_features": w(A, A_STD, A_BOOL, A_AGE, A_TIME) + """SELECT event_id,
        CAST(date AS VARCHAR) AS date, CAST(stop_ts AS VARCHAR) AS stop_ts, year, time_available,
        hour_of_day, round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos, day_of_week,
        is_weekend FROM a_time""",

    "flags": w(A, A_STD, A_BOOL, A_AGE, A_TIME, A_FLAGS) + """SELECT event_id, citation_yn, arrest_yn,
        location_known, county_known, subject_race, subject_sex FROM a_flags""",

    "outcome_priority": w(A, A_STD, A_BOOL, A_AGE, A_TIME, A_FLAGS)
        + "SELECT event_id, outcome_multiclass FROM a_flags",

    "key_normalize": w(A, A_STD, A_BOOL, A_AGE, A_TIME, A_FLAGS)
        + "SELECT event_id, county_name_norm FROM a_flags",

    "cohort_filter": w(A, A_STD, A_BOOL, A_AGE, A_TIME) + """SELECT event_id, citation_issued,
        time_available FROM a_time WHERE time_available = 1 AND citation_issued IS NOT NULL""",

    "distinct_years": w(B) + "SELECT DISTINCT year FROM b WHERE year IS NOT NULL",

    "frequency_encode": w(_b(supplier=True)) + """SELECT l_orderkey, l_linenumber, department_name,
        dept_freq FROM b LEFT JOIN (SELECT department_name, count(*) AS dept_freq FROM b
        GROUP BY department_name) f USING (department_name)""",

    "ref_payload_parse": w(R_EVERY) + f"SELECT acs_year, county_name_norm, {REF_COLS} FROM r",

    "ref_merge": w(R_EVERY) + """SELECT acs_year, county_name_norm, state, county_fips3, median_income,
        CASE WHEN CAST(county_fips3 AS INTEGER) % 5 = 0 THEN NULL ELSE poverty_rate END AS poverty_rate,
        CASE WHEN CAST(county_fips3 AS INTEGER) % 5 = 0 THEN NULL ELSE unemployment_rate END AS unemployment_rate,
        CASE WHEN CAST(county_fips3 AS INTEGER) % 4 = 1 THEN NULL ELSE edu_bachelor_pct END AS edu_bachelor_pct
        FROM r""",

    "floor_year_join": w(B, R, B_REF) + f"""SELECT l_orderkey, l_linenumber, county_name_norm, year,
        acs_year, {REF_COLS} FROM b_joined""",

    "group_share": w(B, SHARE.format(src="b")) + """SELECT l_orderkey, l_linenumber, county_name_norm,
        grp, minority_share_stop, n_stops_county FROM b LEFT JOIN share USING (county_name_norm)""",

    "quartile_breaks": w(B, R, SES) + """SELECT ib.q1 AS income_q1, ib.q2 AS income_q2,
        ib.q3 AS income_q3, sb.q1 AS share_q1, sb.q2 AS share_q2, sb.q3 AS share_q3 FROM ib, sb""",

    "income_quartile": w(B, R, SES) + """SELECT l_orderkey, l_linenumber, median_income,
        income_quartile FROM ses""",

    "share_quartile": w(B, R, SES) + """SELECT l_orderkey, l_linenumber, county_name_norm,
        minority_share_stop, minority_share_bucket FROM ses""",

    "ses_buckets": w(B, R, SES) + """SELECT l_orderkey, l_linenumber, county_name_norm, grp,
        median_income, income_quartile, minority_share_stop, n_stops_county, minority_share_bucket
        FROM ses""",

    "hash_split": w(A) + """SELECT event_id, CASE WHEN
        (('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100) < 80
        THEN 'train' ELSE 'test' END AS split FROM a""",

    "class_weights": w(B) + """, c AS (SELECT CAST(count_if(label = 1) AS BIGINT) AS n_pos,
        CAST(count_if(label = 0) AS BIGINT) AS n_neg FROM b)
        SELECT n_pos, n_neg, n_pos + n_neg AS n_total,
        CAST(greatest(n_pos + n_neg, 1) AS DOUBLE) / (CAST(2 AS DOUBLE) * greatest(n_pos, 1)) AS w_pos,
        CAST(greatest(n_pos + n_neg, 1) AS DOUBLE) / (CAST(2 AS DOUBLE) * greatest(n_neg, 1)) AS w_neg
        FROM c""",

    "fairness_by_group": w(B) + f"""SELECT grp, TP, P, FP, N, Pos, {RATES}
        FROM (SELECT grp, {FAIR_COLS} FROM b GROUP BY grp)""",

    "fairness_grouping_sets": w(B) + f"""SELECT dimension, grp, TP, P, FP, N, Pos, {RATES} FROM (
        SELECT 'grp' AS dimension, grp, {FAIR_COLS} FROM b GROUP BY grp
        UNION ALL
        SELECT 'sex' AS dimension, sex AS grp, {FAIR_COLS} FROM b GROUP BY sex)""",

    "fairness_by_bucket": w(B, R, SES) + f"""SELECT bucketing, bucket, grp, TP, P, FP, N, Pos, {RATES}
        FROM (SELECT 'income' AS bucketing, income_quartile AS bucket, grp, {FAIR_COLS}
              FROM ses GROUP BY income_quartile, grp
              UNION ALL
              SELECT 'share' AS bucketing, minority_share_bucket AS bucket, grp, {FAIR_COLS}
              FROM ses GROUP BY minority_share_bucket, grp)""",

    "rates_by_income_group": w(B, R, SES) + """SELECT income_quartile, grp,
        avg(CAST(label AS DOUBLE)) AS actual_rate, round(avg(score), 6) AS avg_pred_prob,
        count(*) AS n_stops FROM ses GROUP BY income_quartile, grp""",

    "rates_by_share_group": w(B, R, SES) + """SELECT minority_share_bucket, grp,
        avg(CAST(label AS DOUBLE)) AS actual_rate, round(avg(score), 6) AS avg_pred_prob,
        count(*) AS n_stops FROM ses GROUP BY minority_share_bucket, grp""",

    "audit_report": w(B, R, SES) + f""", rates AS (
          SELECT 'rates_by_income' AS report, income_quartile AS bucket, grp,
                 avg(CAST(label AS DOUBLE)) AS actual_rate, round(avg(score), 6) AS avg_pred_prob,
                 CAST(count(*) AS DOUBLE) AS n_stops FROM ses GROUP BY income_quartile, grp
          UNION ALL
          SELECT 'rates_by_share', minority_share_bucket, grp, avg(CAST(label AS DOUBLE)),
                 round(avg(score), 6), CAST(count(*) AS DOUBLE) FROM ses GROUP BY minority_share_bucket, grp),
        fair AS (
          SELECT *, {RATES} FROM (
            SELECT 'fairness_by_income' AS report, income_quartile AS bucket, grp, {FAIR_COLS}
            FROM ses GROUP BY income_quartile, grp
            UNION ALL
            SELECT 'fairness_by_share', minority_share_bucket, grp, {FAIR_COLS}
            FROM ses GROUP BY minority_share_bucket, grp))
        SELECT report, bucket, grp, metric, value FROM (
          SELECT report, bucket, grp, 'actual_rate' AS metric, actual_rate AS value FROM rates
          UNION ALL SELECT report, bucket, grp, 'avg_pred_prob', avg_pred_prob FROM rates
          UNION ALL SELECT report, bucket, grp, 'n_stops', n_stops FROM rates
          UNION ALL SELECT report, bucket, grp, 'TP', CAST(TP AS DOUBLE) FROM fair
          UNION ALL SELECT report, bucket, grp, 'P', CAST(P AS DOUBLE) FROM fair
          UNION ALL SELECT report, bucket, grp, 'FP', CAST(FP AS DOUBLE) FROM fair
          UNION ALL SELECT report, bucket, grp, 'N', CAST(N AS DOUBLE) FROM fair
          UNION ALL SELECT report, bucket, grp, 'Pos', CAST(Pos AS DOUBLE) FROM fair
          UNION ALL SELECT report, bucket, grp, 'TPR', TPR FROM fair
          UNION ALL SELECT report, bucket, grp, 'FPR', FPR FROM fair
          UNION ALL SELECT report, bucket, grp, 'Rate', Rate FROM fair)""",

    "auroc_score": w(B, CURVE) + """SELECT round(sum(CAST(neg AS DOUBLE) * (cp + pp))
        / (CAST(2 AS DOUBLE) * any_value(tot.P) * any_value(tot.N)), 6) AS auroc FROM pts, tot""",

    "aupr_score": w(B, CURVE) + """SELECT round(sum(CAST(pos AS DOUBLE) * (
          CAST(cp AS DOUBLE) / (cp + cn)
          + CASE WHEN pp + pn = 0 THEN CAST(cp AS DOUBLE) / (cp + cn) ELSE CAST(pp AS DOUBLE) / (pp + pn) END))
        / (CAST(2 AS DOUBLE) * any_value(tot.P)), 6) AS aupr FROM pts, tot""",

    "rank_unique_score": w("""b AS (SELECT o_totalprice AS score,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders)""", CURVE) + """SELECT
        round(sum(CAST(neg AS DOUBLE) * (cp + pp))
          / (CAST(2 AS DOUBLE) * any_value(tot.P) * any_value(tot.N)), 6) AS auroc,
        round(sum(CAST(pos AS DOUBLE) * (
          CAST(cp AS DOUBLE) / (cp + cn)
          + CASE WHEN pp + pn = 0 THEN CAST(cp AS DOUBLE) / (cp + cn) ELSE CAST(pp AS DOUBLE) / (pp + pn) END))
          / (CAST(2 AS DOUBLE) * any_value(tot.P)), 6) AS aupr FROM pts, tot""",

    "class_weight_rows": w(B) + f""", s AS (SELECT l_orderkey, l_linenumber, label,
            ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 80 AS train FROM b),
        c AS (SELECT count_if(label = 1) AS p, count_if(label = 0) AS n FROM s WHERE train)
        SELECT l_orderkey, l_linenumber, label,
               round(CAST(greatest(p + n, 1) AS DOUBLE) / (2 * greatest(CASE WHEN label = 1 THEN p ELSE n END, 1)), 9) AS class_w
        FROM s, c WHERE train""",

    "split_facts": w(A) + """, n AS (SELECT count(*) AS n FROM a)
        SELECT 'split' AS what, n AS n_rows, 0 AS n_lost, 0 AS n_twice, true AS share_ok FROM n
        UNION ALL SELECT 'sample', n, 0, 0, true FROM n""",

    "model_facts": w(ENRICH) + f""", c AS (SELECT * FROM a_enriched WHERE time_available = 1),
        sh AS (SELECT county_name_norm, avg(CAST(subject_race <> 'household' AS DOUBLE)) AS v FROM c GROUP BY county_name_norm),
        j AS (SELECT c.*, sh.v FROM c LEFT JOIN sh USING (county_name_norm)),
        {_breaks('ib', 'median_income', 'j')},
        {_breaks('sb', 'v', 'j')},
        z AS (SELECT citation_issued, subject_race, {_quartile('median_income', 'ib', 'iq')}, {_quartile('v', 'sb', 'sq')} FROM j, ib, sb)
        SELECT 'scored' AS fact, '' AS bucket, '' AS grp, CAST(count(*) AS DOUBLE) AS value FROM z
        UNION ALL SELECT 'prediction is not p_hat > 0.5', '', '', 0.0
        UNION ALL SELECT 'p_hat outside 0 to 1', '', '', 0.0
        UNION ALL SELECT 'rates_by_income n_stops', iq, subject_race, count(*) FROM z GROUP BY iq, subject_race
        UNION ALL SELECT 'rates_by_share n_stops', sq, subject_race, count(*) FROM z GROUP BY sq, subject_race
        UNION ALL SELECT 'fairness_by_income P', iq, subject_race, count_if(citation_issued = 1) FROM z GROUP BY iq, subject_race
        UNION ALL SELECT 'fairness_by_share P', sq, subject_race, count_if(citation_issued = 1) FROM z GROUP BY sq, subject_race
        UNION ALL SELECT 'fairness_by_income N', iq, subject_race, count_if(citation_issued = 0) FROM z GROUP BY iq, subject_race
        UNION ALL SELECT 'fairness_by_share N', sq, subject_race, count_if(citation_issued = 0) FROM z GROUP BY sq, subject_race""",

    "rank_binned": """WITH per AS (SELECT o_totalprice AS s, count_if(o_orderstatus = 'F') AS pos,
               count_if(o_orderstatus <> 'F') AS neg FROM orders GROUP BY o_totalprice),
        rnk AS (SELECT *, row_number() OVER (ORDER BY s DESC) - 1 AS i, count(*) OVER () AS d FROM per),
        bin AS (SELECT bins, i // greatest(d // bins, 1) AS bin, sum(pos) AS pos, sum(neg) AS neg
                FROM rnk, (VALUES (100), (1000)) v(bins) GROUP BY ALL),
        cum AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM bin WINDOW w AS (PARTITION BY bins ORDER BY bin)),
        pts AS (SELECT *, cp - pos AS pp, cn - neg AS pn FROM cum)
        SELECT bins, count(*) AS n_points, round(sum(CAST(neg AS DOUBLE) * (cp + pp)) / (2.0 * sum(pos) * sum(neg)), 6) AS auroc,
               round(sum(CAST(pos AS DOUBLE) * (CAST(cp AS DOUBLE) / (cp + cn)
                 + CASE WHEN pp + pn = 0 THEN CAST(cp AS DOUBLE) / (cp + cn) ELSE CAST(pp AS DOUBLE) / (pp + pn) END))
                 / (2.0 * sum(pos)), 6) AS aupr
        FROM pts GROUP BY bins""",

    "nearest_year_join": w(B, R) + """, g AS (SELECT * FROM r WHERE median_income >= (SELECT avg(median_income) FROM r)),
        k AS (SELECT DISTINCT county_name_norm, year FROM b),
        m AS (SELECT k.county_name_norm, k.year, g.acs_year, g.median_income FROM k JOIN g USING (county_name_norm)
              QUALIFY row_number() OVER (PARTITION BY k.county_name_norm, k.year ORDER BY abs(g.acs_year - k.year), g.acs_year) = 1)
        SELECT l_orderkey, l_linenumber, county_name_norm, year, acs_year, median_income
        FROM b LEFT JOIN m USING (county_name_norm, year)""",

    "colocated_frequency": """SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_partkey) AS part_freq
        FROM lineitem""",

    "csv_quarantine": """SELECT 'good' AS kind, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(*) AS counted FROM events
        UNION ALL SELECT 'malformed', 2 * count(*), CAST(2 * sum(event_id) AS BIGINT), 2 * count(*) FROM events""",

    "category_index": w(_b(part=True)) + """SELECT p_type,
        CAST(row_number() OVER (ORDER BY cnt DESC, p_type) - 1 AS DOUBLE) AS p_type_idx
        FROM (SELECT p_type, count(*) AS cnt FROM b GROUP BY p_type)""",

    "one_hot": w(_b(part=True)) + """SELECT p_type,
        CAST(row_number() OVER (ORDER BY cnt DESC, p_type) - 1 AS INTEGER) AS slot,
        CAST(count(*) OVER () AS INTEGER) AS size
        FROM (SELECT p_type, count(*) AS cnt FROM b GROUP BY p_type)""",

    "impute_median": w(A, A_STD, A_BOOL, A_AGE) + """SELECT event_id,
        coalesce(subject_age, (SELECT quantile_disc(subject_age, 0.5) FROM a_age
                               WHERE subject_age IS NOT NULL)) AS subject_age_imp FROM a_age""",

    "std_scale": w(B) + """SELECT l_orderkey, l_linenumber,
        round(l_quantity / stddev_samp(l_quantity) OVER (), 6) AS l_quantity_scaled,
        round(score / stddev_samp(score) OVER (), 6) AS score_scaled FROM b""",

    "csv_roundtrip": w(A) + """SELECT CAST(event_id AS VARCHAR) AS event_id, date, time, county_name,
        subject_race, subject_sex, subject_age, nullif(department_name, '') AS department_name, type,
        outcome, reason_for_stop, location, citation_issued, arrest_made, warning_issued FROM a""",

    "enrich_full": w(ENRICH) + ENRICH_SELECT,
    "enriched_roundtrip": w(ENRICH) + ENRICH_SELECT,
    "read_or_build": w(ENRICH) + ENRICH_SELECT,
    "stream_enrich": w(ENRICH) + ENRICH_SELECT,
    "stream_frequency": w(ENRICH) + ENRICH_SELECT,

    "published_table": w(ENRICH) + """SELECT year, count(*) AS n_rows,
        (SELECT count(*) FROM a_enriched) AS published_rows FROM a_enriched GROUP BY year""",

    "saved_pipeline": w(A, A_STD, A_BOOL, A_AGE) + f""", s AS (SELECT event_id, department_name, subject_age,
          CASE WHEN {HASH_100} < 80 THEN 'train' ELSE 'test' END AS split FROM a_age),
        f AS (SELECT department_name, count(*) AS n FROM s WHERE split = 'train' GROUP BY department_name),
        m AS (SELECT quantile_disc(subject_age, 0.5) AS v FROM s WHERE split = 'train' AND subject_age IS NOT NULL),
        i AS (SELECT event_id, department_name, split, coalesce(subject_age, m.v) AS subject_age_imp FROM s, m),
        b AS (SELECT quantile_disc(subject_age_imp, 0.25) AS q1, quantile_disc(subject_age_imp, 0.5) AS q2,
                     quantile_disc(subject_age_imp, 0.75) AS q3 FROM i WHERE split = 'train')
        SELECT event_id, i.department_name, split,
               CASE WHEN i.department_name IS NOT NULL THEN coalesce(f.n, 0) END AS dept_freq_train, subject_age_imp,
               {_quartile('subject_age_imp', 'b', 'age_quartile')}
        FROM i LEFT JOIN f ON f.department_name = i.department_name, b""",

    "sketch_quantiles": """WITH v AS (SELECT n_name AS place, c_mktsegment AS segment FROM orders
          JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice IS NOT NULL)
        SELECT *, true AS q1_ok, true AS q2_ok, true AS q3_ok FROM (
          SELECT 'place' AS grouping, place AS key, count(*) AS n FROM v GROUP BY place
          UNION ALL SELECT 'segment', segment, count(*) FROM v GROUP BY segment
          UNION ALL SELECT 'place+segment', place || '/' || segment, count(*) FROM v GROUP BY place, segment
          UNION ALL SELECT 'all', '', count(*) FROM v)""",

    "approx_buckets": w(B, R, SES) + """SELECT bucketing, n, true AS q1_ok, true AS q2_ok, true AS q3_ok FROM (
          SELECT 'income' AS bucketing, count(median_income) AS n FROM ses
          UNION ALL SELECT 'share', count(minority_share_stop) FROM ses)""",

    "metrics_json": w(B) + f"""SELECT grp, TP, P, FP, N, Pos, {RATES}
        FROM (SELECT grp, {FAIR_COLS} FROM b GROUP BY grp)""",
}
